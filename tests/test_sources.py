"""Scans and sinks: landed HTML, all-string CSV with newlines, key lists,
header binding, writers, fixed-header CSV."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from carlot.sources import files as FL
from carlot.sources import sinks as SK


def test_landed_html_and_csv(spark):
    d = tempfile.mkdtemp(prefix="carlot-src-")
    for i in range(3):
        with open(os.path.join(d, f"offer_{i}.html"), "w", encoding="utf-8") as f:
            f.write(f"<html><body><p>ID: 100{i}</p>\n<p>Zażółć</p></body></html>")
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("not a page")
    pages = FL.read_landed_html(spark, d)
    assert pages.count() == 3 and all("Zażółć" in r["html"] for r in pages.collect())
    csv_dir = os.path.join(d, "csv")
    os.makedirs(csv_dir)
    with open(os.path.join(csv_dir, "all_offers_1.csv"), "w", encoding="utf-8") as f:
        f.write('advert_id,description,price\n1,"two\nlines",89 900\n2,,100\n')
    df = FL.read_raw_csv(spark, csv_dir, ["advert_id", "description", "price"], glob="all_offers_*.csv")
    rows = sorted(df.collect())
    assert rows[0]["description"] == "two\nlines" and rows[1]["description"] is None
    empty = FL.read_raw_csv(spark, os.path.join(d, "missing"), ["a"], allow_empty=True)
    assert empty.count() == 0 and empty.columns == ["a"]
    with pytest.raises(Exception, match="(?i)not.exist|not.found"):
        FL.read_raw_csv(spark, os.path.join(d, "missing"), ["a"])


def test_csv_columns_bind_by_header(spark):
    d = tempfile.mkdtemp(prefix="carlot-hdr-")
    for name, text in (("all_1.csv", "a,b,c\n1,2,3\n"), ("all_2.csv", "c,a\n30,10\n31,11\n"), ("all_3.csv", "a,b,c\n7,,9\n"),
                       ("other.csv", "a\n99\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    got = sorted((r["a"], r["b"], r["c"]) for r in FL.read_raw_csv(spark, d, ["a", "b", "c"], glob="all_*.csv").collect())
    assert got == [("1", "2", "3"), ("10", None, "30"), ("11", None, "31"), ("7", None, "9")]
    assert FL.read_raw_csv(spark, d, glob="all_*.csv").columns == ["a", "b", "c"]
    assert FL.read_raw_csv(spark, d, ["x"], glob="all_2.csv").collect()[0]["x"] is None


def test_catalogue_keeps_the_order_of_its_file(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="carlot-cat-"), "cat.csv")
    rows = [("Bentley", "Azure"), ("BMW", "X1"), ("abarth", "500"), ("BMW", "M3")]
    with open(p, "w") as f:
        f.write("Brand,Model\n" + "".join(f"{b},{m}\n" for b, m in rows))
    cat = FL.read_catalogue(spark, p)
    assert [(r["brand"], r["model"]) for r in cat.orderBy("ord").collect()] == rows
    from carlot.operators import catalogue as CT
    t = spark.createDataFrame([(1, "Bentley swap for BMW X1"), (2, "Abarth 500")], "row_id long, title string")
    assert {r["row_id"]: r["make"] for r in CT.tag_make(t, cat).collect()} == {1: "BMW", 2: "abarth"}
    with pytest.raises(ValueError):
        CT.tag_make(t, cat.drop("ord"))
    out = os.path.join(os.path.dirname(p), "out")
    SK.write_catalogue(cat, out)
    assert [(r["brand"], r["model"]) for r in FL.read_catalogue(spark, out).orderBy("ord").collect()] == rows


def test_writers(spark):
    d = tempfile.mkdtemp(prefix="carlot-wr-")
    df = spark.createDataFrame([(1, "x", None), (2, "y", 2.5)], "k int, s string, v double")
    back = SK.write_checked(df, f"{d}/t")
    assert back.dtypes == df.dtypes and back.count() == 2
    with pytest.raises(ValueError):
        SK.write_checked(df.withColumn("d", F.lit("1")), f"{d}/p", ["d"])      # the partition reads back as a number
    SK.write_merged([df.select("k"), df.select("s", "k")], f"{d}/m", ["k", "s"])
    assert FL.read_raw_csv(spark, f"{d}/m", glob="*.csv").count() == 4
    pages = spark.createDataFrame([("u1", "<p>", "2026-01-01"), ("u2", "<p>", "2026-01-02")], "url string, html string, run_date string")
    SK.write_pages(pages, f"{d}/pages")
    SK.write_pages(pages.where("run_date = '2026-01-02'").withColumn("url", F.lit("u3")), f"{d}/pages")
    assert sorted(r["url"] for r in spark.read.parquet(f"{d}/pages").collect()) == ["u1", "u3"]
    SK.append_keys(df.select("k"), f"{d}/keys")
    SK.append_keys(df.select("k"), f"{d}/keys")
    assert spark.read.parquet(f"{d}/keys").count() == 2
    SK.write_star(df, df, df, f"{d}/star")
    assert sorted(os.listdir(f"{d}/star")) == ["equipment_options", "listing_equipment", "listings"]
    SK.write_json(df, f"{d}/json")
    assert spark.read.json(f"{d}/json").where("v is null").count() == 1


def test_seen_ids(spark):
    d = tempfile.mkdtemp(prefix="carlot-ids-")
    p = os.path.join(d, "ids.csv")
    with open(p, "w") as f:
        f.write(" 1001 \n\n1002\n1001\n")
    assert sorted(r[0] for r in FL.read_seen_ids(spark, p).collect()) == ["1001", "1002"]
    assert FL.read_seen_ids(spark, os.path.join(d, "nope.csv")).count() == 0


def test_fixed_header_csv(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="carlot-out-"), "out")
    df = spark.createDataFrame([(1, None)], "a int, b string")
    SK.write_fixed_csv(df.coalesce(1), d, ["a", "b", "c"])
    text = "".join(open(os.path.join(d, f)).read() for f in sorted(os.listdir(d)) if f.endswith(".csv"))
    assert text.splitlines()[0] == "a,b,c"
    back = spark.read.option("header", True).csv(d).collect()[0]
    assert back["a"] == "1" and back["b"] is None and back["c"] is None   # '' reads back as NULL


def test_numbered_scan_and_name_list(spark):
    d = tempfile.mkdtemp(prefix="carlot-num-")
    for n in (1, 3):
        with open(os.path.join(d, f"part_{n}.csv"), "w") as f:
            f.write(f"a,b\n{n},x\n")
    with pytest.warns(UserWarning):
        df = FL.read_numbered_csv(spark, os.path.join(d, "part_{}.csv"), range(1, 4), ["a", "b"])
    assert sorted(r["a"] for r in df.collect()) == ["1", "3"]
    out = os.path.join(d, "makes")
    SK.write_name_list(spark.createDataFrame([("Toyota",), ("Ford",)], "name string"), out)
    assert sorted(r[0] for r in FL.read_name_list(spark, out).collect()) == ["Ford", "Toyota"]


def test_table_info(spark):
    from carlot.operators.quality import table_info
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {r["column_name"]: (r["dtype"], r["rows"], r["non_null"]) for r in table_info(df).collect()}
    assert got == {"a": ("int", 2, 2), "b": ("string", 2, 1)}


