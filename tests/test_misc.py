"""Segments, serial ids, legacy page count, scan push-down."""
import os
import tempfile

from pyspark.sql import functions as F

from carlot.operators import extract as X
from carlot.operators import keys as K
from carlot.operators import segments as SG
from carlot.sources import files as FL
from carlot.sources import sinks as SK


def test_segments_cover_every_row(spark):
    rows = [(2010 + i % 3, "Manualna" if i % 2 else "Automatyczna") for i in range(60)] + [(None, "Manualna")] * 5
    df = spark.createDataFrame(rows, "production_year int, transmission string")
    df = df.withColumn("advert_id", F.monotonically_increasing_id() % 17)
    n = df.count()
    for limit in (1000, 15, 7, 3, 1):
        plan = [r.asDict() for r in SG.segment_plan(df, limit).collect()]
        tagged = SG.assign_segments(df, limit)
        assert sum(r["listings"] for r in plan) == n == tagged.count()
        assert max(r["listings"] for r in plan) <= limit
        sizes = sorted(r["count"] for r in tagged.groupBy("segment").count().collect())
        assert sizes == sorted(r["listings"] for r in plan)
    assert [r["level"] for r in SG.segment_plan(df, 1000).collect()] == ["all"]
    assert {r["level"] for r in SG.segment_plan(df, 7).collect()} == {"year", "range"}
    tagged = SG.assign_segments(df, 15)
    out = os.path.join(tempfile.mkdtemp(prefix="carlot-seg-"), "segments")
    SK.write_segments(tagged, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("segment="))[0].startswith("segment=y_null")


def test_assign_new_ids(spark):
    t = spark.createDataFrame([("a", 1), ("b", None), ("c", 5), ("d", None)], "k string, id long")
    got = {r["k"]: r["id"] for r in K.assign_new_ids(t, ["k"]).collect()}
    assert got == {"a": 1, "c": 5, "b": 6, "d": 7}


def test_legacy_total_pages():
    doc = X.parse_html('<ul class="x pager"><li>1</li><li>7</li></ul><ul><li>99</li></ul>')
    assert X.legacy_total_pages(doc, "pager") == 7
    assert X.legacy_total_pages(doc, "missing") == 1


def test_priced_projection_pushes_to_scan(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="carlot-pq-"), "listings")
    spark.createDataFrame([("A", "B", "v", 2020, 1.0, 10, "Diesel", "x")],
                          "make string, model string, version string, production_year int, price double, "
                          "mileage_km int, fuel_type string, extra string").write.parquet(d)
    df = FL.priced_projection(spark.read.parquet(d))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(price)]" in plan
    assert "extra" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_pruning_and_pushdown_reach_the_scan(spark):
    import __spark_entry__ as E
    from tests.conftest import SF0001
    df = E.queries()["known_key_anti_join"](spark, SF0001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [l for l in plan.splitlines() if "FileScan parquet [l_" in l]
    assert scans and all("l_tax" not in s and "l_comment" not in s for s in scans)   # columns pruned
    assert any("l_shipdate" in s and "2000-01-01" in s for s in scans)               # filter pushed


def test_column_profile_approx_distinct(spark):
    from carlot.operators.quality import column_profile
    df = spark.range(0, 20000).selectExpr("id", "id % 1000 AS k", "CAST(NULL AS STRING) AS s")
    exact = {r["column_name"]: r["n_distinct"] for r in column_profile(df).collect()}
    approx = {r["column_name"]: r["n_distinct"] for r in column_profile(df, distinct="approx").collect()}
    assert exact == {"id": 20000, "k": 1000, "s": 0}
    assert abs(approx["id"] - 20000) / 20000 < 0.05 and abs(approx["k"] - 1000) / 1000 < 0.05 and approx["s"] == 0
