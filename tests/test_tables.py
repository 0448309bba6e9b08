"""Tables written and read back: keyed upserts, compaction, fingerprints, pruning."""
import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from carlot.operators import bands as B
from carlot.operators import equipment as EQ
from carlot.operators import quality as Q
from carlot.sources import files as FL
from carlot.sources import keyed as KT
from carlot.sources import sinks as SK
from carlot.streaming import ingest as ST


def folder(name):
    return os.path.join(tempfile.mkdtemp(prefix=f"carlot-{name}-"), name)


def data_files(path):
    out = {}
    for d, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.relpath(os.path.join(d, n), path)] = hashlib.sha256(open(os.path.join(d, n), "rb").read()).hexdigest()
    return out


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


KINDS = "source string, id bigint, v string, seq int"


def test_upsert_replaces_only_the_buckets_it_touches(spark):
    rows = [("a" if i % 3 else "b", i, f"v{i}", 0) for i in range(300)]
    df = spark.createDataFrame(rows, KINDS).withColumns({"first_seen_at": F.lit(1), "last_seen_at": F.lit(1)})
    path = folder("keyed")
    KT.write_keyed(df.drop("seq"), path, ["source", "id"], 16, ["source"])
    before = data_files(path)
    assert len(before) > 20
    batch = spark.createDataFrame([("a", 1, "old", 1), ("a", 1, "new", 2), ("a", 1000, "x", 1), ("b", 3, None, 1)], KINDS)
    n = KT.upsert_keyed(spark, path, batch, ["source", "id"], ["v"], F.lit(9), 16, ["source"], ["seq"])
    after = data_files(path)
    assert 2 <= n <= 3 and len(set(before) - set(after)) <= n
    assert all(after[f] == h for f, h in before.items() if f in after) and len(set(before) & set(after)) >= len(before) - n
    want = {(s, i): (v, 1, 1) for s, i, v, _ in rows} | {("a", 1): ("new", 1, 9), ("a", 1000): ("x", 9, 9), ("b", 3): (None, 1, 9)}
    assert {(r.source, r.id): (r.v, r.first_seen_at, r.last_seen_at) for r in KT.read_keyed(spark, path).collect()} == want
    assert KT.upsert_keyed(spark, path, batch.limit(0), ["source", "id"], ["v"], F.lit(9), 16, ["source"], ["seq"]) == 0
    assert data_files(path) == after


def test_scan_of_touched_buckets_is_pruned(spark):
    path = folder("pruned")
    KT.write_keyed(spark.range(1000).select(F.lit("a").alias("source"), "id"), path, ["source", "id"], 8, ["source"])
    touched = spark.createDataFrame([("a", 3)], "source string, bucket int")
    t = KT.read_keyed(spark, path)
    touched.write.parquet(path + "-touched")
    j = t.join(spark.read.parquet(path + "-touched").where("bucket = 3"), ["source", "bucket"], "left_semi")
    assert "dynamicpruning" in plan(j).lower()


def test_pages_of_some_runs(spark):
    path = folder("pages")
    pages = spark.range(60).select(F.col("id").alias("page_id"), F.lit("<p>").alias("html"),
                                   F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("run_date"))
    SK.write_pages(pages, path)
    runs_path = path + "-runs"
    pages.select("run_date").distinct().withColumn("day", F.dayofmonth("run_date")).write.parquet(runs_path)
    got = FL.read_run_pages(spark, path, spark.read.parquet(runs_path).where("day = 2"))
    assert sorted(r.page_id % 6 for r in got.collect()) == [1] * 10
    assert "dynamicpruning" in plan(got).lower()
    scan = [x for x in plan(got).splitlines() if "FileScan" in x and "html" in x]
    assert scan and "PartitionFilters" in scan[0]


def test_one_changed_cell_is_found(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, None, 2.5)], "k int, s string, v double")
    path = folder("checked")
    assert SK.write_checked(df, path).count() == 3
    changed = df.withColumn("s", F.when(F.col("k") == 2, "").otherwise(F.col("s")))
    with pytest.raises(ValueError, match="rows changed"):
        SK.check_read_back(changed, spark.read.parquet(path))
    assert Q.table_fingerprint(df).first() == Q.table_fingerprint(df.repartition(3)).first()
    assert Q.table_fingerprint(df).first() != Q.table_fingerprint(df.distinct()).first()
    two = spark.createDataFrame([("a,1:b", "c")], "x string, y string"), spark.createDataFrame([("a", "b,1:c")], "x string, y string")
    assert Q.table_fingerprint(two[0]).first() != Q.table_fingerprint(two[1]).first()
    assert sorted((r.side, r.k, r.s) for r in Q.table_diff(df, changed).collect()) == [("left", 2, None), ("right", 2, "")]
    assert Q.table_fingerprint(df.limit(0)).first().rows == 0


def test_options_keep_their_ids(spark):
    one = spark.createDataFrame([(1, ["b", "d"]), (2, ["d"])], "listing_id int, equipment_list array<string>")
    two = spark.createDataFrame([(3, ["a", "d", "c"]), (1, ["b", "a"])], "listing_id int, equipment_list array<string>")
    options = EQ.option_dimension(one).select("id", "name")
    grown = EQ.grow_options(options, two)
    assert {r.name: r.id for r in grown.collect()} == {"b": 0, "d": 1, "a": 2, "c": 3}
    more = EQ.grow_bridge(EQ.listing_equipment(one, options), grown, two)
    assert sorted(map(tuple, more.collect())) == [(1, 2), (3, 1), (3, 2), (3, 3)]
    assert {r.name: r.id for r in EQ.grow_options(options.limit(0), one).collect()} == {"b": 0, "d": 1}


def test_bands(spark):
    bands = spark.createDataFrame([("low", 0.0, 10.0), ("wide", -5.0, 1000.0), ("empty", 5.0, 5.0), ("open", None, 3.0), ("up", 10.0, 11.0)],
                                  "band string, low double, high double")
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.0, 9.999, 10.0, -5.0, -5.1, 999.9, 1000.0, None])], "i int, v double")
    want = {(0, "low"), (0, "wide"), (1, "low"), (1, "wide"), (2, "wide"), (2, "up"), (3, "wide"), (4, None), (5, "wide"), (6, None), (7, None)}
    for width in (None, 0.5, 7.0, 5000.0):
        j = B.in_bands(df, "v", bands, width=width)
        assert {(r.i, r.band) for r in j.collect()} == want and j.count() == len(want)
    assert "NestedLoop" not in plan(j) and "Cartesian" not in plan(j)
    assert B.in_bands(df, "v", bands.limit(0)).count() == 8


def test_united_sketches(spark):
    df = spark.range(40000).select((F.col("id") % 7).alias("part"), (F.col("id") % 9000).alias("a"),
                                   F.when(F.col("id") % 2 == 0, F.col("id")).alias("b"), F.lit(None).cast("string").alias("c"))
    got = {r.column_name: r for r in Q.merge_profiles(Q.profile_sketches(df, by=["part"])).collect()}
    exact = {r.column_name: r for r in Q.column_profile(df, ["a", "b", "c"]).collect()}
    for c, e in exact.items():
        assert (got[c].rows, got[c].non_null, got[c].nulls) == (e.rows, e.non_null, e.nulls)
        assert abs(got[c].n_distinct - e.n_distinct) <= 0.08 * e.n_distinct
    assert (exact["a"].n_distinct, exact["b"].n_distinct, exact["c"].n_distinct) == (9000, 20000, 0)
    none = {r.column_name: (r.rows, r.n_distinct) for r in Q.column_profile(df.limit(0), ["a", "c"]).collect()}
    assert none == {"a": (0, 0), "c": (0, 0)}


def test_parameter_maps(spark):
    rows = [(1, '{"k": 5, "Stan": "Nowe", "x y": [1]}'), (2, None), (3, '{"k": "5"}'), (4, '{"a\'b": true}')]
    path = folder("params")
    SK.write_params(spark.createDataFrame(rows, "i int, raw string"), path, "raw")
    back = FL.read_params(spark, path, "i int", "raw")
    got = {r.i: tuple(r)[1:] for r in back.select("i", FL.param("raw", "k", "int"), FL.param("raw", "Stan", "string"),
                                                  FL.param("raw", "a'b", "boolean")).collect()}
    assert got == {1: (5, "Nowe", None), 2: (None, None, None), 3: (5, None, None), 4: (None, None, True)}


def test_headers_without_reading_the_files(spark):
    path = folder("csv")
    os.makedirs(path)
    for i, head in enumerate(("a,b", "b,a", "a,b")):
        with open(f"{path}/f{i}.csv", "w") as f:
            f.write(head + "\n" + "1,2\n" * 50000)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    got = {h: sorted(os.path.basename(x) for x in fs) for h, fs in FL.csv_headers(spark, path, "*.csv").items()}
    assert got == {"a,b": ["f0.csv", "f2.csv"], "b,a": ["f1.csv"]} and spark.conf.get("spark.sql.files.openCostInBytes") == cost
    df = FL.read_raw_csv(spark, path, glob="*.csv")
    assert df.groupBy("a", "b").count().collect()[0]["count"] in (50000, 100000) and df.count() == 150000


def test_stream_late_repeated_and_replayed(spark):
    src, base, ckpt = folder("src"), folder("base"), folder("ckpt")
    kinds = "k string, v int, ts timestamp"
    args = (["k"], ["v"], ["ts"])
    known = spark.createDataFrame([("known",)], "k string")

    def arrive(*rows):
        spark.createDataFrame([(k, v, t) for k, v, t in rows], "k string, v int, t string").select(
            "k", "v", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = ST.file_stream(spark, src, kinds, max_files_per_trigger=1)
        ST.run_keyed_ingest(stream, base, ["k"], ["v"], "ts", ["ts"], watermark="1 hour", checkpoint=ckpt, known=known).awaitTermination()

    def rows():
        return {r.k: (r.v, r.sightings) for r in ST.keyed_table(spark, base, *args).collect()}

    arrive(("a", 1, "2026-01-01 10:00:00"), ("known", 1, "2026-01-01 10:00:00"))
    run()
    arrive(("a", 1, "2026-01-01 10:00:00"), ("b", 2, "2026-01-01 18:00:00"))            # repeated; moves the watermark
    run()
    assert rows() == {"a": (1, 1), "b": (2, 1)}
    arrive(("c", 3, "2026-01-01 11:00:00"), ("a", 4, "2026-01-01 18:30:00"))            # c is late
    run()
    assert rows() == {"a": (4, 2), "b": (2, 1)}
    whole = rows()
    upto = ST.compact_epochs(spark, base, *args)
    assert upto >= 1 and rows() == whole and sum(d.startswith("epoch=") for d in os.listdir(base)) == 1
    commits = sorted((int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit()))
    for f in (f"{ckpt}/commits/{commits[-1]}", f"{ckpt}/commits/.{commits[-1]}.crc"):   # the last batch wasn't acknowledged
        if os.path.exists(f):
            os.remove(f)
    run()
    assert rows() == whole
    batch = spark.createDataFrame([("z", 1, 1)], "k string, v int, ts int")
    ST.write_epoch(batch, upto, base, ["k"], ["v"], "ts", ["ts"])                       # merged already: left as it is
    assert rows() == whole
