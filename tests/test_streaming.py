"""Streaming keyed ingest: a replayed file inside the watermark does not
double-count sightings; the final table equals the batch aggregate."""
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from carlot.streaming import ingest as ST
from tests.conftest import SF0001


def test_stream_dedup_within_watermark(spark):
    src = tempfile.mkdtemp(prefix="carlot-stream-src-")
    shutil.copy(f"{SF0001}/events.parquet", os.path.join(src, "part-1.parquet"))
    shutil.copy(f"{SF0001}/events.parquet", os.path.join(src, "part-2.parquet"))   # the same sightings again
    schema = spark.read.parquet(f"{SF0001}/events.parquet").schema
    base = tempfile.mkdtemp(prefix="carlot-stream-tbl-")
    ckpt = tempfile.mkdtemp(prefix="carlot-stream-ckpt-")
    q = ST.run_keyed_ingest(ST.file_stream(spark, src, schema, max_files_per_trigger=1), base,
                            ["user_id", "event_type"], ["value", "event_id"], "ts", ["ts", "event_id"],
                            watermark="3650 days", checkpoint=ckpt)
    q.awaitTermination()
    got = {(r["user_id"], r["event_type"]): (r["sightings"], r["event_id"]) for r in
           ST.keyed_table(spark, base, ["user_id", "event_type"], ["value", "event_id"], ["ts", "event_id"]).collect()}
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    want = {(r["user_id"], r["event_type"]): (r["n"], r["eid"]) for r in ev.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("event_id", F.struct("ts", "event_id")).alias("eid")).collect()}
    assert got == want


def test_replayed_batch_counts_once(spark):
    base = tempfile.mkdtemp(prefix="carlot-epoch-")
    args = (["k"], ["v"], "ts", ["ts"])
    one = spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("b", 5, 3)], "k string, v int, ts int")
    two = spark.createDataFrame([("a", 3, 9), ("c", 7, 1)], "k string, v int, ts int")
    for batch, epoch in ((one, 0), (two, 1), (two, 1), (one, 0)):
        ST.write_epoch(batch, epoch, base, *args)
    got = {r["k"]: tuple(r)[1:] for r in ST.keyed_table(spark, base, ["k"], ["v"], ["ts"]).collect()}
    assert got == {"a": (2, 9, 11, 3), "b": (5, 3, 3, 1), "c": (7, 1, 1, 1)}
