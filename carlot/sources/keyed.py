"""Keyed tables in hash buckets (B7, F12): an upsert reads and replaces only the
buckets that its batch touches.

A table is a plain partitioned parquet folder ``<within...>/bucket=<n>``: the
columns of ``within`` (part of the key, such as the source) and a hash of the
key; they are never NULL. New buckets are staged in the shared folder and then take the place of the
old ones by dynamic partition overwrite; all other files stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.operators.keys import last_per_key, upsert
from carlot.session import stored

BUCKET = "bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_keyed(df: DataFrame, path: str, keys: list[str], buckets: int, within: list[str] = (), mode: str = "overwrite",
                placed: bool = False) -> None:
    """Write ``df`` as a keyed table; a bucket's rows go to one task first, so
    that it is one file. ``mode='replace'`` replaces only the buckets that occur."""
    parts = [*within, BUCKET]
    d = df if placed else df.withColumn(BUCKET, bucket_of(keys, buckets))
    w = d.repartition(*parts).write.partitionBy(*parts)
    if mode == "replace":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.mode("overwrite").parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def upsert_keyed(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], columns: list[str], run_ts,
                 buckets: int, within: list[str] = (), order_cols=None) -> int:
    """Upsert ``batch`` into the keyed table at ``path`` (see ``keys.upsert``) and
    return the number of buckets it replaced.

    The batch is collapsed to a row per key and written first. Its distinct
    (within, bucket) pairs, of which there are no more than partitions of the
    table, meet the table's partition columns in a join that prunes the scan
    while it runs; what wasn't touched is neither read nor written.
    """
    parts = [*within, BUCKET]
    order = list(order_cols) if order_cols else []
    slim = batch.select(*dict.fromkeys([*keys, *[c for c in columns if c in batch.columns], *order]))
    if order:
        slim = last_per_key(slim, keys, order, keep=[c for c in columns if c in batch.columns])
    new = stored(slim.withColumn(BUCKET, bucket_of(keys, buckets)), "keyed-batch")
    touched = new.select(*parts).distinct()
    n = touched.count()
    if not n:
        return 0
    target = read_keyed(spark, path)
    kinds = {f.name: f.dataType for f in target.schema.fields}       # partition columns are read back by guess
    on = [target[c] == touched[c].cast(kinds[c]) for c in parts]
    old = target.join(touched, on, "left_semi").drop(BUCKET)
    merged = upsert(old.select(*[F.col(c).cast(batch.schema[c].dataType).alias(c) if c in within else F.col(c) for c in old.columns]),
                    new.drop(BUCKET), keys, columns, run_ts)                # one row per key already
    staged = stored(merged.withColumn(BUCKET, bucket_of(keys, buckets)), "keyed-buckets")
    write_keyed(staged, path, keys, buckets, within, mode="replace", placed=True)
    return n
