"""Incremental ingest as Structured Streaming (K4).

Every micro-batch is collapsed to one row per key and lands in its own
partition ``epoch=<n>`` of a plain table, overwriting it. A batch that is
replayed after a failure writes the same partition again, so nothing counts
twice. The keyed table is the merge of all partitions. The stream's checkpoint lives in the shared
checkpoint folder.

With a watermark, sightings repeated within it are dropped before they count, and
sightings older than it are late and go. Keys that are known already (a table)
can be left out by a stream-static anti-join.

Old epochs are merged from time to time (``compact_epochs``), so that reading the
table doesn't merge all history; the last one stays apart, since only it can be
replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.session import scratch_path, stored


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Files arriving in folder ``path`` (optionally only names matching ``glob``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _collapsed(rows: DataFrame, keys: list[str], value_cols: list[str], order_cols: list[str],
               first, last, n) -> DataFrame:
    """One row per key: values of the latest row, first and last sighting, count."""
    rest = [*value_cols, *[c for c in order_cols if c not in value_cols]]
    latest = F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("__r")
    agg = rows.groupBy(*keys).agg(latest, first.alias("first_seen_at"), last.alias("last_seen_at"), n.alias("sightings"))
    return agg.select(*keys, "__r.*", "first_seen_at", "last_seen_at", "sightings")


def _numbers(spark: SparkSession, base: str, prefix: str) -> list[int]:
    """The numbers n of the complete folders ``<base>/<prefix>n``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [f.getPath() for f in fs.listStatus(root)]
    return sorted(int(p.getName()[len(prefix):]) for p in names if p.getName().startswith(prefix)
                  and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _merged(spark: SparkSession, base: str) -> int:
    """The last epoch that was merged, -1 if none."""
    return max(_numbers(spark, base, "upto="), default=-1)


def _landed(spark: SparkSession, base: str, last: int | None = None) -> tuple[DataFrame, int]:
    """The merged rows and all epochs after them, up to ``last``; and the last one."""
    done = _merged(spark, base)
    epochs = [n for n in _numbers(spark, base, "epoch=") if n > done and (last is None or n <= last)]
    paths = [f"{base}/upto={done}"] * (done >= 0) + [f"{base}/epoch={n}" for n in epochs]
    if not paths:
        raise FileNotFoundError(f"no epoch under {base}")
    return spark.read.parquet(*paths), max([done, *epochs])


def compact_epochs(spark: SparkSession, base: str, keys: list[str], value_cols: list[str], order_cols: list[str]) -> int:
    """Merge all epochs but the last into one folder ``upto=<n>`` and return n. Its
    name alone makes the merged epochs obsolete, so a run that breaks off leaves the
    table as it was; folders of merged epochs go afterwards."""
    epochs = [n for n in _numbers(spark, base, "epoch=") if n > _merged(spark, base)]
    if len(epochs) < 2:
        return _merged(spark, base)
    rows, upto = _landed(spark, base, epochs[-2])
    whole = _collapsed(rows, keys, value_cols, order_cols, F.min("first_seen_at"), F.max("last_seen_at"), F.sum("sightings"))
    whole.write.mode("overwrite").parquet(f"{base}/upto={upto}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for prefix, keep in (("epoch=", upto + 1), ("upto=", upto)):
        for n in _numbers(spark, base, prefix):
            if n < keep:
                fs.delete(path(f"{base}/{prefix}{n}"), True)
    return upto


def write_epoch(batch: DataFrame, epoch: int, base: str, keys: list[str], value_cols: list[str], ts: str,
                order_cols: list[str]) -> None:
    """Land one micro-batch; the same epoch again replaces itself, one that was
    merged already is left as it is."""
    if int(epoch) <= _merged(batch.sparkSession, base):
        return
    _collapsed(batch, keys, value_cols, order_cols, F.min(ts), F.max(ts), F.count(F.lit(1))) \
        .write.mode("overwrite").parquet(f"{base}/epoch={int(epoch)}")


def keyed_table(spark: SparkSession, base: str, keys: list[str], value_cols: list[str],
                order_cols: list[str]) -> DataFrame:
    """The merge of all epochs: the latest values of each key, the span of its
    sightings and their number."""
    merged = _collapsed(_landed(spark, base)[0], keys, value_cols, order_cols,
                        F.min("first_seen_at"), F.max("last_seen_at"), F.sum("sightings"))
    return merged.select(*keys, *value_cols, "first_seen_at", "last_seen_at", "sightings")


def run_keyed_ingest(stream: DataFrame, table_base: str, keys: list[str], value_cols: list[str], ts: str,
                     order_cols: list[str], watermark: str | None = None,
                     checkpoint: str | None = None, available_now: bool = True, known: DataFrame | None = None):
    """Start the stream; every micro-batch becomes a partition of the table.
    Sightings whose key is in the table ``known`` are left out."""
    spark = stream.sparkSession
    s = stream if known is None else stream.join(stored(known.select(*keys).distinct(), "known-keys"), keys, "left_anti")
    if watermark:
        # Watermarks need TIMESTAMP; NTZ event times are read in the (UTC) session zone.
        s = (s.withColumn("__event_time", F.col(ts).cast("timestamp"))
             .withWatermark("__event_time", watermark)
             .dropDuplicatesWithinWatermark(keys + order_cols))

    def land(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch.drop("__event_time"), epoch, table_base, keys, value_cols, ts, order_cols)

    w = (s.writeStream.foreachBatch(land)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
