"""Sinks (B1–B6, B10, B11): plain CSV, JSON and (partitioned) parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.operators.keys import new_keys_only
from carlot.operators.quality import table_diff, table_fingerprint
from carlot.session import stored
from carlot.sources.files import existing_paths, union_frames


def write_fixed_csv(df: DataFrame, path: str, header: list[str], mode: str = "overwrite") -> None:
    """CSV with a fixed header; absent fields are written as ''."""
    cols = [F.coalesce(F.col(f"`{h}`").cast("string"), F.lit("")).alias(h) if h in df.columns
            else F.lit("").alias(h) for h in header]
    df.select(*cols).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def append_keys(keys: DataFrame, path: str) -> None:
    """B2: append the ids that the key table at ``path`` hasn't yet, each once."""
    new = keys.distinct()
    if existing_paths(keys.sparkSession, [path]):
        new = new_keys_only(new, keys.sparkSession.read.parquet(path), keys.columns)
    stored(new, "new-keys").write.mode("append").parquet(path)


def write_star(listings: DataFrame, options: DataFrame, bridge: DataFrame, base: str) -> None:
    """The three tables of the equipment star schema."""
    listings.write.mode("overwrite").parquet(f"{base}/listings")
    options.write.mode("overwrite").parquet(f"{base}/equipment_options")
    bridge.write.mode("overwrite").parquet(f"{base}/listing_equipment")


def write_segments(df: DataFrame, path: str, segment: str = "segment") -> None:
    """One folder per segment (or run date) via ``partitionBy``. Each task moves
    its own files into the folders; by default the driver moves those of all segments,
    one after the other, at the end. ``_SUCCESS`` tells that all are there."""
    (df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy(segment).parquet(path))


def write_name_list(names: DataFrame, path: str, col: str = "name") -> None:
    """One name per line (make list)."""
    names.select(F.col(col).cast("string")).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; non-JSON values (timestamps, decimals) as strings."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """The ``Brand,Model`` catalogue in its order, as one CSV file (a
    vocabulary of makes and models)."""
    (catalogue.orderBy("ord").select(F.col("brand").alias("Brand"), F.col("model").alias("Model"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))


def write_merged(frames: list[DataFrame], path: str, header: list[str]) -> DataFrame:
    """Frames united by column name, written with a fixed header."""
    merged = union_frames(frames)
    write_fixed_csv(merged, path, header)
    return merged


def write_pages(pages: DataFrame, path: str, run_date: str = "run_date") -> None:
    """Landed pages as a table, one folder per run date (others stay)."""
    (pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_date).parquet(path))


def write_checked(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write, read back, and compare types and an order-independent fingerprint
    of all rows; a difference is an error that shows some of the differing rows.
    Returns the table read back."""
    df = stored(df, "checked")                           # the rows written are those compared
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return check_read_back(df, df.sparkSession.read.parquet(path))


def check_read_back(df: DataFrame, back: DataFrame) -> DataFrame:
    if dict(back.dtypes) != dict(df.dtypes):
        raise ValueError(f"types changed: {sorted(set(back.dtypes) ^ set(df.dtypes))}")
    if table_fingerprint(df).first() != table_fingerprint(back, df.columns).first():
        raise ValueError(f"rows changed: {table_diff(df, back).limit(5).collect()}")
    return back


def write_params(df: DataFrame, path: str, param_col: str) -> None:
    """JSON lines, the raw parameter map as it came (a JSON text) in
    ``param_col``; all other values as JSON."""
    rest = [c for c in df.columns if c != param_col]
    df.select(F.to_json(F.struct(*rest, F.to_json(F.parse_json(param_col)).alias(param_col)), {"ignoreNullFields": "false"}).alias("value")) \
        .write.mode("overwrite").text(path)
