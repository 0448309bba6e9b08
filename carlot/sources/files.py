"""File scans (A1–A9): landed HTML, raw CSV exports, catalogues, key lists.

CSV is always read with an explicit all-string schema (no inference pass
over the data, no type guessing); typing happens afterwards with the
``try_cast`` cleaners.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carlot.operators.scans import dense_index
from carlot.session import ship_package


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_landed_html(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """A1: one row per landed HTML file: (url = file URI, html)."""
    # ``text(wholetext=...)`` overrides an ``option("wholetext")``: pass it here.
    df = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def _first_lines(batches):
    """The first row of the stream, then no more: what follows isn't read."""
    for b in batches:
        if b.num_rows:
            yield b.slice(0, 1)
            return


def csv_headers(spark: SparkSession, path, glob: str | None = None) -> dict[str, list[str]]:
    """Header line -> files that have it, without a second pass over the data:
    every split of a file is a task of its own that stops after its first row, and
    the splits at a file's start have the header. The driver gets a row for each
    file (its listing, which Spark holds there anyway)."""
    ship_package(spark)
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    conf, packing = spark.conf, "spark.sql.files.openCostInBytes"
    before = conf.get(packing)
    conf.set(packing, conf.get("spark.sql.files.maxPartitionBytes"))     # never two files in one task
    try:
        lines = r.text(path).select(F.col("_metadata.file_path").alias("file"), "value",
                                    F.col("_metadata.file_block_start").alias("at"))
        first = lines.mapInArrow(_first_lines, lines.schema).where("at = 0").collect()
    finally:
        conf.set(packing, before)
    out: dict[str, list[str]] = {}
    for x in sorted(first, key=lambda x: x["file"]):
        out.setdefault(x["value"].lstrip("\ufeff").rstrip("\r"), []).append(x["file"])
    return out


def read_raw_csv(spark: SparkSession, path, columns: list[str] | None = None, glob: str | None = None,
                 multiline: bool = True, allow_empty: bool = False) -> DataFrame:
    """A2/A3/A4: raw export CSV(s), every column a string, bound by header.

    ``path`` may be a folder, a glob or a list; ``glob`` filters file names
    (``all_offers_*.csv``). Files are grouped by their header line and united
    by column name, so columns may be reordered or absent (NULL). ``columns``
    picks the result's columns; without it all headers' columns come back, in
    order of the first files. Descriptions hold newlines, hence ``multiLine``.
    No matching file is an error unless ``allow_empty``.
    """
    try:
        headers = csv_headers(spark, path, glob)
    except Exception as e:  # noqa: BLE001  (Spark's own "no such path")
        if not (allow_empty and ("PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e))):
            raise
        headers = {}
    if not headers:
        if not allow_empty:
            raise FileNotFoundError(f"no CSV file at {path}")
        return spark.createDataFrame([], string_schema(columns or []))
    frames = []
    for header, files in sorted(headers.items(), key=lambda x: x[1][0]):
        names = next(csv.reader([header]))
        frames.append(spark.read.schema(string_schema(names)).option("header", True).option("multiLine", multiline)
                      .option("escape", '"').option("mode", "PERMISSIVE").csv(files))
    merged = union_frames(frames)
    if columns is None:
        return merged
    return merged.select(*[F.col(f"`{c}`") if c in merged.columns else F.lit(None).cast("string").alias(c)
                           for c in columns])


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths that exist (driver-side file listing, metadata only)."""
    return [p for p in paths if _exists(spark, p)]


def read_numbered_csv(spark: SparkSession, template: str, numbers, columns: list[str]) -> DataFrame:
    """A4: ``template.format(n)`` for each n; missing files are skipped with a
    warning, no file at all is an error."""
    import warnings
    paths = [template.format(n) for n in numbers]
    found = existing_paths(spark, paths)
    for p in sorted(set(paths) - set(found)):
        warnings.warn(f"skipping missing file {p}", stacklevel=2)
    if not found:
        raise FileNotFoundError(f"no file of {template}")
    return read_raw_csv(spark, found, columns)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A5: ``Brand,Model`` catalogue CSV -> (brand, model, ord), ``ord`` being
    the line's place in the file: later entries win when titles are tagged."""
    df = (spark.read.schema(string_schema(["Brand", "Model"])).option("header", True).csv(path)
          .select(F.col("Brand").alias("brand"), F.col("Model").alias("model"),
                  F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__at"),
                  F.monotonically_increasing_id().alias("__n")))
    return dense_index(df, ["__file", "__at", "__n"], out="ord").select("brand", "model", "ord")


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """One name per line."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where(F.col("name") != "")


def read_seen_ids(spark: SparkSession, path: str) -> DataFrame:
    """First column of a CSV key file, trimmed, blanks skipped, distinct;
    a missing file gives an empty key set."""
    df = (spark.read.option("header", False).option("ignoreMissingFiles", True).csv(path)
          if _exists(spark, path) else spark.createDataFrame([], "_c0 string"))
    return df.select(F.trim(F.col("_c0")).alias("advert_id")).where(
        F.col("advert_id").isNotNull() & (F.col("advert_id") != "")).distinct()


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return bool(fs.globStatus(p)) and len(fs.globStatus(p)) > 0


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames by column name, missing columns as NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_params(spark: SparkSession, path: str, schema: str, param_col: str) -> DataFrame:
    """JSON lines whose ``param_col`` holds a raw parameter map: the
    columns of ``schema``, and the map as a VARIANT (NULL where it is no JSON)."""
    raw = spark.read.schema(f"{schema}, {param_col} string").json(path)
    return raw.withColumn(param_col, F.try_parse_json(param_col))


def param(col: str, key: str, kind: str):
    """One parameter of a VARIANT map as ``kind``, NULL if absent or of another
    kind. A path can't name a key that holds both kinds of quotes."""
    mark = '"' if "'" in key else "'"
    if mark in key:
        raise ValueError(f"no path for the key {key}")
    return F.try_variant_get(col, f"$[{mark}{key}{mark}]", kind)


def read_run_pages(spark: SparkSession, path: str, runs: DataFrame, run_date: str = "run_date") -> DataFrame:
    """The landed pages of the runs in ``runs`` (whose other columns select
    them): its dates prune the folders that are scanned, while the query runs."""
    return spark.read.parquet(path).join(runs.select(run_date).distinct(), run_date, "left_semi")


def priced_projection(listings: DataFrame) -> DataFrame:
    """The report's scan - 7 columns and ``price IS NOT NULL``; on
    parquet/JDBC both reach the source (ReadSchema / PushedFilters)."""
    return listings.select("make", "model", "version", "production_year", "price", "mileage_km",
                           "fuel_type").where(F.col("price").isNotNull())
