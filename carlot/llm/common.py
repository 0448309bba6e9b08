"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.session import scratch_path, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The six ASCII white-space characters, \x20 and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder, by any path Spark can read."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure-ASCII values take Spark's byte-wise ``lower``,
    which is the same there and much faster than ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


_SCRATCH: list[list] = []


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as a table under the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, and gives the planner real
    sizes. The files go when the driver's JVM ends, or with the enclosing
    ``scratch()`` block unless ``keep``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    if _SCRATCH and not keep:
        _SCRATCH[-1].append((spark, path))
    return spark.read.schema(schema).parquet(path)


@contextmanager
def scratch() -> Iterator[None]:
    """Tables written inside go when the block ends; what is to outlive it must
    be written with ``keep``."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for spark, path in _SCRATCH.pop():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that is made and run inside go when it ends, not when
    the driver happens to collect garbage: for results that are collected or written once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of constants, planned as literals (no Python worker)."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields, strict=True)]) for r in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in fields])
    return spark.range(1).select(F.inline(F.array(*structs)))


def replaced(df: DataFrame, **cols: Column) -> DataFrame:
    """``withColumns`` that also drops case variants of the new names, so that
    an input column of the same name is replaced, never ambiguous."""
    low = {c.lower() for c in cols}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low],
                     *[v.alias(k) for k, v in cols.items()])
