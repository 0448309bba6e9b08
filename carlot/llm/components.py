"""Connected components of an edge table, by alternating large and small stars.

Each round hangs every node's larger neighbours, then its smaller ones, on the
least neighbour; both steps are a grouped minimum and a join, so a node of any
degree is split over tasks. The rounds end when the edge table no longer
changes, which one count and one checksum tell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import written


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _hang(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(written(least, "star-least"), "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), where component is
    the least node reachable. Null ends and self-edges are ignored."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = written(e, "star-edges")
    seen = _print(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _hang(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "star-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = _hang(large, least)
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        e = written(small, "star-edges")
        now = _print(e)
        if now == seen:
            break
        seen = now
    top = e.groupBy("u").agg(F.min("v").alias("component"))
    roots = top.select(F.col("component").alias("node"), "component").distinct()
    return top.withColumnRenamed("u", "node").unionByName(roots)
