"""Segment plan (L1/L2): split a listing population into segments under a size
limit, coarsest level first: all -> year -> year x gearbox -> ranges of the key.

The counts of a year and gearbox are one aggregate, those of the coarser levels
sums of it. A cell that is still over the limit is cut into ranges of equal count
by the key's rank in it, from the distributed prefix sum, so no segment is over
the limit and every row lands in exactly one (NULL years and every gearbox
included, which the source's hard-coded year range and gearbox list lost).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.operators.scans import dense_index, join_null_safe
from carlot.session import stored

YEAR, GEARBOX = "production_year", "transmission"


def _levels(listings: DataFrame, limit: int) -> DataFrame:
    """A row for each year and gearbox: its count, its year's count and the level
    at which it fits (``range`` if at none)."""
    cells = stored(listings.groupBy(YEAR, GEARBOX).agg(F.count(F.lit(1)).alias("n")), "segment-cells")
    years = cells.groupBy(YEAR).agg(F.sum("n").alias("year_n"))
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    level = (F.when(F.lit(total) <= limit, "all").when(F.col("year_n") <= limit, "year")
             .when(F.col("n") <= limit, "year_gearbox").otherwise("range"))
    return join_null_safe(cells, years, [YEAR]).select(YEAR, GEARBOX, "n", "year_n", F.lit(total).alias("total"), level.alias("level"))


def _parts(listings: DataFrame, levels: DataFrame, limit: int, keys: list[str]) -> DataFrame:
    """The listings of the cells that are over the limit with their range ``part``:
    ranks by ``keys`` cut into ceil(n / limit) runs of nearly equal length."""
    over = levels.where("level = 'range'").select(YEAR, GEARBOX, "n")
    rows = join_null_safe(listings, over, [YEAR, GEARBOX])
    ranked = dense_index(rows, keys, out="__rank", start=0, group_cols=[YEAR, GEARBOX])
    return ranked.withColumn("part", F.expr(f"cast(__rank * ((n + {limit - 1}) div {limit}) div n as int)")).drop("__rank", "n")


def segment_plan(listings: DataFrame, limit: int, keys=("advert_id",)) -> DataFrame:
    """Rows: (level, production_year, transmission, part, listings, first_key,
    last_key); ``part`` and the bounds of the first of ``keys`` only for ranges."""
    keys = list(keys)
    levels = stored(_levels(listings, limit), "segment-levels")
    none = lambda kind: F.lit(None).cast(kind)
    kind = listings.schema[keys[0]].dataType
    whole = levels.where("level = 'all'").groupBy("level").agg(F.max("total").alias("listings")).select(
        "level", none("int").alias(YEAR), none("string").alias(GEARBOX), "listings")
    years = levels.where("level = 'year'").groupBy("level", YEAR).agg(F.max("year_n").alias("listings")).select(
        "level", YEAR, none("string").alias(GEARBOX), "listings")
    cells = levels.where("level = 'year_gearbox'").select("level", YEAR, GEARBOX, F.col("n").alias("listings"))
    coarse = whole.unionByName(years).unionByName(cells).select(
        "level", YEAR, GEARBOX, none("int").alias("part"), "listings", none(kind).alias("first_key"), none(kind).alias("last_key"))
    parts = _parts(listings.select(YEAR, GEARBOX, *keys), levels, limit, keys)
    fine = parts.groupBy(YEAR, GEARBOX, "part").agg(F.count(F.lit(1)).alias("listings"), F.min(keys[0]).alias("first_key"),
                                                    F.max(keys[0]).alias("last_key"))
    return coarse.unionByName(fine.select(F.lit("range").alias("level"), YEAR, GEARBOX, "part", "listings", "first_key", "last_key"))


def assign_segments(listings: DataFrame, limit: int, keys=("advert_id",)) -> DataFrame:
    """Tag each listing with its segment's label (for ``write_segments``)."""
    levels = stored(_levels(listings, limit), "segment-levels")
    y, g = F.coalesce(F.col(YEAR).cast("string"), F.lit("null")), F.coalesce(GEARBOX, F.lit("null"))
    coarse = join_null_safe(listings, levels.where("level <> 'range'").select(YEAR, GEARBOX, "level"), [YEAR, GEARBOX])
    label = (F.when(F.col("level") == "all", "all").when(F.col("level") == "year", F.concat(F.lit("y_"), y))
             .otherwise(F.concat(F.lit("yg_"), y, F.lit("_"), g)))
    fine = _parts(listings, levels, limit, list(keys))
    return coarse.withColumn("segment", label).drop("level").unionByName(
        fine.withColumn("segment", F.concat(F.lit("yg_"), y, F.lit("_"), g, F.lit("_"), F.col("part").cast("string"))).drop("part"))
