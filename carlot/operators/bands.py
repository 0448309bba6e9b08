"""Bands as a table (D30, D31): a range join through an equi-join.

Each band is listed under every cell of a grid that it overlaps, each value falls
into one cell, and the cell is the join key; the bounds decide after that. The
number of bands is free, and no value meets a band outside its cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cell_width(bands: DataFrame, low: str = "low", high: str = "high") -> float:
    """A grid for ``bands``: the mean width of those with both bounds (one number)."""
    w = bands.agg(F.avg(F.col(high).cast("double") - F.col(low).cast("double"))).first()[0]
    return float(w) if w and w > 0 else 1.0


def in_bands(df: DataFrame, value: str, bands: DataFrame, low: str = "low", high: str = "high",
             width: float | None = None) -> DataFrame:
    """``df`` with the columns of each band that holds ``value``: low <= value <
    high. Several bands give several rows, none a row of NULLs; a NULL value is in
    no band, an empty band (high <= low, or a NULL bound) holds nothing. Columns of
    ``bands`` must not occur in ``df``."""
    width = width or cell_width(bands, low, high)
    cell = lambda c: F.floor(F.col(c).cast("double") / width).cast("bigint")
    grid = bands.where(F.col(high) > F.col(low)).withColumn("__cell", F.explode(F.sequence(cell(low), cell(high))))
    rows = df.withColumn("__at", cell(value))
    on = (F.col("__at") == F.col("__cell")) & (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))
    # by exchange: many bands are no small table, and few make no difference
    return rows.join(grid.hint("merge"), on, "left").drop("__at", "__cell")
