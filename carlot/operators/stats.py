"""Aggregate helpers shared by the market and quality operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_mean(c) -> Column:
    """Order-independent mean of a 2-decimal money column.

    The sum runs on decimal (exact, associative) and the single division is
    correctly rounded, so every partitioning and every engine gives the same
    bits (no rounding step that could hit a decimal tie).
    """
    col = F.col(c) if isinstance(c, str) else c
    s = F.sum(col.cast("decimal(18,2)")).cast("double")
    return s / F.count(col)
