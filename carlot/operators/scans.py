"""Distributed ordered scans: prefix sums, dense indexes, exact percentiles.

These replace single-partition windows (``row_number() over (order by ...)``)
and per-group buffers that would put one hot group into one task.

The shape of every scan is the same:

1. range-partition and sort by ``(group..., order...)``; a hot group is split
   across many partitions by the range bounds. The number of partitions is
   left to AQE, which sizes them by the data;
2. in the same stage each partition adds up its running sums, streaming, and
   notes its own number; the result is stored in the shared folder;
3. per-group offsets come from a table with one row per ``(partition, group)``,
   and join back; it is broadcast when its files are small.

Percentiles run the scan over one row per distinct value, so neither a hot
group nor a hot value lands in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carlot.session import ship_package, stored

_PID, _GROUP, _LOCAL = "__pid", "__group", "__local"


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def join_null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` where NULL keys match NULL keys (``<=>``);
    the right side's key columns are dropped."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = [left[c].eqNullSafe(r[f"__r_{c}"]) for c in cols]
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in cols])


def running_sums(batches: Iterator[pa.RecordBatch], value: str) -> Iterator[pa.RecordBatch]:
    """Running sum of ``value`` within each group of one sorted partition."""
    pid = TaskContext.get().partitionId()
    group, carry = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        g = b.column(_GROUP).to_numpy()
        v = b.column(value).fill_null(0).to_numpy()
        first = np.concatenate([[True], g[1:] != g[:-1]])
        total = np.cumsum(v)
        start = np.flatnonzero(first)
        before = np.concatenate([[0], total[start[1:] - 1]])
        if g[0] == group:
            before[0] -= carry
        local = total - np.repeat(before, np.diff(np.append(start, len(g))))
        group, carry = g[-1], local[-1]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(local), pa.array(np.full(len(g), pid))], [*b.schema.names, _LOCAL, _PID])


def _group_key(cols: list[str]) -> Column:
    # a hash skips NULLs, so each key goes with its NULL flag: (NULL, 'x') is not ('x', NULL)
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())]) if cols else F.lit(0).cast("bigint")


def prefix_sum(df: DataFrame, value: str, out: str, group_cols=None, order_cols=None,
               inclusive: bool = True, total: str | None = None) -> DataFrame:
    """Running sum of the integer column ``value`` within each group in
    ``order_cols`` order.

    ``inclusive=False`` gives the sum of strictly earlier rows. Ties in
    ``order_cols`` are broken by the sort position, so pass a total order.
    ``total`` names a further column with the whole group's sum.
    """
    ship_package(df.sparkSession)
    g = _cols(group_cols)
    keys = g + _cols(order_cols)
    d = df.withColumn(value, F.col(value).cast("bigint")).withColumn(_GROUP, _group_key(g))
    d = d.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields)
    s = stored(d.mapInArrow(lambda it: running_sums(it, value), f"{kinds}, {_LOCAL} bigint, {_PID} bigint"), "running-sums")
    before = Window.partitionBy(_GROUP).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    totals = s.groupBy(_PID, _GROUP).agg(F.sum(value).alias("__total"))
    whole = F.coalesce(F.sum("__total").over(Window.partitionBy(_GROUP)), F.lit(0)).alias("__whole")
    # At most a row per partition and one per group. Stored, so that the planner
    # knows its size: usually it is broadcast and the rows stay where they are.
    offsets = stored(totals.select(_PID, _GROUP, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"), whole),
                     "scan-offsets")
    run = F.col(_LOCAL) + F.col("__before")
    if not inclusive:
        run = run - F.coalesce(F.col(value), F.lit(0))
    more = [F.col("__whole").alias(total)] if total else []
    return s.join(offsets, [_PID, _GROUP]).withColumn(out, run).select(*df.columns, out, *more)


def dense_index(df: DataFrame, order_cols, out: str = "id", start: int = 1,
                group_cols=None) -> DataFrame:
    """Consecutive ids in ``order_cols`` order (``row_number`` without a
    single-partition window). ``order_cols`` should be a total order.

    The scan without sums: a row's place in its sorted partition is Spark's own
    row number there, so the rows don't pass through Python.
    """
    g = _cols(group_cols)
    keys = g + _cols(order_cols)
    d = df.withColumn(_GROUP, _group_key(g)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    s = stored(d.withColumn(_LOCAL, F.monotonically_increasing_id()), "dense-index") \
        .withColumn(_PID, F.shiftright(_LOCAL, 33))                    # the id's upper bits are the partition
    before = Window.partitionBy(_GROUP).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    runs = s.groupBy(_PID, _GROUP).agg(F.count(F.lit(1)).alias("__n"), F.min(_LOCAL).alias("__first"))
    offsets = stored(runs.select(_PID, _GROUP, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__before")),
                     "scan-offsets")
    return s.join(offsets, [_PID, _GROUP]).withColumn(out, (F.col(_LOCAL) + F.col("__before") + start).cast("bigint")) \
        .select(*[c for c in df.columns if c != out], out)


def _label(p: float, c: str) -> str:
    return f"p{int(round(p * 100))}_{c}"


def _stack(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("__metric"), F.col(c).cast("double").alias("__v")) for c in columns
    ])).alias("__m")).select(*keys, "__m.__metric", "__m.__v").where(F.col("__v").isNotNull())


def grouped_percentiles(df: DataFrame, keys, columns, probs=(0.5,), name=_label) -> DataFrame:
    """Exact linearly interpolated percentiles of each column per group.

    Output: ``keys`` + ``name(p, column)`` (default ``p<100*p>_<column>``,
    double). Groups without a value are absent.

    One plan for every size: a histogram (group, value, count) by a partial
    aggregate, the prefix sum of its counts, and the two neighbours of each
    wanted position, ``lo * (1 - f) + hi * f``.
    """
    keys, columns = _cols(keys), _cols(columns)
    gk = [*keys, "__metric"]
    hist = _stack(df, keys, columns).groupBy(*gk, "__v").agg(F.count(F.lit(1)).alias("__n"))
    j = prefix_sum(hist, "__n", "__upto", group_cols=gk, order_cols=["__v"], total="__size")
    out = []
    for c in columns:
        for p in probs:
            pos = F.lit(float(p)) * (F.col("__size") - 1)
            at = lambda r: (F.col("__metric") == c) & (F.col("__upto") > r) & (F.col("__upto") - F.col("__n") <= r)  # noqa: E731, B023
            lo = F.max(F.when(at(F.floor(pos)), F.col("__v")))
            hi = F.max(F.when(at(F.ceil(pos)), F.col("__v")))
            f = F.max(F.when(F.col("__metric") == c, pos - F.floor(pos)))
            out.append(F.when(f == 0, lo).otherwise(lo * (1 - f) + hi * f).alias(name(p, c)))
    return j.groupBy(*keys).agg(*out)


def aggregate_with_percentiles(df: DataFrame, keys, aggs, columns, probs=(0.5,), name=_label) -> DataFrame:
    """``groupBy(keys).agg(*aggs)`` plus exact percentiles of ``columns``."""
    keys, columns = _cols(keys), _cols(columns)
    plain = df.groupBy(*keys).agg(*aggs)
    return join_null_safe(plain, grouped_percentiles(df, keys, columns, probs, name), keys, "left")


def aggregate_with_medians(df: DataFrame, keys, aggs, columns) -> DataFrame:
    """``aggregate_with_percentiles`` at 0.5, columns named ``median_<column>``."""
    return aggregate_with_percentiles(df, keys, aggs, columns, (0.5,), name=lambda p, c: f"median_{c}")


def grouped_median(df: DataFrame, keys, columns, suffix: str = "median_") -> DataFrame:
    """Exact interpolated median of each column per group: ``keys`` +
    ``median_<column>`` (double); groups whose values are all NULL are absent
    (left-join the result to the group table)."""
    return grouped_percentiles(df, keys, columns, (0.5,), name=lambda p, c: suffix + c)
