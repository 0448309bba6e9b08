"""Keyed state: first/last-wins selection, anti-join, surrogate ids, upsert.

First-wins and last-wins are ``groupBy(key).agg(min_by/max_by(struct, order))``:
a partial aggregate, so a key holding a third of the rows is reduced
map-side instead of being sorted inside one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.operators.scans import dense_index


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _order_struct(order_cols) -> Column:
    return F.struct(*[F.col(c) for c in _cols(order_cols)])


def first_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """The earliest row of each key in ``order_cols`` order."""
    keys = _cols(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), _order_struct(order_cols)).alias("__r"))
    return agg.select(*keys, "__r.*")


def last_per_key(df: DataFrame, keys, order_cols, keep=None) -> DataFrame:
    """F12 batch collapse / F13: the latest row of each key, with the columns
    ``keep`` (default: all; those that only order needn't be shuffled twice)."""
    keys = _cols(keys)
    rest = [c for c in (df.columns if keep is None else keep) if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), _order_struct(order_cols)).alias("__r"))
    return agg.select(*keys, "__r.*")


def new_keys_only(batch: DataFrame, known: DataFrame, keys) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``known`` (left anti join).

    ``known`` is the key table (possibly large): no broadcast hint, AQE
    broadcasts it only when its measured size is small.
    """
    keys = _cols(keys)
    return batch.join(known.select(*keys).dropDuplicates(), keys, "left_anti")


def known_keys(target: DataFrame, source: str | None = None, key: str = "advert_id",
               source_col: str = "source") -> DataFrame:
    """A10: key scan of the target, optionally for one source."""
    t = target if source is None else target.where(F.col(source_col) == source)
    return t.select(source_col, key).dropDuplicates()


def surrogate_ids(df: DataFrame, order_cols, out: str = "local_id", start: int = 1) -> DataFrame:
    """consecutive ids in a deterministic order, without a global
    single-partition window (distributed prefix count)."""
    return dense_index(df, order_cols, out=out, start=start)


def key_history(log: DataFrame, keys, ts: str) -> DataFrame:
    """K3: first and last sighting per key from a replayed log."""
    return log.groupBy(*_cols(keys)).agg(F.min(ts).alias("first_seen_at"), F.max(ts).alias("last_seen_at"))


def latest_with_history(log: DataFrame, keys, order_cols, ts: str, keep=None) -> DataFrame:
    """F12/K3 in one aggregate: the latest row of each key (with the columns
    ``keep``, default all) and its first and last sighting."""
    keys = _cols(keys)
    rest = [c for c in (log.columns if keep is None else keep) if c not in keys]
    agg = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), _order_struct(order_cols)).alias("__r"),
                                 F.min(ts).alias("first_seen_at"), F.max(ts).alias("last_seen_at"))
    return agg.select(*keys, "__r.*", "first_seen_at", "last_seen_at")


def upsert(target: DataFrame, batch: DataFrame, keys, columns, run_ts,
           order_cols=None, coalesce_missing: bool = False) -> DataFrame:
    """Keyed upsert as a set operation.

    * the batch is collapsed to one row per key (last by ``order_cols`` wins);
    * keys in the batch take every column in ``columns`` from it (columns the
      batch lacks become NULL unless ``coalesce_missing``), ``first_seen_at``
      is kept from the target, ``last_seen_at`` becomes ``run_ts``;
    * keys only in the target are unchanged.

    Returns the whole new table; write it to a folder of its own, never over
    the one ``target`` reads.
    """
    keys = _cols(keys)
    run_ts = F.lit(run_ts) if not isinstance(run_ts, Column) else run_ts
    b = batch
    for c in columns:
        if c not in b.columns:
            b = b.withColumn(c, F.lit(None).cast(target.schema[c].dataType) if c in target.columns
                             else F.lit(None))
    if order_cols:
        b = last_per_key(b.select(*keys, *columns, *[c for c in _cols(order_cols) if c not in columns]),
                         keys, order_cols)
    b = b.select(*keys, *columns).withColumn("__in_batch", F.lit(True))
    t = target.alias("t")
    j = t.join(b.alias("b"), keys, "full_outer")
    hit = F.col("__in_batch").isNotNull()
    out = [F.col(k) for k in keys]
    for c in columns:
        if coalesce_missing and c not in batch.columns:
            out.append(F.col(f"t.{c}").alias(c))
        else:
            out.append(F.when(hit, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    out.append(F.coalesce(F.col("t.first_seen_at"), run_ts).alias("first_seen_at"))
    out.append(F.when(hit, run_ts).otherwise(F.col("t.last_seen_at")).alias("last_seen_at"))
    return j.select(*out)


def assign_new_ids(table: DataFrame, keys, id_col: str = "id", start: int = 1) -> DataFrame:
    """Give rows without an ``id`` consecutive ids after the current maximum
    (serial-key behaviour), ordered by key; from ``start`` when there is none."""
    keys = _cols(keys)
    have = table.where(F.col(id_col).isNotNull())
    new = table.where(F.col(id_col).isNull()).drop(id_col)
    base = have.agg(F.coalesce(F.max(id_col), F.lit(start - 1)).alias("__base"))  # one row
    new = dense_index(new, keys, out="__k", start=1)
    # ``base`` is a one-row global aggregate: a proven size bound.
    new = new.withColumn("__one", F.lit(1)).join(F.broadcast(base.withColumn("__one", F.lit(1))), "__one")
    new = new.withColumn(id_col, (F.col("__base") + F.col("__k")).cast("bigint")).drop("__base", "__k", "__one")
    return have.unionByName(new.select(*have.columns))
