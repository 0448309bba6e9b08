"""Operator 9: weighted rendezvous sharding by a stable record key.

Every (key, shard) pair draws u in (0, 1) from a keyed md5; the shard with the
least ``-ln(u) / weight`` takes the row. A shard's draw depends on nothing but
the key and the shard's name, so a new shard takes rows only into itself, and
the share of rows that move equals its share of the weight. md5 is used since
any engine can recompute the placement.

The place inside the shard (``slot``, gapless from 0) comes from a two-level
count: rows are cut into fixed hash buckets inside their shard, each bucket is
numbered by itself, and bucket offsets come from a table of at most
shards x buckets rows. No task orders a whole shard.

Defined cases: a null key is a key of its own (all such rows share a shard);
null text has size 8 and crc32 0; repeated rows share a shard and take
different slots; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carlot.llm.common import replaced

SHARDS = 24
#: Hex digits of the bucket: 16 ** 3 buckets in each shard.
BUCKET_DIGITS = 3


def _key(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def _cost(key: Column, shard: Column, weight: Column, seed: str) -> Column:
    # 52 bits of the md5 of "seed:shard:key", as u in (0, 1).
    h = F.substring(F.md5(F.concat(F.lit(seed + ":"), shard.cast("string"), F.lit(":"), key)), 1, 13)
    u = (F.conv(h, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def pick_shard(key: Column, weights: dict[int, float], seed: str = "shard") -> Column:
    """The shard of ``key`` among ``{shard id: weight}`` (weights above 0)."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("shard weights must be above 0")
    table = F.array(*[F.struct(F.lit(int(s)).alias("s"), F.lit(float(w)).alias("w")) for s, w in weights.items()])
    best = F.array_min(F.transform(table, lambda x: F.struct(
        _cost(_key(key), x["s"], x["w"], seed).alias("cost"), x["s"].alias("s"))))
    return best["s"]


def assign_shards(df: DataFrame, key_col: str = "doc_id", weights: dict[int, float] | None = None,
                  seed: str = "shard", out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row in ``out``; a narrow step."""
    weights = weights or dict.fromkeys(range(SHARDS), 1.0)
    return replaced(df, **{out: pick_shard(F.col(key_col), weights, seed)})


def number_slots(df: DataFrame, shard_col: str, order: list[str], out: str = "slot") -> DataFrame:
    """``df`` with a gapless 0-based number of each row inside its shard, in
    the order of the md5 of the ``order`` columns (ties: the columns)."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order]))
    d = df.withColumn("__h", h).withColumn("__bucket", F.substring("__h", 1, BUCKET_DIGITS))
    sizes = d.groupBy(shard_col, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = (Window.partitionBy(shard_col).orderBy("__bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(shard_col, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(shard_col, "__bucket").orderBy("__h", *order)
    numbered = d.withColumn("__rn", F.row_number().over(inside).cast("bigint") - 1)
    j = numbered.join(offsets, [shard_col, "__bucket"])
    return replaced(j, **{out: F.col("__rn") + F.col("__off")}).select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()], out)


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Digest: placement of every document over ``shards`` equal shards, and
    where it would go with one shard more."""
    raw = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", (F.octet_length(raw) + 8).cast("bigint").alias("size"),
                    F.crc32(F.encode(raw, "UTF-8")).alias("text_crc32"))
    d = assign_shards(d, "doc_id", dict.fromkeys(range(shards), 1.0))
    d = assign_shards(d, "doc_id", dict.fromkeys(range(shards + 1), 1.0), out="grown_shard")
    d = number_slots(d, "shard", ["doc_id", "size", "text_crc32"])
    return d.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
