"""Operator 1: exact deduplication by composable polynomial fingerprints.

Texts (A-Z lower-cased) are cut into byte chunks. Each chunk is hashed by
itself, twice: h(c) = sum of c[i] * B**(len-1-i) modulo 2**31 - 1, for two
bases. Chunks combine by length-shifted arithmetic, h(a + b) = h(a) *
B**len(b) + h(b): every chunk's hash is shifted by the bytes that follow it,
and the shifted terms simply add up in a Spark aggregate. So the chunks of a
huge document may be hashed anywhere, in any order, and no task needs the
whole text in Python.

Rows with equal fingerprint and length are candidates only. Each is compared
with the group's largest id chunk by chunk, in a join on (group, salt, chunk);
the salt splits a group of any size, and the kept row's chunks are repeated
once per salt. Rows that differ (colliding fingerprints) leave the group and
are classed by their SHA-256.

Defined cases: null text counts as empty; of repeated ids with equal texts one
row stays; a null id is smaller than any other; an empty table gives an empty
result; other columns pass through ``exact_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import ascii_lower, scratch, written
from carlot.llm.textarrays import BLOCK, LOWER_TABLE, slices, text_buffer

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 392_252_415)
CHUNK = 1 << 16
#: Group members compared with one copy of the kept row's chunks.
PER_SALT = 256


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    for i in range(1, n):
        out[i] = int(out[i - 1]) * base % PRIME
    return out


def chunk_hashes(buf: np.ndarray, offsets: np.ndarray, base: int, chunk: int = CHUNK) -> np.ndarray:
    """Polynomial hash of every chunk of a batch (at most ``chunk`` bytes each)."""
    lens = np.diff(offsets)
    out = np.zeros(len(lens), dtype=np.uint64)
    full = np.flatnonzero(lens)
    if len(full):
        ln, at = lens[full], offsets[:-1][full]
        back = np.repeat(at + ln, ln) - 1 - np.arange(len(buf))
        # a factor below 2**9, a power below 2**31, at most 2**16 bytes: exact in 64 bits
        out[full] = np.add.reduceat((LOWER_TABLE[buf].astype(np.uint64) + np.uint64(1)) * _powers(base, chunk)[back], at)
    return out % np.uint64(PRIME)


def shifted(h: np.ndarray, suffix: np.ndarray, base: int) -> np.ndarray:
    """``h * base**suffix``: a chunk's share of its document's fingerprint."""
    out = h.copy()
    for i in np.flatnonzero(suffix):
        out[i] = int(h[i]) * pow(base, int(suffix[i]), PRIME) % PRIME
    return out


def hash_terms(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Replace ``chunk`` and ``suffix`` by the chunk's shifted terms t1, t2."""
    for b in batches:
        suffix = b.column("suffix").to_numpy()
        buf, offsets = text_buffer(b.column("chunk"))
        terms = [np.empty(b.num_rows, dtype=np.uint64) for _ in BASES]
        for i, j in slices(offsets, BLOCK):
            part, off = buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            for t, base in zip(terms, BASES, strict=True):
                t[i:j] = shifted(chunk_hashes(part, off, base, chunk), suffix[i:j], base)
        same = [n for n in b.schema.names if n not in ("chunk", "suffix")]
        yield pa.RecordBatch.from_arrays([b.column(n) for n in same] + [pa.array(t.astype(np.int64)) for t in terms],
                                         [*same, "t1", "t2"])


def chunked(binary: Column, size: int) -> Column:
    """Array of (no, chunk) structs; empty data is one empty chunk."""
    last = F.greatest(F.ceil(F.octet_length(binary) / size) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        i.alias("no"), F.substring(binary, i * size + 1, F.lit(size)).alias("chunk")))


def _raw(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit(""))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, fold: int = PRIME) -> DataFrame:
    """(rid, id, tid, n_bytes, sha, f1, f2), one row per input row. ``rid``
    numbers the rows, ``tid`` hashes the raw text. ``fold`` below the prime
    makes fingerprints collide on purpose, for tests."""
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                     _raw(text_col).alias("raw"))
    rows = rows.select("rid", "id", F.xxhash64("raw").alias("tid"), F.octet_length("raw").cast("bigint").alias("n_bytes"),
                       F.unhex(F.sha2(F.encode(ascii_lower(F.col("raw")), "UTF-8"), 256)).alias("sha"),
                       F.encode("raw", "UTF-8").alias("raw"))
    pieces = rows.select("rid", "id", "tid", "n_bytes", "sha", F.inline(chunked(F.col("raw"), chunk)))
    first = F.col("no") == 0
    pieces = pieces.select(
        "rid", *[F.when(first, F.col(c)).alias(c) for c in ("id", "tid", "n_bytes", "sha")],
        F.greatest(F.col("n_bytes") - (F.col("no") + 1) * chunk, F.lit(0)).alias("suffix"), "chunk")
    kinds = "rid bigint, id bigint, tid bigint, n_bytes bigint, sha binary, t1 bigint, t2 bigint"
    terms = pieces.mapInArrow(lambda it: hash_terms(it, chunk), kinds)
    fp = lambda t: F.sum(t) % F.lit(PRIME) % F.lit(fold)
    return terms.groupBy("rid").agg(*[F.max(c).alias(c) for c in ("id", "tid", "n_bytes", "sha")],
                                    fp("t1").alias("f1"), fp("t2").alias("f2"))


GROUP = ["n_bytes", "f1", "f2"]


def mismatches(df: DataFrame, prints: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               chunk: int = CHUNK) -> DataFrame:
    """(id, tid) of the rows that differ from the largest id of their group,
    found by comparing chunk with chunk."""
    groups = written(prints.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "rid", "tid")).alias("top")).where("n > 1"), "fp-groups")
    members = prints.join(groups, GROUP).select(
        "id", "tid", F.xxhash64(*GROUP).alias("gid"), F.ceil(F.col("n") / PER_SALT).cast("int").alias("salts"),
        ((F.col("top.tid") == F.col("tid")) & F.col("top.id").eqNullSafe(F.col("id"))).alias("is_top")).distinct()
    members = written(members, "fp-members")
    texts = df.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.xxhash64(_raw(text_col)).alias("_tid"),
                      _raw(text_col).alias("raw"))
    # Always by exchange: the cost stays linear as the members outgrow a broadcast.
    found = members.hint("merge").join(texts, (F.col("tid") == F.col("_tid")) & F.col("id").eqNullSafe(F.col("_id")))
    pieces = found.select("id", "tid", "gid", "salts", "is_top",
                          F.inline(chunked(F.encode(ascii_lower(F.col("raw")), "UTF-8"), chunk)))
    pieces = written(pieces, "fp-chunks")
    kept = pieces.where("is_top").select(
        "gid", "no", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("chunk").alias("top_chunk"))
    other = pieces.where("not is_top").withColumn(
        "salt", F.pmod(F.xxhash64("id", "tid"), F.col("salts").cast("bigint")).cast("int"))
    # equal lengths: both sides have the same chunk numbers
    return other.join(kept, ["gid", "salt", "no"]).where(F.col("chunk") != F.col("top_chunk")).select("id", "tid").distinct()


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            chunk: int = CHUNK, fold: int = PRIME) -> DataFrame:
    """(id, tid, keep_id, group_size, kept, sha), one row per input row."""
    prints = written(fingerprints(df, id_col, text_col, chunk, fold), "fingerprints")
    with scratch():
        odd = written(mismatches(df, prints, id_col, text_col, chunk).select(
            F.col("id").alias("_id"), F.col("tid").alias("_tid"), F.lit(True).alias("odd")), "fp-mismatches", keep=True)
    marked = prints.join(odd, (F.col("tid") == F.col("_tid")) & F.col("id").eqNullSafe(F.col("_id")), "left")
    marked = marked.withColumn("rest", F.when(F.col("odd"), F.col("sha")).otherwise(F.lit(b""))).drop("_id", "_tid", "odd")
    key = [*GROUP, "rest"]
    # written, so that the join below reads plain exchanges, whose hot keys Spark splits
    tops = written(marked.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "rid")).alias("top")),
                   "fp-classes")
    return marked.join(tops, key).select(
        "id", "tid", F.col("top.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("top.rid")).alias("kept"), "sha")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    stay = classes(df, id_col, text_col).where("kept").select(F.col("id").alias("__stay"), F.col("tid").alias("__stay_tid"))
    d = df.withColumns({"__fp_id": F.col(f"`{id_col}`").cast("bigint"), "__fp_tid": F.xxhash64(_raw(text_col))})
    one = d.join(stay, F.col("__fp_id").eqNullSafe(F.col("__stay")) & (F.col("__fp_tid") == F.col("__stay_tid")))
    # rows repeated with the same id and text: one of them stays
    return one.dropDuplicates(["__fp_id", "__fp_tid"]).drop("__fp_id", "__fp_tid", "__stay", "__stay_tid")


def dedup_report(docs: DataFrame) -> DataFrame:
    """Digest: what became of every document."""
    return classes(docs).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                                F.lower(F.hex("sha")).alias("text_sha256"))
