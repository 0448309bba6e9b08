"""Operator 8: benchmark decontamination by spaced-seed hashing.

A seed is the hash of the words that a fixed mask keeps, at some position; the
words under the mask's gaps may differ. Seeds of all benchmark items are held
against the seeds at every position of every document, and around each hit the
item is laid over the document and compared word by word. A pair counts when a
stretch of ``WINDOW`` words of the item (the whole item, if shorter) agrees
with the document in at least ``SHARE`` percent of its places, or when ``RUN``
words of the item in a row stand in the document unchanged. Items under
``LEAST_TOLERANT`` words must agree in every place. Items shorter than the
masks are looked up whole. Very short items occur by chance; ``least_words``
leaves out items with fewer words, which by default are only those without any.

The masks together hit every pattern of substitutions that this rule allows
(a test tries them all), and the mask without gaps hits every run, so the seeds
lose no pair.

The benchmark is the query set. It is taken in blocks of at most
``BLOCK_WORDS`` words, each a fixed-bound table that travels in the task
closure; the documents are read once for each block, in a narrow Arrow step,
and never shuffled.

Defined cases: null or empty texts have no words and match nothing; repeated
rows each give their own row; an empty table or benchmark gives no row; other
columns pass through ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.textarrays import SHINGLE_KEYS, mix, slices, text_buffer, words
from carlot.session import ship_package

#: Kept places of each mask (fixed values).
MASKS: tuple[tuple[int, ...], ...] = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 4, 6, 7))
WINDOW = 20
SHARE = 80
RUN = 13
LEAST_TOLERANT = 10
#: Items with fewer words are shorter than the masks' weight.
WEIGHT = 5
LEAST_WORDS = 1
BLOCK_WORDS = 500_000
_FILTER_BITS = 22


def seed_hashes(hashes: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """The seed at every position where the mask fits."""
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = np.full(n, SHINGLE_KEYS[40 + salt], dtype=np.uint64)
    for k, i in enumerate(mask):
        acc += hashes[i:i + n] * SHINGLE_KEYS[k]
    return mix(acc)


def least_agreeing(n: int) -> int:
    """Places that must agree in a stretch of ``n`` words."""
    return n if n < LEAST_TOLERANT else -(-n * SHARE // 100)


def longest_run(same: np.ndarray) -> int:
    """The most agreeing places in a row."""
    turns = np.flatnonzero(np.diff(np.concatenate([[0], same, [0]])))
    return int((turns[1::2] - turns[::2]).max(initial=0))


class SeedTable:
    """Seeds of one block of items: sorted hashes with item and place, and a
    bit filter over the hashes' top bits."""

    def __init__(self, item_ids: list[int], texts: pa.Array, least_words: int = LEAST_WORDS):
        buf, offsets = text_buffer(texts)
        hashes, at = words(buf, offsets)
        self.item_ids = item_ids
        self.words = [hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        found = []
        short = sorted({len(w) for w in self.words if max(1, least_words) <= len(w) < WEIGHT})
        self.masks = list(enumerate((*MASKS, *[tuple(range(n)) for n in short])))
        whole = dict(zip(short, self.masks[len(MASKS):], strict=True))
        for i, w in enumerate(self.words):
            if len(w) < max(1, least_words):
                continue
            for salt, mask in [whole[len(w)]] if len(w) < WEIGHT else self.masks[:len(MASKS)]:
                s = seed_hashes(w, mask, salt)
                found.append((s, np.full(len(s), i), np.arange(len(s))))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.uint64)] + [np.empty(0, np.int64)] * 2
        order = np.argsort(cols[0], kind="stable")
        self.seeds, self.item, self.place = (c[order] for c in cols)
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.seeds >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, place) of all equal seeds."""
        out = []
        for salt, mask in self.masks:
            s = seed_hashes(hashes, mask, salt)
            pos = np.flatnonzero(self.filter[s >> np.uint64(64 - _FILTER_BITS)])
            lo, hi = np.searchsorted(self.seeds, s[pos], "left"), np.searchsorted(self.seeds, s[pos], "right")
            n = hi - lo
            row = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((np.repeat(pos, n), self.item[row], self.place[row]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def overlaps(self, hashes: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, first word, agreeing words) of all alignments that
        count, for the texts whose words ``at`` bounds in ``hashes``."""
        pos, item, place = self.hits(hashes)
        doc = np.searchsorted(at, pos, "right") - 1
        lay = np.unique(np.stack([doc, item, pos - place - at[doc]], axis=1), axis=0)
        out = []
        for d, i, start in lay.tolist():
            w, text = self.words[i], hashes[at[d]:at[d + 1]]
            if len(w) < WEIGHT and not 0 <= start <= len(text) - len(w):
                continue
            same = np.zeros(len(w), dtype=np.int64)
            lo, hi = max(0, -start), min(len(w), len(text) - start)
            if lo >= hi:                          # a seed across two texts
                continue
            same[lo:hi] = w[lo:hi] == text[start + lo:start + hi]
            n = min(WINDOW, len(w))
            total = np.concatenate([[0], np.cumsum(same)])
            best = int((total[n:] - total[:-n]).max())
            if best >= least_agreeing(n) or (best >= RUN and longest_run(same) >= RUN):
                out.append((d, i, start, best))
        return out


def tables(benchmark: DataFrame, block_words: int = BLOCK_WORDS, least_words: int = LEAST_WORDS) -> Iterator[SeedTable]:
    """The benchmark's seed tables, a block of bounded size at a time."""
    ship_package(benchmark.sparkSession)
    b = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = b.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (4 * block_words)))    # a word and its blank take about four bytes or more
    for k in range(blocks):
        t = b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()
        yield SeedTable(t.column("item_id").to_pylist(), t.column("text").combine_chunks(), least_words)


def _scan(batches: Iterator[pa.RecordBatch], table: SeedTable, text_col: str):
    for b in batches:
        buf, offsets = text_buffer(b.column(text_col))
        for i, j in slices(offsets):
            hashes, at = words(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield b, i, j, table.overlaps(hashes, at)


def overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS,
             least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, item_id, n_places, first_word, best): a row per document and
    item that overlap: alignments that count, the first one's first word in
    the document, and the most agreeing words in a stretch."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = None
    for table in tables(benchmark, block_words, least_words):
        shared = docs.sparkSession.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table = shared.value
            for b, i, _, found in _scan(batches, table, "text"):
                pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for row, item, start, best in found:
                    pairs.setdefault((row, item), []).append((start, best))
                rows = [(b.column("doc_id")[i + r].as_py(), table.item_ids[k], len(v), min(v)[0], max(x[1] for x in v))
                        for (r, k), v in pairs.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                                     ["doc_id", "item_id", "n_places", "first_word", "best"])

        part = d.mapInArrow(run, "doc_id bigint, item_id bigint, n_places bigint, first_word bigint, best bigint")
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      block_words: int = BLOCK_WORDS, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents that overlap no benchmark item, with all their columns."""
    for table in tables(benchmark, block_words, least_words):
        shared = docs.sparkSession.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b, i, j, found in _scan(batches, shared.value, text_col):
                keep = np.ones(j - i, dtype=bool)
                keep[[f[0] for f in found]] = False
                yield b.slice(i, j - i).filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
