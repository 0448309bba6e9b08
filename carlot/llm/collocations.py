"""Operator 12: collocations, phrases of two or three words that score high.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and
those into words; everything is counted per language. The steps:

1. Rabin-Karp fingerprints: over a block of texts, numpy prefix polynomials of the
   word hashes give the 64-bit fingerprint of every run of one, two or three
   words of a piece as a difference of two prefixes, shifted back to the origin.
2. Which fingerprints can be frequent is found first, words, then pairs whose
   words both can: the shuffle deals packed (fingerprint, times) numbers by ranges
   of fingerprints, a task sums those of a range, and the frequent ones become a
   bitmap of fixed size (``BITS``), which each task gets. A phrase is no more
   frequent than its parts and a bitmap has no false negatives, so nothing
   frequent is lost.
3. What the bitmaps let through, triples of two such pairs included, is shuffled
   as (fingerprint, times, occurrence pointer), an entry for each block, and with 32
   bits of a second fingerprint of other word hashes. Within a block the occurrences
   of a fingerprint were compared word by word and differing ones have an entry of
   their own. Summed by both fingerprints, so that phrases which share only the
   first part, those that reach the least count keep two pointers: to the
   documents of least and of greatest key that hold one.
4. The pointers go to their documents and become the phrases that stand there. The
   two of a fingerprint must be one phrase, else the query ends in an error; only
   frequent phrases ever exist as text.
5. Scores, containment and the best of each language by joins on the phrases.

A pointer is a 64-bit key of (id, language, text), the word's place and the number
of words; two different documents with one key, or two phrases that agree in both
fingerprints (96 bits) and are met at the pointers, are an error.

Defined cases: null texts are empty, a null language is ``und``; rows that repeat
an id or a text count again; words longer than a piece don't exist; an empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carlot.llm.common import brief_shuffles, written
from carlot.llm.textarrays import LOWER_TABLE, U64, mix, text_buffer, word_hashes, word_spans
from carlot.session import ship_package

WORDS = 3
LEAST = 10
#: A candidate goes if a longer one that holds it is found in so many percent of its places.
INSIDE = 50
TOP = 2000
UNKNOWN = "und"
#: Bits of a bitmap of frequent fingerprints: 16 MB.
BITS = 27
#: Text bytes of a block where fingerprints are counted, and where pointers are taken.
BLOCK, POINTING = 12 << 20, 7 << 20
#: Text bytes whose runs a range of fingerprints gets: the number of ranges follows
#: the input, so that one fits a task at every size.
PART = 32 << 20
#: Base of the prefix polynomials and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
#: Words whose fingerprints are taken at once, and entries of a range that are summed
#: at once: work arrays follow these, not the block or the range.
STRETCH, SHARE = 1 << 16, 1 << 19

IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[9, 32, *range(10, 14), *map(ord, ".,;:!?")]] = False
#: Bytes that end a piece.
ENDS = np.zeros(256, dtype=bool)
ENDS[[*range(10, 14), *map(ord, ".,;:!?")]] = True


#: Bytes under other names, for the second word hash.
OTHER = np.arange(256, dtype=np.uint8) ^ np.uint8(0x5A)


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        out = np.full(1 << max(10, int(n).bit_length()), U64(base))
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


def fingerprints(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of every run of ``n`` words, by prefix polynomials."""
    out = np.empty(max(0, len(hashes) - n + 1), dtype=np.uint64)
    for i in range(0, len(out), STRETCH):
        some = hashes[i:i + STRETCH + n - 1]
        prefix = np.zeros(len(some) + 1, dtype=np.uint64)
        np.cumsum(some * powers(BASE, len(some)), out=prefix[1:])
        m = len(some) - n + 1
        out[i:i + m] = mix((prefix[n:n + m] - prefix[:m]) * powers(INVERSE, m) + U64(n))
    return out


def owned(runs: np.ndarray, own: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """``runs`` mixed, in place, with the number ``own`` of each one's document."""
    for i in range(0, len(runs), STRETCH):
        runs[i:i + STRETCH] = mix(runs[i:i + STRETCH] ^ own[doc[i:i + STRETCH]])
    return runs


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): an order that sorts ``keys`` and where its groups begin. The
    lowest bits make room for the row's number, so that one plain sort does; keys
    that differ there only share a group, as those do that collide."""
    n = U64((1 << len(keys).bit_length()) - 1)
    s = np.sort((keys & ~n) | np.arange(len(keys), dtype=np.uint64))
    order = (s & n).astype(np.int64)
    s &= ~n
    return order, np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else order


class Block:
    """The words of a block of texts: ``start`` and ``end`` bytes, ``doc`` and
    ``place`` in it, ``piece``, the keys (language and fingerprint) of
    its runs and their checks."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lang: list, fold: int):
        self.low = LOWER_TABLE[buf]
        start, end, at = word_spans(self.low, offsets, IN_WORD)
        small = np.int32 if len(buf) < 1 << 31 else np.int64
        self.start, self.end = start, end = start.astype(small), end.astype(small)
        self.hash = word_hashes(self.low, start, end)
        self.doc = np.repeat(np.arange(len(offsets) - 1, dtype=small), np.diff(at))
        self.place = np.arange(len(start), dtype=small) - np.repeat(at[:-1].astype(small), np.diff(at))
        self.piece = np.searchsorted(np.flatnonzero(ENDS[self.low]).astype(small), self.start).astype(small)
        names = sorted(set(lang))
        number = {x: i for i, x in enumerate(names)}
        self.lang = np.array([number[x] for x in lang], np.int64)
        self.lang_hash = np.array([_name_hash(x) for x in names], np.uint64)
        self.fold = U64(fold)
        self.other = None
        self._keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def keys(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(key, valid) of the runs of ``n`` words; a run must lie in one piece."""
        if n not in self._keys:
            runs = fingerprints(self.hash, n)
            m = len(runs)
            valid = (self.doc[:m] == self.doc[n - 1:n - 1 + m]) & (self.piece[:m] == self.piece[n - 1:n - 1 + m])
            runs = owned(runs, mix(self.lang_hash + U64(n))[self.lang], self.doc[:m])
            runs &= self.fold
            self._keys[n] = runs, valid
        return self._keys[n]

    def forget(self, n: int) -> None:
        self._keys.pop(n, None)

    def checks(self, n: int) -> np.ndarray:
        """32 bits of a second, independent fingerprint of the runs of ``n`` words."""
        if self.other is None:
            self.other = word_hashes(OTHER[self.low], self.start, self.end)
        runs = fingerprints(self.other, n)
        return owned(runs, mix(self.lang_hash ^ U64(n))[self.lang], self.doc[:len(runs)]).astype(np.uint32)

    def same_word(self) -> np.ndarray:
        """For every word one word of the block with the same bytes, the same for
        all of these."""
        out = np.arange(len(self.start))
        lens = (self.end - self.start).astype(np.int64)
        padded = np.concatenate([self.low, np.zeros(8, np.uint8)])
        head = np.lib.stride_tricks.sliding_window_view(padded, 8)[self.start].reshape(-1).view(np.uint64)
        head = head & _HEADS[np.minimum(lens, 8)]
        todo = out.copy()
        while len(todo):
            order, first = grouped(self.hash[todo])
            todo = todo[order]
            rep = np.repeat(todo[first], np.diff(np.append(first, len(todo))))
            equal = (lens[todo] == lens[rep]) & (head[todo] == head[rep])
            ok = np.flatnonzero(equal & (todo != rep) & (lens[todo] > 8))
            for i in range(0, len(ok), 1 << 16):
                x, y = todo[ok[i:i + (1 << 16)]], rep[ok[i:i + (1 << 16)]]
                size = lens[x] - 8
                total = np.cumsum(size)
                inner = np.arange(total[-1]) - np.repeat(total - size, size) + 8
                wrong = self.low[inner + np.repeat(self.start[x], size)] != self.low[inner + np.repeat(self.start[y], size)]
                equal[ok[i:i + (1 << 16)]] = np.add.reduceat(wrong, total - size) == 0
            out[todo[equal]] = rep[equal]
            todo = todo[~equal]
        return out


#: Masks of the first 0 to 8 bytes of a little-endian word.
_HEADS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def _name_hash(x: str) -> int:
    raw = np.frombuffer(x.encode(), np.uint8)
    return int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]) if len(raw) else 0


def blocks(batches: Iterator[pa.RecordBatch], size: int, fold: int) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Batches joined or cut to blocks of about ``size`` bytes of text."""
    held: list[pa.RecordBatch] = []
    n = 0

    def whole() -> Iterator[tuple[pa.RecordBatch, Block]]:
        b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        buf, offsets = text_buffer(b.column("text"))
        yield b, Block(buf, offsets, b.column("lang").to_pylist(), fold)

    for b in batches:
        _, offsets = text_buffer(b.column("text"))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size - n, "right")) - 1)
            if held and n + offsets[j] - offsets[i] > size:
                j = i
            else:
                held.append(b.slice(i, j - i))
                n += int(offsets[j] - offsets[i])
            if j < b.num_rows or n >= size:
                yield from whole()
                held, n = [], 0
            i = j
    if held:
        yield from whole()


def passes(bitmap: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    if bitmap is None:
        return np.ones(len(keys), bool)
    out = np.empty(len(keys), bool)
    for i in range(0, len(keys), STRETCH):
        bit = keys[i:i + STRETCH] >> U64(64 - BITS)
        out[i:i + STRETCH] = (bitmap[bit >> U64(3)] >> (bit & U64(7)).astype(np.uint8)) & 1
    return out


def allowed(block: Block, n: int, words, pairs) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) of the runs of ``n`` words whose parts can be frequent."""
    keys, valid = block.keys(n)
    if n == 2 and words is not None and len(keys):
        one = passes(words, block.keys(1)[0])
        valid = valid & one[:-1] & one[1:]
    if n == 3 and pairs is not None and len(keys):
        two = passes(pairs, block.keys(2)[0])
        valid = valid & two[:-1] & two[1:]
    at = np.flatnonzero(valid)
    return keys[at], at


def _narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest needs."""
    top = int(x.max(initial=0))
    return x.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)).tobytes()


def _ranges(keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """The ranges of fingerprints that sorted ``keys`` have, with their rows."""
    edges = np.searchsorted(keys >> U64(64 - BITS), np.arange(parts + 1, dtype=np.uint64) * U64((1 << BITS) // parts))
    for i in np.flatnonzero(np.diff(edges)).tolist():
        yield i, slice(int(edges[i]), int(edges[i + 1]))


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    """(part, bytes, ...) rows as a batch."""
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                      ["part", *[f"c{i}" for i in range(len(cols) - 1)]])


def pack(batches: Iterator[pa.RecordBatch], n: int, words, fold: int, size: int, parts: int) -> Iterator[pa.RecordBatch]:
    """A number for each fingerprint of a block: its upper 60 bits and its times,
    15 at most (whether the sum reaches LEAST isn't changed by that)."""
    def counted(block: Block) -> list[tuple]:
        keys = allowed(block, n, words.value if words else None, None)[0]
        block.forget(1)
        block.forget(n)
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.arange(0)
        times = np.minimum(np.diff(first, append=len(keys)), 15).astype(np.uint64)
        u = keys[first]
        times |= u & ~U64(15)
        return [(i, times[at].tobytes()) for i, at in _ranges(u, parts)]

    for _, block in blocks(batches, size, fold):
        rows = counted(block)
        del block                                 # before the next one is made
        if rows:
            yield _blobs(rows)


def _shares(keys: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The entries of a range, dealt by the lowest bits of their fingerprints into shares
    of about ``SHARE`` that are summed one by one: the rows of each of ``keys``."""
    many = 1 << (sum(map(len, keys)) // SHARE).bit_length()
    for i in range(many):
        yield [np.flatnonzero(k & U64(many - 1) == i) for k in keys]


def frequent_bits(part: int, t: pa.Table, least: int, parts: int) -> pa.Table:
    """The share of the bitmap of one range of fingerprints."""
    held = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["c0"]]
    bits = np.zeros((1 << BITS) // parts, bool)
    for rows in _shares([x >> U64(4) for x in held]):
        packed = np.sort(np.concatenate([x[at] for x, at in zip(held, rows, strict=True)]))
        if not len(packed):
            continue
        keys = packed >> U64(4)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        many = keys[first[np.add.reduceat((packed & U64(15)).astype(np.int64), first) >= least]]
        bits[(many >> U64(60 - BITS)) - U64(part * len(bits))] = True
    return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def point(batches: Iterator[pa.RecordBatch], words, pairs, fold: int, size: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Fingerprint, check, times, document and place (``at``: four times the word's
    place plus the number of words) of each run of words of a block, one entry for
    each content, that points to one of its occurrences. Runs of no word stand for
    all words of a language."""
    def pointed(doc_key: np.ndarray, block: Block) -> list[tuple]:
        word = block.same_word()
        first = np.unique(block.lang, return_index=True)[1]
        out = [[mix(block.lang_hash) & block.fold], [np.bincount(block.lang[block.doc], minlength=len(first))], [first], [first * 0],
               [mix(~block.lang_hash).astype(np.uint32)]]
        for n in range(1, WORDS + 1):
            keys, at = allowed(block, n, words.value, pairs.value)
            if n < 3:
                can = passes(words.value if n == 1 else pairs.value, keys)
                keys, at = keys[can], at[can]
            check = block.checks(n)
            while len(keys):
                order, lead = grouped(keys)
                keys, at = keys[order], at[order]
                rep = np.repeat(at[lead], np.diff(np.append(lead, len(at))))
                same = block.lang[block.doc[at]] == block.lang[block.doc[rep]]
                for k in range(n):
                    same &= word[at + k] == word[rep + k]
                for x, y in zip(out, (keys[lead], np.add.reduceat(same.astype(np.int64), lead), block.doc[at[lead]],
                                      block.place[at[lead]].astype(np.int64) * 4 + n, check[at[lead]]), strict=True):
                    x.append(y)
                keys, at = keys[~same], at[~same]
            block.forget(n - 1)
        block.forget(WORDS)
        keys = np.concatenate(out[0])
        order = grouped(keys)[0]
        times, doc, at, check = (np.concatenate(x)[order] for x in out[1:])
        keys, rows = keys[order], []
        for i, r in _ranges(keys, parts):
            held, number = np.unique(doc[r], return_inverse=True)
            rows.append((i, keys[r].tobytes(), check[r].tobytes(), _narrow(times[r]), _narrow(at[r]), _narrow(number), doc_key[held].tobytes()))
        return rows

    for b, block in blocks(batches, size, fold):
        rows = pointed(b.column("doc").to_numpy(), block)
        del b, block                              # before the next one is made
        yield _blobs(rows)


_POINTERS = "doc bigint, at bigint, times bigint, key bigint, check int"


def frequent_pointers(t: pa.Table, least: int) -> pa.Table:
    """Of a range of fingerprints, those (with their checks) whose times reach
    ``least``: pointers to two places, in the documents of least and of greatest
    key, the first of which carries the times."""
    held = []
    for blobs in zip(*(t[f"c{i}"] for i in range(6)), strict=True):
        raw = [np.frombuffer(x.as_buffer(), np.uint8) for x in blobs]
        n = len(raw[0]) // 8
        held.append([*(x.view(f"u{len(x) // n}") for x in raw[:5]), raw[5].view(np.int64)])
    return pa.concat_tables(_best_of([[c[at] for c in x[:5]] + [x[5]] for x, at in zip(held, rows, strict=True)], least)
                            for rows in _shares([x[0] for x in held]))


def _best_of(held: list[list[np.ndarray]], least: int) -> pa.Table:
    """``frequent_pointers`` of one share."""
    key, check, times, at, doc = (np.concatenate(c) for c in zip(*(
        (key, check, times.astype(np.int64), at.astype(np.int64), docs[number]) for key, check, times, at, number, docs in held), strict=True))
    order = np.lexsort((check, key))
    k, c = key[order], check[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])) if len(k) else np.arange(0)
    sums = np.add.reduceat(times[order], first) if len(k) else times
    size = np.diff(np.append(first, len(order)))
    stay = np.repeat(sums >= least, size)
    order, group, sums, size = order[stay], np.repeat(np.arange(np.count_nonzero(sums >= least)), size[sums >= least]), sums[sums >= least], size[sums >= least]
    order = order[np.lexsort((at[order], doc[order], group))]
    low = np.cumsum(size) - size
    high = (low + size - 1)[size > 1]
    at_ = order[np.concatenate([low, high])]
    return pa.table([pa.array(doc[at_]), pa.array(at[at_]), pa.array(np.concatenate([sums, high * 0])),
                     pa.array(key[at_].view(np.int64)), pa.array(check[at_].view(np.int32))], ["doc", "at", "times", "key", "check"])


_PHRASES = "key bigint, check int, lang string, words int, phrase string, times bigint"


_TOLD = ["doc", "at", "text", "lang", "times", "key", "check"]


def read_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases behind pointers, in a stream sorted by (doc, at) where each
    document stands before its pointers (at -1)."""
    doc = text = lang = None
    words: list[str] = []

    def cut(t: str) -> list[str]:
        raw = np.frombuffer(t.encode(), np.uint8)
        low = LOWER_TABLE[raw]
        s, e, _ = word_spans(low, np.array([0, len(low)]), IN_WORD)
        data = low.tobytes()
        return [data[i:j].decode() for i, j in zip(s.tolist(), e.tolist(), strict=True)]

    for b in batches:
        rows: list[tuple] = []
        for d, at, t, own, times, key, check in zip(*(b.column(c).to_pylist() for c in _TOLD), strict=True):
            if at < 0:
                if d == doc and (t, own) != (text, lang):
                    raise ValueError("two documents have one 64-bit key")
                if d != doc:
                    doc, text, lang, words = d, t, own, []
                continue
            if d != doc:
                raise ValueError("a pointer without its document")
            if at and not words:
                words = cut(text)
            i, n = divmod(at, 4)
            rows.append((key, check, lang, n, " ".join(words[i:i + n]), times))
        if rows:
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["key", "check", "lang", "words", "phrase", "times"])


def bitmap_of(packed: DataFrame, least: int, parts: int) -> np.ndarray:
    """Bits of the fingerprints whose times reach ``least``. The driver gets the
    bitmap, 16 MB, never the fingerprints."""
    out = np.zeros(1 << (BITS - 3), np.uint8)
    size = len(out) // parts
    with brief_shuffles(packed.sparkSession):
        rows = packed.groupBy("part").applyInArrow(lambda key, t: frequent_bits(key[0].as_py(), t, least, parts),
                                                   "part int, bits binary").collect()
    for r in rows:
        out[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def phrase_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  least: int = LEAST, fold: int = (1 << 64) - 1, block: int = BLOCK, part: int = PART) -> DataFrame:
    """(lang, words, phrase, f): exact counts of the phrases of one to three words
    found ``least`` times or more; words 0 and an empty phrase for the language's
    number of words. ``fold`` masks fingerprints, so that tests make them collide."""
    spark = docs.sparkSession
    ship_package(spark)
    sc = spark.sparkContext
    text, lang = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN))
    rows = docs.select(F.xxhash64(F.col(f"`{id_col}`"), lang, text).alias("doc"), text.alias("text"), lang.alias("lang"))
    seen = rows.select("text", "lang")
    volume = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]
    parts = min(1 << (BITS - 3), 1 << (-(-volume // part)).bit_length())
    packs = lambda n, words: bitmap_of(seen.mapInArrow(
        lambda it: pack(it, n, words, fold, block, parts), "part int, c0 binary"), least, parts)
    words = sc.broadcast(packs(1, None))
    pairs = sc.broadcast(packs(2, words))
    pointers = rows.mapInArrow(lambda it: point(it, words, pairs, fold, min(block, POINTING), parts),
                               "part int, " + ", ".join(f"c{i} binary" for i in range(6)))
    pointers = pointers.groupBy("part").applyInArrow(lambda t: frequent_pointers(t, least), _POINTERS)
    none = lambda kind: F.lit(None).cast(kind)
    asked = pointers.select("doc", "at", none("string").alias("text"), none("string").alias("lang"), "times", "key", "check")
    told = rows.select("doc", F.lit(-1).cast("bigint").alias("at"), "text", "lang", none("bigint").alias("times"),
                       none("bigint").alias("key"), none("int").alias("check"))
    found = told.unionByName(asked).repartition("doc").sortWithinPartitions("doc", "at").mapInArrow(read_phrases, _PHRASES)
    here = F.struct("lang", "words", "phrase")
    one = found.groupBy("key", "check").agg(F.sum("times").alias("f"), F.min(here).alias("p"), F.max(here).alias("q"))
    same = F.when(F.col("p") == F.col("q"), F.col("p")).otherwise(F.raise_error(F.lit("different phrases with equal fingerprints and checks")))
    return one.select(same.alias("p"), "f").select("p.lang", "p.words", "p.phrase", "f")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score): the candidates with their lowest cut."""
    cand = counts.where("words > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    cuts = cand.select("lang", "words", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice("w", F.lit(1), k), " ").alias("head"),
                           F.array_join(F.slice("w", k + 1, F.col("words") - k), " ").alias("tail")))).alias("c"))
    cuts = cuts.select("lang", "words", "phrase", "a", "c.k", "c.head", "c.tail")
    of = lambda name, col: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(col))
    j = cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
    # products of up to 38 digits; the quotient is at most a million
    score = F.expr("(1000000 * (cast(a as decimal(19,0)) * cast(a as decimal(19,0)))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    j = j.withColumn("score", score.cast("bigint"))
    low = j.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    return low.select("lang", "words", "phrase", "a", "c.l", "c.r", "c.score")


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 least: int = LEAST, inside: int = INSIDE, top: int = TOP, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    with brief_shuffles(docs.sparkSession):
        counts = written(phrase_counts(docs, id_col, text_col, lang_col, least, **options), "phrase-counts")
        cand = written(scored(counts), "phrase-scores")
    three = cand.where("words = 3").withColumn("w", F.split("phrase", " "))
    held = three.select("lang", F.explode(F.array(F.array_join(F.slice("w", 1, 2), " "), F.array_join(F.slice("w", 2, 2), " "))).alias("phrase"),
                        F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = cand.join(held, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))).drop("longer", "words")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salts = max(1, -(-cand.count() // (32 * top)))
    w = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
    first = kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))      # a row for each language
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocation_report(docs: DataFrame) -> DataFrame:
    return collocations(docs)
