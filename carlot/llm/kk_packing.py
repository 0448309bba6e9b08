"""Operator 5: packing by Karmarkar-Karp multiway differencing.

Documents become token ids, then pieces: whole windows of ``capacity`` ids as
long as they last, and a rest cut into pieces of at most ``piece`` ids. A full
window is a sequence by itself. The other pieces are dealt into bounded groups
by a stable row number, and each group is split into k near-equal windows by
differencing: every piece starts as a partial partition of one filled slot;
the two partial partitions with the largest spread are merged, largest slot
against smallest, until one is left. k starts at the least possible count and
rises until no window exceeds the capacity.

No sequence is the work of more than one group, a group holds about ``GROUP``
pieces whatever the table's size, and only (document, start, length, crc32)
travels; ids are kept on request.

Defined cases: null or empty text is one piece holding the end id; rows that
repeat an id are packed each by itself; an empty table gives no piece.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import written
from carlot.llm.textarrays import slices, text_buffer
from carlot.llm.tokens import encoder, public_path, with_end

CAPACITY = 2048
#: Longest piece that shares a window.
PIECE = 512
#: Pieces of a packing group, on average.
GROUP = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0..k-1) of each piece: multiway differencing into k sums.

    A partial partition is its sorted slot sums (empty slots left out) and, for
    each, the list of pieces in it."""
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    sums: dict[int, np.ndarray] = {i: np.array([s], dtype=np.int64) for i, s in enumerate(sizes)}
    held: dict[int, list] = {i: [(i,)] for i in range(len(sizes))}
    nxt = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        sa, sb, ha, hb = sums.pop(a), sums.pop(b), held.pop(a), held.pop(b)
        over = len(sa) + len(sb) - k
        if over <= 0:
            s, h = np.concatenate([sa, sb]), ha + hb
        else:
            # slots in descending order: the last of a meet the first of b reversed, so that
            # the largest of one side joins the smallest of the other
            na, nb = len(sa), len(sb)
            s = np.concatenate([sa[:na - over], sa[na - over:] + sb[nb - over:][::-1], sb[:nb - over]])
            h = ha[:na - over] + [(x, y) for x, y in zip(ha[na - over:], reversed(hb[nb - over:]), strict=True)] + hb[:nb - over]
        order = np.argsort(-s, kind="stable")
        s = s[order]
        sums[nxt], held[nxt] = s, [h[i] for i in order]
        spread = int(s[0] - s[-1]) if len(s) == k else int(s[0])
        heapq.heappush(heap, (-spread, nxt))
        nxt += 1
    out = np.zeros(len(sizes), dtype=np.int64)
    if heap:
        for w, tree in enumerate(held[heap[0][1]]):
            stack = [tree]
            while stack:
                t = stack.pop()
                if len(t) == 1:
                    out[t[0]] = w
                else:
                    stack += t
    return out


def windows(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece, with as few near-equal windows as fit."""
    if len(sizes) == 0:
        return np.zeros(0, dtype=np.int64)
    if int(sizes.max()) > capacity:
        raise ValueError("a piece exceeds the capacity")
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        out = differencing(sizes, k)
        if int(np.bincount(out, weights=sizes).max()) <= capacity:
            return out
        k += 1


def cut(tokens: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    out = [(s, capacity) for s in range(0, tokens - tokens % capacity, capacity)]
    at = tokens - tokens % capacity
    return out + [(s, min(piece, tokens - s)) for s in range(at, tokens, piece)]


def make_pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int, piece: int,
                with_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(tokenizer)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    for b in batches:
        buf, offsets = text_buffer(b.column("text"))
        keys = b.column("doc_id").to_pylist()
        for i, j in slices(offsets):
            ids, counts = with_end(*enc.encode(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), end_id)
            rows: list[tuple] = []
            blobs: list[bytes] = []
            first = 0
            for key, n in zip(keys[i:j], counts.tolist(), strict=True):
                for start, length in cut(n, capacity, piece):
                    part = ids[first + start:first + start + length].tobytes()
                    rows.append((key, start, length, zlib.crc32(part), n))
                    if with_ids:
                        blobs.append(part)
                first += n
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            if with_ids:
                columns.append(pa.array(blobs, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, piece: int = PIECE,
              with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): the pieces of all
    documents; ``ids`` are little-endian unsigned 32-bit integers."""
    kinds = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * with_ids
    d = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return d.mapInArrow(lambda it: make_pieces(it, tokenizer, end_id, capacity, piece, with_ids), kinds)


def place_group(table: pa.Table, capacity: int) -> pa.Table:
    """Window and offset of one group's pieces."""
    t = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("no", "ascending")])
    sizes = t.column("length").to_numpy()
    w = windows(sizes, capacity)
    order = np.argsort(w, kind="stable")
    ends = np.cumsum(sizes[order])
    first = np.concatenate([[True], np.diff(w[order]) != 0])
    before = ends - sizes[order]
    offset = np.empty(len(sizes), dtype=np.int64)
    offset[order] = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(sizes))))
    sequence = 2 * ((t.column("bucket").to_numpy() << 20) + w) + 1
    return t.drop_columns(["bucket"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. Other columns pass through."""
    keep = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset", "no", "bucket")]
    p = written(pieces.select(*keep).withColumn("no", F.monotonically_increasing_id()), "pieces")
    groups = max(1, round(p.where(F.col("length") < capacity).count() / group))
    full = p.where(F.col("length") == capacity).select(
        *keep, (F.col("no") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = p.where(F.col("length") < capacity).withColumn("bucket", F.pmod(F.xxhash64("no"), F.lit(groups)))
    # The rows are tiny but the work on them isn't, so their bytes must not decide
    # how many tasks share it: a task gets about four groups.
    rest = rest.repartition(-(-groups // 4), "bucket")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in p.schema.fields)
    placed = rest.groupBy("bucket").applyInArrow(
        lambda t: place_group(t, capacity), kinds + ", sequence_id bigint, offset bigint")
    return full.unionByName(placed.select(*keep, "sequence_id", "offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed windows, for pieces with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p")).select(
        "sequence_id", "length", F.aggregate(F.col("p.ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))


def packing_report(docs: DataFrame) -> DataFrame:
    """Digest: the place of every piece of every document."""
    return pack(pieces_of(docs, public_path(TOKENIZER))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
