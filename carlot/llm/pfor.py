"""Operator 6: token ids in binary files of patched frame-of-reference blocks.

Ids are cut into blocks of 128. A block stores its minimum, and each id minus
it in ``width`` bits, the width that holds the block's 90th percentile. Ids
that need more bits are exceptions: position and full difference follow the
packed part, and their packed bits are zero. An index of block starts lets a
reader decode any range of ids without the rest.

File layout (little-endian):

    8 bytes   magic
    7 x u64   part, segment, documents, ids, blocks, payload bytes, nulls flag
    documents x i64   document ids          documents x u32   token counts
    documents x u8    1 where the id is null
    blocks x u32 minima, x u8 widths, x u8 exception counts
    (blocks + 1) x u64   starts of the blocks in the payload
    payload   per block: 16 * width bytes packed, then u8 positions, u32 values

Documents are range-partitioned and sorted by id, so part and segment order is
id order. Files are written by Spark's file committer (one file a segment, a
retried task leaves no trace) and read back by its binary file source, so any
file system that Spark reaches will do. A segment closes at the first document
end past ``IDS_PER_FILE`` ids.

Defined cases: null or empty text holds the end id alone; null ids come first;
repeated ids keep all their rows, in the order of the text's hash; an empty
table writes no segment and reads as an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carlot.llm.common import written
from carlot.llm.textarrays import slices, text_buffer
from carlot.llm.tokens import encoder, public_path, with_end
from carlot.session import scratch_path

MAGIC = b"PFORSEG1"
BLOCK = 128
PERCENTILE = 90
IDS_PER_FILE = 2_000_000
#: Ids encoded at a time: a whole number of blocks.
SLAB = 1 << 19
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
_HEAD = 8 + 7 * 8


def _bit_length(x: np.ndarray) -> np.ndarray:
    # float64 holds 32-bit integers exactly, so its exponent is the bit length
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> dict[str, np.ndarray]:
    """Minima, widths, exception counts, block starts and payload of ``ids``,
    made a slab at a time so that work arrays stay small."""
    slabs = [_encode(ids[i:i + SLAB], percentile) for i in range(0, len(ids), SLAB)] or [_encode(ids, percentile)]
    out = {k: np.concatenate([x[k] for x in slabs]) for k in ("low", "widths", "n_odd", "payload")}
    before = np.concatenate([[0], np.cumsum([len(x["payload"]) for x in slabs])])
    starts = [x["starts"][:-1] + np.uint64(b) for x, b in zip(slabs, before[:-1], strict=True)]
    return out | {"starts": np.concatenate([*starts, before[-1:].astype(np.uint64)]).astype("<u8")}


def _encode(ids: np.ndarray, percentile: float) -> dict[str, np.ndarray]:
    nb = -(-len(ids) // BLOCK)
    rows = np.empty(nb * BLOCK, dtype=np.uint32)
    rows[:len(ids)] = ids
    rows[len(ids):] = ids[-1] if len(ids) else 0
    rows = rows.reshape(nb, BLOCK)
    low = rows.min(axis=1) if nb else np.empty(0, np.uint32)
    delta = rows - low[:, None]
    bits = _bit_length(delta)
    at = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    widths = np.sort(bits, axis=1)[:, at] if nb else np.empty(0, np.uint8)
    odd = bits > widths[:, None]
    n_odd = odd.sum(axis=1).astype(np.uint8)
    sizes = widths.astype(np.int64) * (BLOCK // 8) + n_odd.astype(np.int64) * 5
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64)
    payload = np.zeros(int(starts[-1]), dtype=np.uint8)
    packed = np.where(odd, 0, delta).astype(">u4")
    for w in np.unique(widths):
        if not w:
            continue
        blocks = np.flatnonzero(widths == w)
        for i in range(0, len(blocks), 512):
            b = blocks[i:i + 512]
            full = np.unpackbits(packed[b].view(np.uint8).reshape(len(b), BLOCK, 4), axis=2)
            body = np.packbits(full[:, :, 32 - int(w):].reshape(len(b), -1), axis=1)
            payload[starts[b].astype(np.int64)[:, None] + np.arange(body.shape[1])] = body
    which, pos = np.nonzero(odd)
    if len(which):
        nth = np.arange(len(which)) - np.concatenate([[0], np.cumsum(n_odd.astype(np.int64))])[which]
        tail = starts[which].astype(np.int64) + widths[which].astype(np.int64) * (BLOCK // 8)
        payload[tail + nth] = pos
        values = delta[which, pos].astype("<u4").view(np.uint8).reshape(-1, 4)
        payload[(tail + n_odd[which] + 4 * nth)[:, None] + np.arange(4)] = values
    return {"low": low.astype("<u4"), "widths": widths, "n_odd": n_odd, "starts": starts.astype("<u8"), "payload": payload}


def decode_blocks(b: dict[str, np.ndarray], first: int, last: int) -> np.ndarray:
    """The ids of blocks ``first`` up to ``last``; reads only their payload."""
    nb = last - first
    starts = b["starts"][first:last].astype(np.int64)
    widths, n_odd = b["widths"][first:last].astype(np.int64), b["n_odd"][first:last].astype(np.int64)
    out = np.zeros((nb, BLOCK), dtype=np.uint32)
    for w in np.unique(widths):
        if not w:
            continue
        blocks = np.flatnonzero(widths == w)
        for i in range(0, len(blocks), 512):
            k = blocks[i:i + 512]
            body = b["payload"][starts[k][:, None] + np.arange(w * BLOCK // 8)]
            full = np.zeros((len(k), BLOCK, 32), dtype=np.uint8)
            full[:, :, 32 - w:] = np.unpackbits(body, axis=1).reshape(len(k), BLOCK, w)
            out[k] = np.packbits(full, axis=2).reshape(len(k), BLOCK * 4).view(">u4")
    which = np.repeat(np.arange(nb), n_odd)
    if len(which):
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        tail = starts[which] + widths[which] * (BLOCK // 8)
        pos = b["payload"][tail + nth]
        raw = b["payload"][(tail + n_odd[which] + 4 * nth)[:, None] + np.arange(4)]
        out[which, pos] = np.ascontiguousarray(raw).view("<u4").ravel()
    return (out + b["low"][first:last].astype(np.uint32)[:, None]).ravel()


def write_segment(part: int, segment: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    b = encode_blocks(ids)
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    head = np.array([part, segment, len(doc_ids), len(ids), len(b["low"]), len(b["payload"]), int(null.any())], dtype="<u8")
    keys = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    return b"".join([MAGIC, head.tobytes(), keys.tobytes(), counts.astype("<u4").tobytes(), null.tobytes(),
                     b["low"].tobytes(), b["widths"].tobytes(), b["n_odd"].tobytes(), b["starts"].tobytes(),
                     b["payload"].tobytes()])


class Segment:
    """A file's reader: header and index at once, ids on demand."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a segment file")
        self.part, self.segment, docs, self.n_ids, blocks, size, _ = (int(x) for x in np.frombuffer(data, "<u8", 7, 8))
        at = _HEAD

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.counts, self.null = take("<i8", docs), take("<u4", docs), take("u1", docs)
        self.blocks = {"low": take("<u4", blocks), "widths": take("u1", blocks), "n_odd": take("u1", blocks),
                       "starts": take("<u8", blocks + 1), "payload": take("u1", size)}

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` up to ``stop`` of the segment."""
        if stop <= start:
            return np.empty(0, dtype=np.uint32)
        first = start // BLOCK
        return decode_blocks(self.blocks, first, -(-stop // BLOCK))[start - first * BLOCK:stop - first * BLOCK]


def make_segments(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int,
                  ids_per_file: int) -> Iterator[pa.RecordBatch]:
    """Encode the sorted documents of one partition to segment files."""
    enc = encoder(tokenizer)
    part, segment = TaskContext.get().partitionId(), 0
    keys: list = []
    counts: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        data = write_segment(part, segment, keys, np.concatenate(counts), np.concatenate(parts))
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    for b in batches:
        buf, offsets = text_buffer(b.column("text"))
        ids_of = b.column("id").to_pylist()
        for i, j in slices(offsets):
            ids, n = with_end(*enc.encode(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), end_id)
            ends = np.cumsum(n)
            at = 0
            # close a segment at the first document end past the limit
            while at < len(n):
                done = int(ends[at - 1]) if at else 0
                stop = min(len(n), int(np.searchsorted(ends, done + ids_per_file - held)) + 1)
                keys += ids_of[i + at:i + stop]
                counts.append(n[at:stop])
                parts.append(ids[done:ends[stop - 1]])
                held += int(n[at:stop].sum())
                at = stop
                if held >= ids_per_file:
                    yield flush()
                    segment, held = segment + 1, 0
                    keys, counts, parts = [], [], []
    if keys:
        yield flush()


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
              text_col: str = "text", ids_per_file: int = IDS_PER_FILE) -> None:
    """Write the ids of all documents, in id order, to segment files in ``path``."""
    d = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    n = max(1, d.rdd.getNumPartitions())
    tie = F.xxhash64("text")
    d = d.repartitionByRange(n, F.col("id"), tie).sortWithinPartitions(F.col("id"), tie)
    files = d.mapInArrow(lambda it: make_segments(it, tokenizer, end_id, ids_per_file), "data binary")
    # The text writer emits a string's bytes as they are; one record is one file.
    (files.select(F.col("data").cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).mode("errorifexists").text(path))


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(part, segment, doc_id, at, n_tokens, crc[, ids]): every document of the
    files, with its first id's place in its segment and its ids' crc32."""
    kinds = "part bigint, segment bigint, doc_id bigint, at bigint, n_tokens bigint, crc bigint"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column("content"):
                s = Segment(data.as_py())
                ends = np.cumsum(s.counts.astype(np.int64))
                at = ends - s.counts
                for i in range(0, len(at), 1024):
                    j = min(len(at), i + 1024)
                    ids = s.ids(int(at[i]), int(ends[j - 1])).astype("<u4")
                    cut = [ids[a:e] for a, e in zip(at[i:j] - at[i], ends[i:j] - at[i], strict=True)]
                    columns = {
                        "part": pa.array(np.full(j - i, s.part)), "segment": pa.array(np.full(j - i, s.segment)),
                        "doc_id": pa.array(s.doc_ids[i:j], pa.int64(), mask=s.null[i:j].astype(bool)),
                        "at": pa.array(at[i:j]), "n_tokens": pa.array(s.counts[i:j].astype(np.int64)),
                        "crc": pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64())}
                    if with_ids:
                        columns["ids"] = pa.array([x.astype(np.int64) for x in cut], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    return files.select("content").mapInArrow(decode, kinds + ", ids array<bigint>" * with_ids)


def ids_report(docs: DataFrame) -> DataFrame:
    """Digest: write all documents, read the files back, and place each
    document among all ids."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    write_ids(docs, path, public_path(TOKENIZER))
    d = written(read_documents(spark, path, with_ids=False), "token-digests")
    files = d.groupBy("part", "segment").agg(F.sum("n_tokens").alias("ids"))
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    # one row for each partition, then one for each of its files
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    inner = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "segment", F.coalesce(F.sum("ids").over(inner), F.lit(0)).alias("file_start"))
    j = d.join(files, ["part", "segment"]).join(parts, "part")
    return j.select("doc_id", (F.col("part_start") + F.col("file_start") + F.col("at")).alias("start"),
                    "n_tokens", F.col("crc").alias("ids_crc32"))
