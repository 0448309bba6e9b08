"""Vectorised text helpers for use inside Arrow tasks (numpy only).

A batch of texts is one byte buffer with offsets, as Arrow holds it; nothing
here makes a Python object per word. Work arrays are cut to blocks of
``BLOCK`` bytes, so a task's memory follows its longest text, not its batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
#: Random odd constants of the hash functions (fixed by the seed above).
BYTE_KEYS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
WORD_BASE = U64(0x9E3779B97F4A7C15)
SHINGLE_KEYS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)

LOWER_TABLE = np.arange(256, dtype=np.uint8)
LOWER_TABLE[65:91] += 32
#: Words are [^\x20\x09-\x0D]+ : everything but the six ASCII blanks.
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply), element-wise."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def slices(offsets: np.ndarray, size: int = 4 * BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each (at least one row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


_powers = np.ones(1, dtype=np.uint64)


def word_powers(n: int) -> np.ndarray:
    """The first ``n`` powers of WORD_BASE modulo 2**64."""
    global _powers
    if len(_powers) < n:
        size = 1 << max(6, int(n - 1).bit_length())
        out = np.empty(size, dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(np.full(size - 1, WORD_BASE, dtype=np.uint64), out=out[1:])
        _powers = out
    return _powers[:n]


#: Runs of ASCII letters, digits and non-ASCII bytes.
IN_NAME = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def word_spans(buf: np.ndarray, offsets: np.ndarray,
               in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte) of every word, and the first word of each text
    (one entry more than texts)."""
    n = len(buf)
    inside = in_word[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    s = np.flatnonzero(first)
    return s, np.flatnonzero(last) + 1, np.searchsorted(s, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    out = np.empty(len(starts), dtype=np.uint64)
    lens = ends - starts
    total = np.concatenate([[0], np.cumsum(lens)])
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(total, total[i] + BLOCK, "right")) - 1)
        ln, at = lens[i:j], total[i:j] - total[i]
        inner = np.arange(total[j] - total[i]) - np.repeat(at, ln)
        vals = BYTE_KEYS[buf[inner + np.repeat(starts[i:j], ln)]]
        vals *= word_powers(int(ln.max()))[inner]
        out[i:j] = mix(np.add.reduceat(vals, at) + ln.astype(np.uint64) * SHINGLE_KEYS[63])
        i = j
    return out


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text) of lower-cased texts."""
    low = LOWER_TABLE[buf]
    s, e, at = word_spans(low, offsets)
    return word_hashes(low, s, e), at


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words (``len(hashes) - k + 1`` of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = np.full(n, SHINGLE_KEYS[62] ^ U64(k), dtype=np.uint64)
    for i in range(k):
        acc += hashes[i:i + n] * SHINGLE_KEYS[i]
    return mix(acc)
