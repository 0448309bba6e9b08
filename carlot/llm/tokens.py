"""Token ids of whole texts, with a bounded memo of pre-tokens.

Byte-pair encoders work on each pre-token (a word with its blank, a number, a
run of signs) by itself, so a document's ids are the ids of its pre-tokens in
a row. ``Encoder`` cuts a batch of texts into pre-tokens in numpy, looks each
distinct one up in a memo, encodes the new ones with the tokenizers library,
and gathers the ids. That holds for texts of ASCII and the letters of Latin-1,
under the two pre-token patterns named below; any other text goes to the
library as a whole.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np

from carlot.llm.textarrays import BLOCK, slices, word_hashes

#: Pre-tokens remembered by a worker (about 40 bytes each).
MEMO = 2_000_000
_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[[9, 10, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[128:192] = _CLASS[0xC3] = _LETTER
#: Lower-case endings that stay with an apostrophe (fixed values).
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
#: Pre-token patterns that the cuts below follow (fixed values).
_BYTE_LEVEL = "use_regex=True"
_WORD_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


def _next(x: np.ndarray, by: int = 1) -> np.ndarray:
    out = np.zeros_like(x)
    out[:-by or None] = x[by:]
    return out


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        normalizer, splitter = str(self.tokenizer.normalizer), str(self.tokenizer.pre_tokenizer)
        self.word_level = _WORD_LEVEL in splitter and "Lowercase" in normalizer
        self.byte_level = splitter.startswith("ByteLevel") and _BYTE_LEVEL in splitter and "add_prefix_space=False" in splitter \
            and normalizer == "None"
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, dtype=np.uint64)
        self.start = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.uint32)

    def _cuts(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, first and end byte of each pre-token, which texts are plain)."""
        kind = _CLASS[buf]
        lead = buf == 0xC3
        follow = _next(buf)
        odd = (kind == _OTHER) | (lead & ((follow == 0x97) | (follow == 0xB7))) | ((buf == 60) & (follow == 124))
        bad = np.flatnonzero(odd)
        plain = np.searchsorted(bad, offsets[:-1]) == np.searchsorted(bad, offsets[1:])
        # a two-byte letter outside Latin-1's letters has another lead byte, hence is odd
        if self.word_level:
            upper = (buf >= 65) & (buf <= 90)
            upper[1:] |= lead[:-1] & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
            buf = buf + (upper.astype(np.uint8) << 5)
        n = len(buf)
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        first = edge[:-1].copy()
        first[1:] |= kind[1:] != kind[:-1]
        blank = kind == _SPACE
        if self.word_level:
            first |= kind == _DIGIT
        else:
            # the last blank of a run goes with what follows if it is a space, else stands alone
            last = blank & ~_next(blank) & ~edge[1:]
            first |= last
            joined = np.flatnonzero(last & (buf == 32))
            first[joined + 1] = False
        quote = np.flatnonzero((buf == 39) & first & ~edge[1:])
        for q in quote[kind[quote + 1] == _LETTER] if len(quote) else ():
            stop = offsets[np.searchsorted(offsets, q, "right")]
            for ending in _ENDINGS:
                after = q + 1 + len(ending)
                if after <= stop and buf[q + 1:after].tobytes() == ending:
                    first[q + 1] = False
                    if after < stop and kind[after] == _LETTER:
                        first[after] = True
                    break
        s = np.flatnonzero(first)
        e = np.append(s[1:], n) if len(s) else s
        if self.word_level:
            keep = ~blank[s]
            s, e = s[keep], e[keep]
        return buf, s, e, plain

    def _learn(self, buf: np.ndarray, keys: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
        if len(self.known) + len(keys) > MEMO:
            self._forget()
        words = [buf[a:b].tobytes().decode() for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        # Words of letters keep apart when they stand in a row with one blank between
        # them, which is cheaper than a call for each; the rest go one by one.
        blank = "" if self.byte_level else " "
        simple = np.array([w[0] == " " and w[1:].isalpha() if self.byte_level else w.isalpha() for w in words], dtype=bool)
        rows = [words[i] for i in np.flatnonzero(simple)]
        flat, size = array("I"), np.zeros(len(words), dtype=np.int64)
        found: list[np.ndarray] = []
        for i in range(0, len(rows), 512):
            part = rows[i:i + 512]
            x = self.tokenizer.encode(blank.join(part), add_special_tokens=False)
            flat.extend(x.ids)
            found.append(np.bincount(np.array(x.word_ids, dtype=np.int64), minlength=len(part)))
        if found:
            size[simple] = np.concatenate(found)
        single = np.flatnonzero(~simple)
        for i in range(0, len(single), 8192):
            for w, x in zip(single[i:i + 8192], self.tokenizer.encode_batch_fast(
                    [words[k] for k in single[i:i + 8192]], add_special_tokens=False), strict=True):
                ids = x.ids
                flat.extend(ids)
                size[w] = len(ids)
        order = np.concatenate([np.flatnonzero(simple), single])
        starts = np.empty_like(size)
        starts[order] = len(self.flat) + np.cumsum(size[order]) - size[order]
        self.flat = np.concatenate([self.flat, np.frombuffer(flat, dtype=np.uint32)])
        at = np.searchsorted(self.known, keys)
        self.known = np.insert(self.known, at, keys)
        self.start, self.size = np.insert(self.start, at, starts), np.insert(self.size, at, size)

    def _batch(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = buf
        if not (self.word_level or self.byte_level):
            plain, counts, ids = np.zeros(len(offsets) - 1, dtype=bool), np.zeros(len(offsets) - 1, np.int64), None
        else:
            buf, s, e, plain = self._cuts(buf, offsets)
            text = np.searchsorted(offsets, s, "right") - 1
            use = plain[text]
            s, e, text = s[use], e[use], text[use]
            keys, index, inverse = np.unique(word_hashes(buf, s, e), return_index=True, return_inverse=True)
            at = np.searchsorted(self.known, keys)
            new = at == len(self.known)
            new[~new] = self.known[at[~new]] != keys[~new]
            if new.any():
                self._learn(buf, keys[new], s[index[new]], e[index[new]])
                if len(self.known) < len(keys):       # the memo was emptied meanwhile
                    return self._batch(raw, offsets)
                at = np.searchsorted(self.known, keys)
                if (at == len(self.known)).any() or (self.known[np.minimum(at, len(self.known) - 1)] != keys).any():
                    return self._batch(raw, offsets)
            size = self.size[at][inverse]
            total = np.concatenate([[0], np.cumsum(size)])
            ids = self.flat[np.arange(total[-1]) + np.repeat(self.start[at][inverse] - total[:-1], size)]
            ends = np.searchsorted(text, np.arange(len(offsets) - 1), "right")
            counts = np.diff(np.concatenate([[0], total[ends]]))
        if plain.all():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1]) if ids is not None else [None] * len(counts)
        for i in np.flatnonzero(~plain):
            whole = self.tokenizer.encode(raw[offsets[i]:offsets[i + 1]].tobytes().decode(), add_special_tokens=False)
            parts[i] = np.array(whole.ids, dtype=np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, count of each text's ids)."""
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i, j in slices(offsets, 2 * BLOCK):
            got = self._batch(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            ids.append(got[0])
            counts.append(got[1])
        return np.concatenate(ids), np.concatenate(counts)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after every text's ids."""
    return np.insert(ids, np.cumsum(counts), end_id).astype("<u4"), counts + 1


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


def public_path(name: str) -> str:
    """Where the installed tokenizer files are."""
    import public_tokenizers

    return public_tokenizers.path(name)
