"""Operator 7: n-gram Jaccard join by grouped prefixes, and its components.

A document's set is its distinct 5-word shingles (64-bit hashes); two link when
their Jaccard similarity is 0.75 or more. If |x and y| is at least ``a``, then
the first n - a + SHARED shingles of both, in any one order, have SHARED in
common (all of them, for smaller sets). The steps:

1. One pass over the texts: per document its size and set digest, and the
   shingles that are frequent inside a batch. The most frequent ones, a table
   of at most ``HOT`` rows, go last in the order; the rest go by hash.
2. A second pass posts the prefixes. Documents with identical prefixes and size
   are one group, whatever the rest of their sets: inside a partition the first
   one posts for all, across partitions the prefix digest says who belongs.
3. The postings of a shingle meet in one sorted stream. Where a group has at
   most ``SMALL`` partners of fitting size on average, they are paired, and a
   pair of groups goes on if it met in SHARED shingles. In denser buckets groups
   are not paired: they go on as a cluster around the least one, for each band of
   fitting sizes. A task keeps HOLD rows of a bucket at most; larger ones get
   their centre by a join.
4. Groups are expanded to their members, one for each distinct set: a pair of
   groups of one set each is a pair, any other pair goes to the cluster of its
   lesser group, and the members of a group are a cluster of their own.
5. The texts of the members go to the blocks of their clusters, of bounded size,
   as sets. A block is verified against its cluster's centre; only members that
   don't link to it are held against the other members, by an inverted index in
   memory. Of the links found, those that join two parts not yet joined are kept,
   so a group of m copies gives about m edges.
6. Components of the edges give every document its class.

Nothing is capped: the groups of a pair that links are the same, or share SHARED
shingles in thin buckets, or one in a dense bucket, and their cluster decides it.

Defined cases: null, empty or blank texts have no shingle and link to nothing;
a null id links to nothing and has a null component; rows that repeat an id
are one document with the links of each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import scratch, written
from carlot.llm.components import components
from carlot.llm.textarrays import U64, mix, shingles, slices, text_buffer, words

SHINGLE = 5
#: Least similarity, in percent.
PERCENT = 75
#: Shingles that the prefixes of a linked pair must share.
SHARED = 6
#: Pairs of fitting size per document, on average, up to which the documents of
#: a shingle are paired directly.
SMALL = 16
#: Rows of one larger bucket that a task keeps; beyond that Spark joins them.
HOLD = 100_000
#: Frequent shingles that are put last, and occurrences in a batch that make
#: one a candidate.
HOT, HOT_LEAST = 1 << 17, 4
#: Shingles of a cluster's block.
BLOCK_SIZE = 1_000_000
_SECOND = U64(0xD6E8FEB86659FD93)


def least_overlap(n):
    """Shingles that a set of size ``n`` must share with a linked one."""
    return -(-n * PERCENT // 100)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, at = words(buf, offsets)
    runs = shingles(hashes, k)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            s = np.sort(runs[a:b - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(shingles(hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit digest of a set."""
    one, two = mix(s).sum(dtype=np.uint64), mix(s * _SECOND).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    buf, offsets = text_buffer(batch.column("text"))
    ids = batch.column("id").to_pylist()
    for i, j in slices(offsets, 2 << 20):
        yield ids[i:j], shingle_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)


_FACTS = "id bigint, n bigint, d1 bigint, d2 bigint, token bigint, times bigint"


def make_facts(batches: Iterator[pa.RecordBatch], k: int, hot_least: int) -> Iterator[pa.RecordBatch]:
    """A row (id, n, d1, d2) per document, and (token, times) for the shingles
    of ``hot_least`` different sets of a batch."""
    names = ["id", "n", "d1", "d2", "token", "times"]
    for b in batches:
        seen: set = set()
        tokens: list[np.ndarray] = []
        rows: list[tuple] = []
        for ids, sets in _sets(b, k):
            for key, s in zip(ids, sets, strict=True):
                d = digest(s)
                rows.append((key, len(s), *d))
                if (len(s), *d) not in seen:
                    seen.add((len(s), *d))
                    tokens.append(s)
        flat = np.concatenate(tokens)
        del tokens
        flat.sort()                       # in place: the counts need no copy of the batch's shingles
        at = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1], [True]])) if len(flat) else np.zeros(1, np.int64)
        c = np.diff(at)
        u, c = flat[at[:-1][c >= hot_least]], c[c >= hot_least]
        cols = list(zip(*rows, strict=True))
        pad = [None] * len(u)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*col, *pad], pa.int64()) for col in cols]
            + [pa.array(np.concatenate([np.zeros(len(rows), np.int64), v.view(np.int64)]),
                        mask=np.arange(len(rows) + len(u)) < len(rows)) for v in (u, c)], names)


def prefix(s: np.ndarray, hot: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The first shingles of a set: rare ones by hash, then hot ones by count."""
    p = min(len(s), len(s) - least_overlap(len(s)) + SHARED)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        found = hot[at] == s
        if found.any():
            s = s[np.lexsort((s, np.where(found, times[at], 0)))]
    return s[:p]


def post_prefixes(batches: Iterator[pa.RecordBatch], k: int, hot: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(token, n, id) rows for the prefix of the first document of each group in
    a partition, and (prefix digest, -n, id) for the first one of each set."""
    seen: set = set()
    groups: set = set()
    for b in batches:
        for ids, sets in _sets(b, k):
            keys, sizes, parts = [], [], []
            for key, s in zip(ids, sets, strict=True):
                d = digest(s)
                if not len(s) or d in seen:
                    continue
                seen.add(d)
                first = prefix(s, hot, times)
                group = (len(s), *digest(first))
                keys.append(key)
                sizes.append(-len(s))
                parts.append(np.array(group[1:2], np.int64).view(np.uint64))
                if group not in groups:
                    groups.add(group)
                    keys.append(key)
                    sizes.append(len(s))
                    parts.append(first)
            if parts:
                n = [len(x) for x in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(np.array(sizes, np.int32), n)),
                     pa.array(np.repeat(np.array(keys, np.int64), n))], ["token", "n", "id"])


_MEETINGS = "kind int, a bigint, b bigint, n int"


def fitting_pairs(n: np.ndarray, key: np.ndarray, row: np.ndarray, partners: np.ndarray) -> list[np.ndarray]:
    """(kind 0, a, b, shingles they must share) for each of ``row`` with its
    ``partners`` next rows, which are no smaller and still fit."""
    x = np.repeat(row, partners)
    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(partners) - partners, partners)
    other = key[x] != key[y]
    x, y = x[other], y[other]
    return [np.zeros(len(x), np.int32), np.minimum(key[x], key[y]), np.maximum(key[x], key[y]),
            np.minimum(SHARED, least_overlap(n[y].astype(np.int64))).astype(np.int32)]


def stars(bucket: np.ndarray, n: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    """(kind 2, centre, member, band), distinct, for whole large buckets."""
    band = np.floor(np.log(n.astype(np.float64)) / np.log(100.0 / PERCENT) + 1e-9).astype(np.int64)
    g, k = np.concatenate([bucket, bucket]), np.concatenate([key, key])
    band = np.concatenate([band, band - 1])
    order = np.lexsort((k, band, g))
    g, band, k = g[order], band[order], k[order]
    first = np.concatenate([[True], (g[1:] != g[:-1]) | (band[1:] != band[:-1])])
    p = np.repeat(k[first], np.diff(np.append(np.flatnonzero(first), len(k))))
    rows = np.unique(np.stack([p, k, band + 2], axis=1)[p != k], axis=0)
    return [np.full(len(rows), 2, np.int32), rows[:, 0], rows[:, 1], rows[:, 2].astype(np.int32)]


def meet(batches: Iterator[pa.RecordBatch], small: int, hold: int) -> Iterator[pa.RecordBatch]:
    """Buckets of a stream sorted by token: kind 0 rows for the pairs of fitting
    size where they are few, kind 2 rows (centre, member, band) for dense
    buckets, and, since at most ``hold`` rows of one bucket are kept, kind 1 rows
    (token, id, n) for those beyond, whose centre Spark finds. The rows that tell
    a document's group pass as kind 3 (prefix digest, id, n)."""
    names = ["kind", "a", "b", "n"]
    held: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)]
    open_token = None

    def whole(token: np.ndarray, n: np.ndarray, key: np.ndarray) -> list[list[np.ndarray]]:
        if not len(token):
            return []
        order = np.lexsort((key, n, token))
        token, n, key = token[order], n[order], key[order]
        first = np.concatenate([[True], token[1:] != token[:-1]])
        at, bucket = np.flatnonzero(first), np.cumsum(first) - 1
        size = np.diff(np.append(at, len(token)))
        place = (bucket.astype(np.int64) << 32) + n
        most = (bucket.astype(np.int64) << 32) + n.astype(np.int64) * 100 // PERCENT
        partners = np.searchsorted(place, most, "right") - np.arange(len(n)) - 1
        dense = (np.add.reduceat(partners, at) > small * size)[bucket]
        row = np.flatnonzero(~dense & (partners > 0))
        parts = [fitting_pairs(n, key, row, partners[row])]
        if dense.any():
            parts.append(stars(token[dense], n[dense], key[dense]))
        return parts

    def batch(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)

    for b in batches:
        got = [b.column(c).to_numpy(zero_copy_only=False) for c in ("token", "n", "id")]
        parts = []
        tells = got[1] < 0
        if tells.any():
            parts.append([np.full(int(tells.sum()), 3, np.int32), got[0][tells], got[2][tells], -got[1][tells]])
            got = [g[~tells] for g in got]
        token, n, key = (np.concatenate([h, g]) for h, g in zip(held, got, strict=True))
        if open_token is not None and len(token):
            # more of a bucket whose first rows went on already
            more = int(np.searchsorted(token, open_token, "right"))
            parts.append([np.ones(more, np.int32), token[:more], key[:more], n[:more]])
            token, n, key = token[more:], n[more:], key[more:]
            if len(token):
                open_token = None
        last = int(np.searchsorted(token, token[-1])) if len(token) else 0
        parts += whole(token[:last], n[:last], key[:last])
        held = [token[last:], n[last:], key[last:]]
        if len(held[0]) > hold:
            open_token = int(held[0][0])
            parts.append([np.ones(len(held[0]), np.int32), held[0], held[2], held[1]])
            held = [x[:0] for x in held]
        yield from batch(parts)
    yield from batch(whole(*held))


def size_band(n):
    """Bands by a factor of 4/3: sets that can link are at most one band apart."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / PERCENT)) + F.lit(1e-9)).cast("int")


def clusters(meetings: DataFrame) -> DataFrame:
    """(p, band, y): the members of every cluster. Band -1 holds single pairs."""
    pairs = (meetings.where("kind = 0").groupBy("a", "b", "n").agg(F.count(F.lit(1)).alias("met")).where("met >= n")
             .select(F.col("a").alias("p"), F.lit(-1).alias("band"), F.col("b").alias("y")))
    large = meetings.where("kind = 1").select(
        F.col("a").alias("token"), F.col("b").alias("y"),
        F.explode(F.array(size_band(F.col("n")), size_band(F.col("n")) - 1)).alias("band"))
    centre = written(large.groupBy("token", "band").agg(F.min("y").alias("p")), "bucket-centres")
    star = large.join(centre, ["token", "band"]).where("p <> y").select("p", (F.col("band") + 2).alias("band"), "y")
    near = meetings.where("kind = 2").select(F.col("a").alias("p"), F.col("n").alias("band"), F.col("b").alias("y"))
    return pairs.unionByName(near).unionByName(star).distinct()


def prefix_groups(meetings: DataFrame, reps: DataFrame) -> DataFrame:
    """(grp, sets, rep, n): the distinct sets of every group of identical prefix
    and size, each by the least id that has it; ``grp`` is the least of them.
    Groups whose digests collide are one, which only adds sets to verify."""
    own = (meetings.where("kind = 3").select(F.col("a").alias("prefix"), F.col("b").alias("id"), "n")
           .join(reps, ["id", "n"]).select("prefix", "n", "rep").distinct())
    groups = own.groupBy("prefix", "n").agg(F.min("rep").alias("grp"), F.count(F.lit(1)).alias("sets"))
    return own.join(groups, ["prefix", "n"]).select("grp", "sets", "rep", "n")


def expanded(met: DataFrame, reps: DataFrame, members: DataFrame) -> DataFrame:
    """(p, band, y, n): clusters of documents for the clusters ``met`` of those
    that posted. Band -1 holds pairs of groups of one set each, band 0 the pairs
    of larger groups, and the members of one group."""
    at = reps.select("id", "rep").join(members, "rep").select("id", F.struct("grp", "sets").alias("g")).distinct()
    c = met.join(at.select(F.col("id").alias("p"), F.col("g").alias("gp")), "p").join(
        at.select(F.col("id").alias("y"), F.col("g").alias("gy")), "y").where("gp.grp <> gy.grp")
    star = F.col("band") >= 0
    lone = (F.col("gp.sets") == 1) & (F.col("gy.sets") == 1)
    c = c.select(F.when(star, F.col("gp")).otherwise(F.least("gp", "gy")).alias("gp"),
                 F.when(star, F.col("gy")).otherwise(F.greatest("gp", "gy")).alias("gy"),
                 F.when(star, F.col("band")).when(lone, -1).otherwise(0).alias("band"))
    pairs = written(c.select(F.col("gp.grp").alias("p"), F.col("gp.sets").alias("sets"), "band",
                             F.col("gy.grp").alias("grp")).distinct(), "group-pairs")
    y = members.select("grp", F.col("rep").alias("y"), "n")
    out = pairs.join(y, "grp").select("p", "band", "y", "n")
    centre = pairs.where("sets > 1").select(F.col("p").alias("grp"), "band").distinct()
    out = out.unionByName(centre.join(y, "grp").select(F.col("grp").alias("p"), "band", "y", "n"))
    inner = members.where("sets > 1").select(F.col("grp").alias("p"), F.lit(0).alias("band"), F.col("rep").alias("y"), "n")
    return out.unionByName(inner).where("p <> y").distinct()


_PLACE = ["p", "band", "block", "part", "role", "id"]


def make_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Replace each row's text by its set; equal texts of a batch are cut once."""
    for b in batches:
        text = b.column("text").fill_null("").dictionary_encode()
        which = text.indices.to_numpy()
        buf, offsets = text_buffer(text.dictionary)
        sets: list[bytes] = []
        for i, j in slices(offsets, 2 << 20):
            sets += [s.tobytes() for s in shingle_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)]
        for i in range(0, b.num_rows, 1000):
            part = pa.array([sets[w] for w in which[i:i + 1000]], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1000) for c in _PLACE), part], [*_PLACE, "shingles"])


def _linked(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * inter >= PERCENT * (a + b - inter)


class Index:
    """Overlap of one set with every set of a block."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], dtype=np.int64)
        tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner = tokens[order], np.repeat(np.arange(len(sets)), self.n)[order]

    def linked(self, s: np.ndarray) -> np.ndarray:
        """The block's sets that link with ``s``."""
        lo, hi = np.searchsorted(self.tokens, s, "left"), np.searchsorted(self.tokens, s, "right")
        n = hi - lo
        hits = self.owner[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        return np.flatnonzero(_linked(np.bincount(hits, minlength=len(self.n)), self.n, len(s)))


def _join_parts(root: np.ndarray, x: int, found: np.ndarray) -> list[int]:
    """One member of each part in ``found`` that isn't x's, which they join."""
    parts, first = np.unique(root[found], return_index=True)
    new = parts != root[x]
    root[np.isin(root, parts[new])] = root[x]
    return found[first[new]].tolist()


def verify_block(role: np.ndarray, ids: np.ndarray, sets: list[np.ndarray], full: bool) -> tuple[list, list]:
    """Edges of a block, and the members that don't link to its centre.

    Roles: 0 the centre, 1 members, 2 queries from other blocks."""
    edges: list[tuple[int, int]] = []
    outside: list[int] = []
    centre, own, asked = np.flatnonzero(role == 0), np.flatnonzero(role == 1), np.flatnonzero(role == 2)
    members = [sets[i] for i in own]
    root = np.arange(len(own))
    left = np.arange(len(own))
    if len(centre) and len(own):
        at = np.concatenate([[0], np.cumsum([len(s) for s in members])])
        flat = np.concatenate(members)
        ok = np.zeros(len(own), dtype=bool)
        for c in (sets[i] for i in centre):       # an id that is repeated has several texts
            same = c[np.minimum(np.searchsorted(c, flat), len(c) - 1)] == flat
            inter = np.add.reduceat(same.astype(np.int64), at[:-1])
            ok |= _linked(inter, np.diff(at), len(c))
        edges += [(int(ids[centre[0]]), int(ids[own[i]])) for i in np.flatnonzero(ok)]
        root[ok] = len(own)
        left = np.flatnonzero(~ok)
        outside = [int(ids[own[i]]) for i in left]
    if full and len(own) and (len(left) or len(asked)):
        index = Index(members)
        if len(centre):
            for x in left:
                found = index.linked(members[x])
                edges += [(int(ids[own[x]]), int(ids[own[y]])) for y in _join_parts(root, x, found)]
        for q in asked:
            found = index.linked(sets[q])
            _, first = np.unique(root[found], return_index=True)
            edges += [(int(ids[q]), int(ids[own[found[i]]])) for i in first]
    return edges, outside


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a stream sorted by (p, band, block): rows (a, b) for edges,
    (p, band, y) for members outside. One block is held at a time."""
    names = ["p", "band", "block", "part", "role", "id", "shingles"]
    held: list[list] = []

    def done(rows: list[list]) -> pa.RecordBatch:
        p, band = rows[0][0], rows[0][1]
        edges, outside = verify_block(np.array([r[4] for r in rows]), np.array([r[5] for r in rows]),
                                      [np.frombuffer(r[6], np.uint64) for r in rows], band >= 0)
        cols = [[e[0] for e in edges] + [p] * len(outside), [e[1] for e in edges] + outside]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in cols] + [pa.array([None] * len(edges) + [band] * len(outside), pa.int32())],
            ["a", "b", "band"])

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in names), strict=True):
            if held and held[0][:4] != list(row[:4]):
                yield done(held)
                held = []
            held.append(list(row))
    if held:
        yield done(held)


def verified(places: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Rows of ``verify`` for the documents put in blocks by ``places``. The
    texts cross one exchange to their places, their sets one to the blocks."""
    # by exchange at every size: the cost stays linear as the places outgrow a broadcast
    rows = places.hint("merge").join(texts, "id").select(*_PLACE, "text").mapInArrow(
        lambda it: make_sets(it, k), "p bigint, band int, block int, part int, role int, id bigint, shingles binary")
    keys = ["p", "band", "block", "part"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "role", "id").mapInArrow(
        verify, "a bigint, b bigint, band int")


def _spread(c: str):
    return F.explode(F.sequence(F.lit(0), F.col(c) - 1))


def edges_of(members: DataFrame, texts: DataFrame, k: int = SHINGLE, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Edges (a, b) whose components are those of all links in the clusters
    (p, band, y, n)."""
    zero = F.lit(0)
    blocks = F.ceil(F.sum("n") / block_size).cast("int")
    sizes = written(members.groupBy("p", "band").agg(blocks.alias("blocks")), "cluster-sizes")
    own = members.join(sizes, ["p", "band"]).select(
        "p", "band", F.pmod(F.xxhash64("y"), F.col("blocks")).cast("int").alias("block"), zero.alias("part"),
        F.lit(1).alias("role"), F.col("y").alias("id"), "n", "blocks")
    own = written(own, "cluster-members")
    centre = sizes.select("p", "band", _spread("blocks").alias("block"), zero.alias("part"), zero.alias("role"),
                          F.col("p").alias("id"), "blocks")
    first = written(verified(own.select(*_PLACE).unionByName(centre.select(*_PLACE)), texts, k), "cluster-edges")
    # Members outside of clusters of several blocks go to the other blocks.
    outside = first.where("band >= 0").select(F.col("a").alias("p"), "band", F.col("b").alias("id"))
    ask = written(own.where("blocks > 1").join(outside.distinct(), ["p", "band", "id"], "left_semi"), "cluster-queries")
    edges = first.where("band is null")
    if not ask.isEmpty():
        parts = written(ask.groupBy("p", "band").agg(blocks.alias("parts")), "cluster-parts")
        asked = ask.drop("block", "part", "role").join(parts, ["p", "band"]).select(
            "p", "band", _spread("blocks").alias("block"), F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"),
            F.lit(2).alias("role"), "id")
        held = own.where("blocks > 1").select("p", "band", "block", "role", "id").unionByName(
            centre.where("blocks > 1").select("p", "band", "block", "role", "id"))
        held = held.join(parts, ["p", "band"]).select("p", "band", "block", _spread("parts").alias("part"), "role", "id")
        edges = edges.unionByName(verified(asked.unionByName(held), texts, k).where("band is null"))
    return edges.select("a", "b")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    small: int = SMALL, hold: int = HOLD, block_size: int = BLOCK_SIZE, hot: int = HOT,
                    hot_least: int = HOT_LEAST) -> tuple[DataFrame, DataFrame]:
    """(rows, components): (id, n, d1, d2) for every row, and (node, component)
    for the ids that link to others."""
    d = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    facts = written(d.mapInArrow(lambda it: make_facts(it, k, hot_least), _FACTS), "shingle-facts")
    rows = facts.where("n is not null").select("id", "n", "d1", "d2")
    with scratch():
        found = _linked_components(d.where("id is not null"), facts, rows, k, small, hold, block_size, hot)
        return rows, written(found, "components", keep=True)


def _linked_components(real: DataFrame, facts: DataFrame, rows: DataFrame, k: int, small: int, hold: int,
                       block_size: int, hot: int) -> DataFrame:
    """(node, component) of the ids that link; its tables are scratch."""
    # at most ``hot`` rows of two numbers
    top = (facts.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
           .orderBy(F.desc("times"), "token").limit(hot).toArrow())
    token, times = top.column("token").to_numpy().view(np.uint64), top.column("times").to_numpy()
    order = np.argsort(token)
    token, times = token[order], times[order]
    posted = real.mapInArrow(lambda it: post_prefixes(it, k, token, times), "token bigint, n int, id bigint")
    sorted_posts = posted.repartition("token").sortWithinPartitions("token")
    meetings = written(sorted_posts.mapInArrow(lambda it: meet(it, small, hold), _MEETINGS), "meetings")
    # documents with equal sets are one from here on
    same = written(rows.where("n > 0 and id is not null").groupBy("n", "d1", "d2").agg(F.min("id").alias("rep")), "set-classes")
    reps = rows.where("n > 0 and id is not null").join(same, ["n", "d1", "d2"]).select("id", "rep", "n").distinct()
    reps = written(reps, "set-reps")
    members = written(prefix_groups(meetings, reps), "prefix-groups")
    c = written(expanded(clusters(meetings), reps, members), "clusters")
    links = edges_of(c, real, k, block_size)
    copies = reps.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    return components(links.unionByName(copies))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_shingles, component_id), a row per input row."""
    rows, comps = link_components(docs, id_col, text_col, **options)
    j = rows.join(comps, rows["id"] == comps["node"], "left")
    return j.select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with the least id of their component, and those with a
    null id, with all their columns."""
    _, comps = link_components(docs, id_col, text_col, **options)
    gone = written(comps.where("node <> component").select(F.col("node").alias("__gone")), "near-copies")
    return docs.join(gone.hint("merge"), F.col(f"`{id_col}`") == F.col("__gone"), "left_anti")


def link_report(docs: DataFrame) -> DataFrame:
    """Digest: the class of every document."""
    return classes(docs).withColumnRenamed("id", "doc_id")
