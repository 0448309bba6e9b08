"""Operator 11: exact metric range join of vectors, and its components.

Unit vectors link when their cosine is SIMILARITY or more, that is, when their
distance is at most r = sqrt(2 - 2 * SIMILARITY). The steps:

1. Equal vectors become one group with a count, so copies cost nothing.
2. Pivots, a bounded number of the groups picked by hash, partition the groups:
   each belongs to the cell of its nearest pivot.
3. By the triangle inequality a vector y of cell q lies (d(y,p) - d(y,q)) / 2 or
   more from every point of cell p. For unit vectors the plane between the pivots
   sharpens this to (d(y,p)^2 - d(y,q)^2) / (2 d(p,q)), never less since
   d(p,q) <= d(y,p) + d(y,q). If that is at most r, y is replicated to cell p. Of
   two cells, one takes the other's boundary, so each pair meets once.
4. Cells join independently. A cell is cut into blocks of bounded size, and every
   two blocks that have to meet make a tile of their own, so a cell that holds
   most vectors is many small tasks. In a tile all cosines are taken in double
   precision; it returns the number of links of each vector, and instead of the
   pairs a forest with the same components.
5. Link counts are summed, components joined, and every row gets its group's.

Nothing is capped: ``PIVOTS`` only bounds the number of cells, ``BLOCK`` the size
of a tile. Vectors without structure lie near most planes; the join then compares
most pairs, in tiles of the same size.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component link with nothing, nor do vectors of different length. Rows that repeat
a vector or an id are vectors of their own, linked like all others. A null id has
no part in a component's least id (null if there is no other), and is never kept.
An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.bond_negatives import matrix
from carlot.llm.common import written
from carlot.llm.components import components
from carlot.session import ship_package

SIMILARITY = 0.95
#: Cells are meant to hold about as many groups; there are at most PIVOTS pivots.
CELL, PIVOTS = 4096, 2048
#: Vectors of a block; a tile joins two blocks.
BLOCK = 4096
#: Between pivots nearer than this no plane is drawn: all is replicated.
SAME_PIVOT = 1e-3
#: Cosines this near to the bound are taken again with exactly rounded sums.
NEAR = 1e-9


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a.astype(np.float64), b.astype(np.float64)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def place(u: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home cell of each row of ``u``, and (row, cell) of its replicas."""
    cos = u @ pivots.T
    home = cos.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (pivots @ pivots.T), 0.0))
    apart[apart < SAME_PIVOT] = np.inf
    # d(y,p)^2 - d(y,q)^2 = 2 (cos(y,q) - cos(y,p)), all of length one
    beyond = (cos[np.arange(len(u)), home][:, None] - cos) / apart[home]
    cell = np.arange(len(pivots))
    takes = (cell[None, :] < home[:, None]) == ((cell[None, :] + home[:, None]) % 2 == 0)
    row, to = np.nonzero((beyond <= radius + NEAR) & takes & (cell[None, :] != home[:, None]))
    return home, row, to


_PLACED = "gid bigint, dim int, cell int, home boolean"


def assign(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray], radius: float) -> Iterator[pa.RecordBatch]:
    """(gid, dim, cell, home) rows: the home of every group and its replicas.
    Vectors of a length that no pivot has are one cell, numbered -1."""
    for b in batches:
        gid, dim = b.column("gid").to_numpy(), b.column("dim").to_numpy()
        for d in np.unique(dim):
            at = np.flatnonzero(dim == d)
            g = gid[at]
            if int(d) in pivots:
                home, row, to = place(unit(matrix(b.column("v").take(pa.array(at)))), pivots[int(d)], radius)
            else:
                home, row, to = np.full(len(g), -1), np.empty(0, np.int64), np.empty(0, np.int64)
            n = len(g) + len(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([g, g[row]])), pa.array(np.full(n, d, np.int32)),
                 pa.array(np.concatenate([home, to]).astype(np.int32)), pa.array(np.arange(n) < len(g))],
                ["gid", "dim", "cell", "home"])


def joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of ``n`` nodes reaches over the edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(before, root):
            return root


_LINKS = "gid bigint, links bigint, a bigint, b bigint"


def join_tile(t: pa.Table, similarity: float, rows: int = 512) -> pa.Table:
    """Links between the two blocks of a tile, or within its only one: (gid,
    links) for each vector that has some, (a, b) edges that join them."""
    gid, w = t["gid"].to_numpy(), t["n"].to_numpy()
    raw = matrix(t["v"])
    u = unit(raw)
    left = np.flatnonzero(t["left"].to_numpy(zero_copy_only=False))
    own = bool(t["same"][0].as_py())
    right = left if own else np.flatnonzero(~t["left"].to_numpy(zero_copy_only=False))
    links = np.zeros(len(gid), np.int64)
    root = np.arange(len(gid))
    other = u[right].T
    for i in range(0, len(left), rows):
        part = left[i:i + rows]
        cos = u[part] @ other
        hit = cos >= similarity + NEAR
        for x, y in zip(*np.nonzero((cos >= similarity - NEAR) & ~hit), strict=True):
            hit[x, y] = exact_cosine(raw[part[x]], raw[right[y]]) >= similarity
        if own:
            hit[np.arange(len(part)), np.arange(i, i + len(part))] = False
        links[part] += hit @ w[right]
        if not own:
            links[right] += w[part] @ hit
        x, y = np.nonzero(hit)
        if len(x):
            root = joined(np.concatenate([part[x], np.arange(len(gid))]), np.concatenate([right[y], root]), len(gid))
    has = np.flatnonzero(links)
    hung = np.flatnonzero(root != np.arange(len(gid)))
    pad = lambda n: pa.nulls(n, pa.int64())
    col = lambda x, y: pa.chunked_array([x, y])
    ints = lambda x: pa.array(x, pa.int64())
    return pa.table([col(ints(gid[has]), pad(len(hung))), col(ints(links[has]), pad(len(hung))),
                     col(pad(len(has)), ints(gid[hung])), col(pad(len(has)), ints(gid[root[hung]]))], ["gid", "links", "a", "b"])


def tiles(placed: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """A row for each group and tile it takes part in: (dim, cell, i, k, same,
    left, gid, n, v). Blocks of residents are numbered from 0, those of replicas
    from -1 downwards; tile (i, k) joins resident block i with block k >= i of
    the residents or with a block of replicas."""
    number = lambda n: F.greatest(F.ceil(F.count_if(n) / block), F.lit(1)).cast("int")
    # a row for each cell and length
    sizes = written(placed.groupBy("dim", "cell").agg(
        number(F.col("home")).alias("own"), F.ceil(F.count_if(~F.col("home")) / block).cast("int").alias("guests")), "pivot-cells")
    p = placed.join(sizes, ["dim", "cell"])
    at = lambda n: F.pmod(F.xxhash64("gid"), F.greatest(n, F.lit(1))).cast("int")
    tile = lambda i, k, left: F.struct(i.cast("int").alias("i"), k.cast("int").alias("k"), F.lit(left).alias("left"))
    empty = F.array().cast("array<struct<i:int,k:int,left:boolean>>")
    upto = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(empty)
    me = at(F.col("own"))
    resident = F.concat(
        upto(F.col("own"), lambda k: F.when(k >= me, tile(me, k, True)).otherwise(tile(k, me, False))),
        upto(F.col("guests"), lambda k: tile(me, -1 - k, True)))
    replica = upto(F.col("own"), lambda i: tile(i, -1 - at(F.col("guests")), False))
    where = p.select("gid", "dim", "cell", F.explode(F.when(F.col("home"), resident).otherwise(replica)).alias("t"))
    where = where.select("gid", "cell", "t.i", "t.k", "t.left", (F.col("t.i") == F.col("t.k")).alias("same"))
    return where.join(groups.select("gid", "n", "v", "dim"), "gid")


def links_of(groups: DataFrame, similarity: float = SIMILARITY, cell: int = CELL, pivots: int = PIVOTS,
             block: int = BLOCK) -> DataFrame:
    """``_LINKS`` rows of ``groups`` (gid, n, v, dim)."""
    spark = groups.sparkSession
    ship_package(spark)
    wanted = min(pivots, max(1, -(-groups.count() // cell)))
    # at most PIVOTS rows, whatever the number of groups
    picked = groups.select("dim", "v").orderBy(F.xxhash64("gid"), "gid").limit(wanted).collect()
    by_dim: dict[int, np.ndarray] = {}
    for d in {r.dim for r in picked}:
        by_dim[d] = unit(np.array([r.v for r in picked if r.dim == d]))
    radius = math.sqrt(2 - 2 * similarity)
    placed = written(groups.select("gid", "dim", "v").mapInArrow(lambda it: assign(it, by_dim, radius), _PLACED), "pivot-placed")
    return tiles(placed, groups, block).groupBy("dim", "cell", "i", "k").applyInArrow(
        lambda t: join_tile(t, similarity), _LINKS)


def near_links(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", **options) -> DataFrame:
    """(id, n_links, component), one row for each row of ``df``."""
    v = F.col(f"`{vec_col}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.when(fine, v).alias("v"))
    groups = rows.where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    groups = written(groups.select(F.monotonically_increasing_id().alias("gid"), "n", "least", "v", F.size("v").alias("dim")),
                     "pivot-groups")
    found = written(links_of(groups, **options), "pivot-links")
    links = found.where("gid is not null").groupBy("gid").agg(F.sum("links").alias("others"))
    parts = written(components(found.where("a is not null").select("a", "b")).select(F.col("node").alias("gid"), "component"), "pivot-parts")
    g = groups.join(links, "gid", "left").join(parts, "gid", "left").withColumn("component", F.coalesce("component", "gid"))
    least = g.groupBy("component").agg(F.min("least").alias("component_id"))
    g = g.join(least, "component").select(F.col("v").alias("gv"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                                          "component_id")
    lone = F.col("v").isNull()
    return rows.join(g, F.col("v") == F.col("gv"), "left").select(
        "id", F.when(lone, F.lit(0)).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
        F.when(lone, F.col("id")).otherwise(F.col("component_id")).alias("component"))


def near_dedup(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", **options) -> DataFrame:
    """The rows of ``df`` that stay: those with the least id of their component
    (all rows that repeat this id); a null id never stays."""
    stay = near_links(df, id_col, vec_col, **options).where("id = component").select(F.col("id").alias("__stay")).distinct()
    return df.join(stay, F.col(f"`{id_col}`").cast("bigint") == F.col("__stay")).drop("__stay")


def near_report(embeddings: DataFrame) -> DataFrame:
    """Digest: the links and the class of every vector."""
    return near_links(embeddings).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
