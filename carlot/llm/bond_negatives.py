"""Operator 13: hard negatives by a BOND vertical scan.

Rows are stored by dimension. An anchor reads the dimensions in descending order
of its own magnitudes; after each few of them, a candidate's score lies between
what it has so far plus the least and plus the most that the dimensions left can
add (from each column's minimum and maximum). Candidates whose range can't reach
a wanted window leave the bitmap; those that stay to the end have exact scores.

Anchors are the rows whose id is divisible by ``EVERY``; they meet all rows in
tiles of a block of rows and a block of anchors, both of bounded size, so that
neither side is held whole anywhere. The scan runs twice:

1. for each anchor the ``POSITIVES`` best rows of its label;
2. for each of these the ``NEGATIVES`` best rows of other labels whose score lies
   in the window LEAST..MOST percent of the positive's.

A tile returns at most those numbers for each anchor; a window function with a
limit before its shuffle merges the tiles.

Arithmetic is exact: components are integers, floor(256 * x), and every sum is
below 2**53 (doubles) or else below 2**62 (64-bit integers).

Defined cases: a null id, label or vector, a null or non-finite component, an
empty vector, or a squared norm after scaling of 2**62 or more: the row takes no
part. Of rows that repeat an id the least (label, vector) counts. Vectors of
different length never meet. Ties go to the smaller id. A positive score of 0
has the window 0..0, a negative one has none. Anchors without positives, and
positives without negatives, give no rows; neither does an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carlot.llm.common import written
from carlot.session import ship_package

EVERY, POSITIVES, NEGATIVES = 100, 5, 10
SCALE = 256
#: Window of a negative's score, in percent of the positive's.
LEAST, MOST = 30, 90
#: Rows and anchors of a tile.
ROWS, ANCHORS = 8192, 4096
#: Dimensions read between two looks at the bounds.
STEP = 16


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
           label: Column | None = None) -> DataFrame:
    """(id, label, v, dim): the rows that take part, one for each id, components scaled."""
    v = F.col(f"`{vec_col}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                     (F.col(f"`{label_col}`") if label is None else label).cast("bigint").alias("label"), v.alias("raw"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull()
                      & fine & (F.size("raw") > 0))
    rows = rows.withColumn("v", F.transform("raw", lambda x: _floor(F.lit(float(SCALE)) * x.cast("double")))).drop("raw")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.where(norm < F.lit(float(1 << 62)))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("id", "r.label", "r.v", F.size("r.v").alias("dim"))


def _floor(x: Column) -> Column:
    """Floor that stays a double (Spark's own gives a 64-bit integer)."""
    down = F.rint(x)
    return F.when(down > x, down - 1.0).otherwise(down)


def matrix(column) -> np.ndarray:
    """A list column whose rows have one length, as (rows, length)."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


class Columns:
    """A block of rows, by dimension."""

    def __init__(self, v: np.ndarray):
        peak = float(np.einsum("ij,ij->i", v, v).max(initial=0.0))
        #: exact in doubles up to 2**53, else in 64-bit integers
        self.kind = np.float64 if peak < float(1 << 52) else np.int64
        self.cols = np.ascontiguousarray(v.T.astype(self.kind))
        self.low, self.high = v.min(axis=0), v.max(axis=0)

    def scan(self, anchor: np.ndarray, mask: np.ndarray, keep, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of the candidates in ``mask`` that ``keep``
        never gave up; ``keep(low, high)`` tells which ranges still matter."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        most = np.maximum(anchor * self.low, anchor * self.high)[order]
        least = np.minimum(anchor * self.low, anchor * self.high)[order]
        above = np.append(np.cumsum(most[::-1])[::-1], 0.0)      # what dimensions i.. can add
        below = np.append(np.cumsum(least[::-1])[::-1], 0.0)
        slack = 1e-12 * (above[0] - below[0])                    # of the bounds, which are rounded
        wide = float(anchor @ anchor) >= float(1 << 52)
        kind = np.int64 if wide or self.kind is np.int64 else np.float64
        a = anchor[order].astype(kind)
        rows = np.flatnonzero(mask)
        part = np.zeros(len(rows), kind)
        whole = len(rows) == self.cols.shape[1]
        for i in range(0, len(order), step):
            dims = order[i:i + step]
            block = self.cols[dims] if whole else self.cols[np.ix_(dims, rows)]
            part = part + a[i:i + step] @ block.astype(kind, copy=False)
            j = min(i + step, len(order))
            stay = keep(part + (below[j] - slack), part + (above[j] + slack)) if j < len(order) else keep(part, part)
            if not stay.all():
                rows, part, whole = rows[stay], part[stay], False
            if not len(rows):
                break
        return rows, part


def best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by descending score and ascending id."""
    if len(rows) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        inner = np.flatnonzero(scores >= edge)
    else:
        inner = np.arange(len(rows))
    return inner[np.lexsort((ids[rows[inner]], -scores[inner]))[:k]]


def kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def scan_positives(rows: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    names = ["anchor_id", "positive_id", "positive_score"]
    out: list[list] = [[], [], []]
    if rows.num_rows and anchors.num_rows:
        block, ids, labels = Columns(matrix(rows["v"])), rows["id"].to_numpy(), rows["label"].to_numpy()
        for a, own, v in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), matrix(anchors["v"]), strict=True):
            found, scores = block.scan(v, (labels == own) & (ids != a), lambda low, high: high >= kth(low, k))
            top = best(found, scores, ids, k)
            out[0].append(np.full(len(top), a))
            out[1].append(ids[found[top]])
            out[2].append(scores[top])
    return pa.table([pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for x in out], names)


def windows(positive: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Integer bounds of least * p <= 100 * s <= most * p, without the products."""
    whole, rest = np.divmod(positive, 100)
    return least * whole - (-least * rest // 100), most * whole + most * rest // 100


def scan_negatives(rows: pa.Table, anchors: pa.Table, k: int, least: int, most: int) -> pa.Table:
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    out: list[list] = [[], [], [], [], []]
    if rows.num_rows and anchors.num_rows:
        block, ids, labels = Columns(matrix(rows["v"])), rows["id"].to_numpy(), rows["label"].to_numpy()
        for a, own, v, pos in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), matrix(anchors["v"]),
                                  anchors["positives"].to_pylist(), strict=True):
            p = np.array([x["positive_score"] for x in pos], np.int64)
            low_end, high_end = windows(p, least, most)
            open_ = np.unique(np.stack([low_end, high_end], axis=1)[low_end <= high_end], axis=0)

            def keep(low, high, open_=open_):
                stay = np.zeros(len(low), bool)
                for x, y in open_:
                    sure = low[(low >= x) & (high <= y)]
                    stay |= (high >= max(x, kth(sure, k))) & (low <= y)
                return stay

            found, scores = block.scan(v, labels != own, keep) if len(open_) else (np.empty(0, np.int64),) * 2
            for x, lo, hi in zip(pos, low_end, high_end, strict=True):
                inside = np.flatnonzero((scores >= lo) & (scores <= hi))
                top = inside[best(found[inside], scores[inside], ids, k)]
                for c, value in zip(out, (a, x["positive_id"], x["positive_score"]), strict=False):
                    c.append(np.full(len(top), value))
                out[3].append(ids[found[top]])
                out[4].append(scores[top])
    return pa.table([pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for x in out], names)


def _tiles(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, rows_per: int, anchors_per: int, scan, kinds: str):
    """``scan`` over every block of rows with every block of anchors."""
    rb, ab = max(1, -(-n_rows // rows_per)), max(1, -(-n_anchors // anchors_per))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("rb", block(rb)).withColumn("ab", spread(ab))
    right = anchors.withColumn("ab", block(ab)).withColumn("rb", spread(rb))
    right = right.select(*[F.col(c).alias(c) for c in right.columns])     # columns of its own
    return left.groupBy("dim", "rb", "ab").cogroup(right.groupBy("dim", "rb", "ab")).applyInArrow(scan, kinds)


def first_of(df: DataFrame, by: list[str], score: str, ident: str, k: int, rank: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(score), ident)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def hard_negatives(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least: int = LEAST, most: int = MOST, rows_per: int = ROWS, anchors_per: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for ``rows`` as ``usable`` gives them."""
    ship_package(rows.sparkSession)
    rows = written(rows, "bond-rows")
    anchors = rows.where(F.col("id") % every == 0)
    n_rows, n_anchors = rows.count(), anchors.count()
    near = _tiles(rows, anchors, n_rows, n_anchors, rows_per, anchors_per,
                  lambda r, a: scan_positives(r, a, positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    near = written(first_of(near, ["anchor_id"], "positive_score", "positive_id", positives, "place"), "bond-positives")
    wanted = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asking = anchors.join(wanted, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    far = _tiles(rows, asking, n_rows, n_anchors, rows_per, anchors_per,
                 lambda r, a: scan_negatives(r, a, negatives, least, most),
                 "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    ranked = first_of(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def negatives_report(embeddings: DataFrame) -> DataFrame:
    """The registered query: labels of ids divisible by 7 move on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(usable(embeddings, label=label))
