"""Operator 4: toxicity by a convolutional text classifier, trained in numpy.

Words (runs of letters and digits, A-Z lower-cased) are embedded by hashing:
a word's vector is the sum of the rows for its own hash and for the hashes of
its first four and six bytes, so inflected forms share rows. Filters of several
widths slide over the vectors; each keeps its maximum over the whole text, and
a logistic layer turns the maxima into a score. The score sees nothing but the
text.

The classifier is fitted on the driver on at most ``PER_CLASS`` labelled rows
of each class, picked by the hash of their id; those whose text has more than
``FIT_BYTES`` bytes take no part, which bounds the driver's memory. The model has
a fixed size and travels in the task closure. Everything else runs over all rows: scoring is a
narrow Arrow step that takes a text in blocks, so memory doesn't grow with it,
and the thresholds come from a histogram of all calibration rows.

Folds by crc32(id as text) mod 5: 0 is held out, 1 to 4 train. The thresholds are
calibrated on fold 1 with the scores of a second model, fitted on the sample's
other folds alone. The cut of the best F1 (ties: the nearest to 0.5) is taken over
each language's calibration rows and over those of all languages. A language's
threshold is the mean of the two, its own weighted by its toxic calibration rows
and the common one by ``PRIOR`` rows, kept within ``CUT_RANGE``: the same rule at
every size. A language without toxic or without clean calibration rows has the
common one; without any in the whole table it is 0.5.

Defined cases: null or empty text has no word and scores the bias alone;
null labels are left out; an id with several labels has the largest;
without labels of both classes the score is 0 for
all; repeated rows score alike; null languages share a threshold; other
columns pass through ``drop_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carlot.llm.common import written
from carlot.llm.textarrays import IN_NAME, LOWER_TABLE, slices, text_buffer, word_hashes, word_spans
from carlot.session import ship_package

#: Labelled rows of each class that the fit may use.
PER_CLASS = 2500
#: Bytes of the longest text that the fit takes (scoring takes all, whole).
FIT_BYTES = 1 << 15
WORD_ROWS, PREFIX_ROWS, DIM = 1 << 16, 1 << 16, 16
PREFIXES = (4, 6)
WIDTHS = (1, 2, 3)
FILTERS = 16
REACH = max(WIDTHS) - 1
EPOCHS, MIN_STEPS, BATCH, RATE = 6, 600, 32, 0.1
#: Positions convolved at a time while scoring.
WORK = 1 << 15
BINS = 1000
#: Toxic calibration rows that the common cut of all languages weighs, and the
#: range of the thresholds.
PRIOR = 30
CUT_RANGE = (0.25, 0.75)


def word_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of every word: own hash and prefixes, first word of each text)."""
    low = LOWER_TABLE[buf]
    s, e, at = word_spans(low, offsets, IN_NAME)
    cols = [word_hashes(low, s, e) % np.uint64(WORD_ROWS)]
    cols += [word_hashes(low, s, np.minimum(e, s + k)) % np.uint64(PREFIX_ROWS) for k in PREFIXES]
    return np.stack(cols, axis=1).astype(np.int32), at


class TextCnn:
    """Hashed embeddings, filters of several widths, max pooling, logistic output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = np.float32
        self.tables = [r.normal(0, 0.1, (n, DIM)).astype(f) for n in (WORD_ROWS, *[PREFIX_ROWS] * len(PREFIXES))]
        self.filters = {k: r.normal(0, (k * DIM) ** -0.5, (k, DIM, FILTERS)).astype(f) for k in WIDTHS}
        self.bias = {k: np.zeros(FILTERS, f) for k in WIDTHS}
        self.out, self.shift = np.zeros(len(WIDTHS) * FILTERS, f), 0.0

    def embed(self, rows: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Sum of a word's rows; where ``own`` is 0, without its own row."""
        x = self.tables[0][rows[:, 0]]
        if own is not None:
            x *= own[:, None]
        for t, c in zip(self.tables[1:], rows.T[1:], strict=True):
            x += t[c]
        return x

    def lay_out(self, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows in filter order for the stretches of words lo..hi, each followed
        by the words its last filters reach (or -1 past its text's end)."""
        n = hi - lo + REACH
        base = np.concatenate([[0], np.cumsum(n)])
        pos = np.arange(base[-1]) - np.repeat(base[:-1], n) + np.repeat(lo, n)
        return np.where(pos < np.repeat(end, n), pos, -1), base

    def vectors(self, rows: np.ndarray, pos: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        x = np.zeros((len(pos), DIM), np.float32)
        real = np.flatnonzero(pos >= 0)
        x[real] = self.embed(rows[pos[real]], None if own is None else own[real])
        return x

    def convolve(self, x: np.ndarray, k: int) -> np.ndarray:
        """Output of the width-``k`` filters at every start."""
        out = x @ self.filters[k][0]
        for j in range(1, k):
            out[:-j] += x[j:] @ self.filters[k][j]
        return out + self.bias[k]

    def pooled(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Maximum of every filter over each text, at least 0."""
        best = np.zeros((len(at) - 1, len(WIDTHS) * FILTERS), np.float32)
        for doc, lo, hi, end in stretches(at):
            pos, base = self.lay_out(rows, lo, hi, end)
            x = self.vectors(rows, pos)
            tails = (base[1:, None] - 1 - np.arange(REACH)).ravel()
            top = []
            for k in WIDTHS:
                h = self.convolve(x, k)
                h[tails] = 0
                top.append(np.maximum.reduceat(h, base[:-1], axis=0))
            np.maximum.at(best, doc, np.concatenate(top, axis=1))
        return best

    def score(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        z = self.pooled(rows, at) @ self.out + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))

    def fit(self, rows: np.ndarray, at: np.ndarray, y: np.ndarray, seed: int = 7) -> TextCnn:
        """Logistic loss, each class with half the weight, Adagrad on the rows
        that a text's maxima come from."""
        r = np.random.default_rng(seed)
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        grads = {id(p): np.zeros_like(p) for p in (*self.tables, *self.filters.values(), *self.bias.values(), self.out)}
        shift_sum = 0.0

        def step(p: np.ndarray, g: np.ndarray, where=slice(None)) -> None:
            acc = grads[id(p)]
            acc[where] += g * g
            p[where] -= RATE * g / (np.sqrt(acc[where]) + 1e-6)

        for _ in range(max(EPOCHS, -(-MIN_STEPS * BATCH // len(y)))):
            order = r.permutation(len(y))
            for i in range(0, len(y), BATCH):
                b = order[i:i + BATCH]
                pos, base = self.lay_out(rows, at[b], at[b + 1], at[b + 1])
                # half of the words come without their own row, so that prefixes learn too
                own = (r.random(len(pos)) < 0.5).astype(np.float32)
                x = self.vectors(rows, pos, own)
                best, where = [], []
                for k in WIDTHS:
                    h = self.convolve(x, k)
                    peak = [h[s:e - REACH].argmax(axis=0) + s if e - REACH > s else np.full(FILTERS, s)
                           for s, e in zip(base[:-1], base[1:], strict=True)]
                    where.append(np.array(peak))
                    best.append(np.take_along_axis(h, where[-1], axis=0) if len(h) else h)
                top = np.maximum(np.concatenate(best, axis=1), 0)
                top[at[b] == at[b + 1]] = 0
                prob = 1 / (1 + np.exp(-np.clip(top @ self.out + self.shift, -30, 30)))
                err = ((prob - y[b]) * weight[b] / len(b)).astype(np.float32)
                back = err[:, None] * self.out * (top > 0)
                step(self.out, top.T @ err)
                g0 = float(err.sum())
                shift_sum += g0 * g0
                self.shift -= RATE * g0 / (shift_sum ** 0.5 + 1e-6)
                touched, dx, owned = [], [], []
                for i_k, k in enumerate(WIDTHS):
                    g = back[:, i_k * FILTERS:(i_k + 1) * FILTERS]
                    # an empty text has no window; its gradient is zero wherever it points
                    win = np.minimum(where[i_k][:, :, None] + np.arange(k), len(pos) - 1)
                    d_in = g[:, :, None, None] * self.filters[k].transpose(2, 0, 1)[None]
                    touched.append(pos[win].ravel())
                    owned.append(own[win].ravel())
                    dx.append(d_in.reshape(-1, DIM))
                    step(self.filters[k], np.einsum("bf,bfkd->kdf", g, x[win]))
                    step(self.bias[k], g.sum(axis=0))
                at_word, d = np.concatenate(touched), np.concatenate(dx)
                for c, table in enumerate(self.tables):
                    real = (at_word >= 0) & ((np.concatenate(owned) > 0) | (c > 0))
                    u, inv = np.unique(rows[at_word[real], c], return_inverse=True)
                    total = np.zeros((len(u), DIM), np.float32)
                    np.add.at(total, inv, d[real])
                    step(table, total, u)
        return self


def stretches(at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first word, end word, text's end) arrays of about ``WORK`` words:
    whole short texts together, long texts a part at a time."""
    lens = np.diff(at)
    parts = -(-lens // WORK)
    doc = np.repeat(np.arange(len(lens)), parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    lo = at[:-1][doc] + nth * WORK
    end = at[1:][doc]
    hi = np.minimum(lo + WORK, end)
    room = np.cumsum(hi - lo + REACH) // WORK
    for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(room)) + 1) if len(doc) else []:
        yield doc[part], lo[part], hi[part], end[part]


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % 5


def one_label(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(_id, y): one label for each id, the largest of those that are not null."""
    y = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col("toxic").cast("int").alias("y"))
    return y.where(F.col("_id").isNotNull() & F.col("y").isNotNull()).groupBy("_id").agg(F.max("y").alias("y"))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(_d, text, y, calibrates): at most ``per_class`` labels of each class of the
    training folds, and the texts of up to ``FIT_BYTES`` bytes that they mark."""
    y = one_label(labels, id_col).where(fold(F.col("_id")) >= 1)
    pick = [y.where(F.col("y") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)]
    # at most 2 * per_class ids, so the broadcast is bounded by that parameter
    ids = F.broadcast(pick[0].unionByName(pick[1]))
    return docs.select(F.col(f"`{id_col}`").alias("_d"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).join(
        ids, F.col("_d") == F.col("_id")).where(F.octet_length("text") <= FIT_BYTES).select(
        "_d", "text", "y", (fold(F.col("_id")) == 1).alias("calibrates"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[TextCnn | None, TextCnn | None]:
    """(model of the bounded sample, model of its rows outside the calibration
    fold); None where there are no rows of both classes."""
    t = training_rows(docs, labels, per_class, id_col, text_col).toArrow().sort_by([("_d", "ascending"), ("text", "ascending")])
    if not t.num_rows:
        return None, None
    y = t.column("y").to_numpy()
    buf, offsets = text_buffer(t.column("text").combine_chunks())
    # a slice at a time: the driver holds the features of the sample, not the work arrays
    parts = [word_features(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in slices(offsets, 1 << 20)]
    at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(a) for _, a in parts]))])
    rows = np.concatenate([r for r, _ in parts])

    def fitted(use: np.ndarray) -> TextCnn | None:
        if not use.any() or y[use].min() == y[use].max():
            return None
        lens = np.diff(at)
        return TextCnn().fit(rows[np.repeat(use, lens)], np.concatenate([[0], np.cumsum(lens[use])]), y[use])

    return fitted(np.ones(len(y), bool)), fitted(~t.column("calibrates").to_numpy())


def score_texts(docs: DataFrame, model: TextCnn | None, text_col: str = "text") -> DataFrame:
    """``docs`` with a ``score`` of 0 to 1 from the whole text."""
    keep = [c for c in docs.columns if c.lower() != "score"]
    d = docs.select(*[F.col(f"`{c}`") for c in keep])
    if model is None:
        return d.withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)   # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cnn = shared.value
        for b in batches:
            buf, offsets = text_buffer(b.column(text_col))
            out = np.zeros(b.num_rows)
            for i, j in slices(offsets):
                out[i:j] = cnn.score(*word_features(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields)
    return d.mapInArrow(run, kinds + ", score double")


def thresholds(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, threshold) from (doc_id, lang, score): best F1 on the calibration
    fold, over a histogram of ``BINS`` bins, drawn to the cut of all languages.
    The row of a null lang holds that one; a null language counts as ''."""
    rows = scored.join(one_label(labels.where(fold(F.col("doc_id")) == 1)), F.col("doc_id") == F.col("_id"))
    hist = rows.groupBy(F.coalesce("lang", F.lit("")).alias("lang"), F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))
    hist = written(hist, "toxicity-histogram")
    # a row per language and bin, and per bin for all: at most BINS + 1 for each language
    hist = hist.unionByName(hist.groupBy(F.lit(None).cast("string").alias("lang"), "bin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")))
    above = Window.partitionBy("lang").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("lang")
    # every cut above the next lower bin gives the same decisions: take the one nearest to 0.5
    lower = F.coalesce(F.lag("bin", -1).over(Window.partitionBy("lang").orderBy(F.desc("bin"))) + 1, F.lit(0))
    c = hist.select("lang", "bin", F.sum("pos").over(above).alias("tp"), F.sum("n").over(above).alias("flagged"),
                    F.sum("pos").over(every).alias("all"), F.sum("n").over(every).alias("rows"),
                    F.least(F.col("bin"), F.greatest(lower, F.lit(BINS // 2))).alias("cut"))
    cut = F.col("cut") / F.lit(float(BINS))
    f1 = 2 * F.col("tp") / (F.col("flagged") + F.col("all"))
    best = c.where((F.col("all") > 0) & (F.col("all") < F.col("rows"))).groupBy("lang").agg(
        F.max(F.struct(f1.alias("f1"), (-F.abs(cut - 0.5)).alias("near"), cut.alias("cut"))).alias("b"), F.max("all").alias("toxic"))
    best = written(best.select("lang", "b.cut", "toxic"), "toxicity-best")
    common = F.broadcast(best.where("lang is null").agg(F.max("cut").alias("common")))   # one row
    mean = F.when(F.col("lang").isNull(), F.col("cut")).otherwise(
        (F.col("toxic") * F.col("cut") + PRIOR * F.col("common")) / (F.col("toxic") + PRIOR))
    low, high = CUT_RANGE
    return best.crossJoin(common).select("lang", F.least(F.greatest(mean, F.lit(low)), F.lit(high)).alias("threshold"))


def judged(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, __t, lang, score, threshold, flagged), a row per document; ``__t``
    is the hash of its text. The texts are read where they lie, never moved: for the
    fit, for the calibration fold and for the scores."""
    ship_package(docs.sparkSession)
    model, other = train(docs, labels, per_class)
    scores = written(score_texts(docs.select("doc_id", "lang", "text"), model).select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__t"), "lang", "score"), "toxicity-scores")
    unseen = docs.select("doc_id", "lang", "text").where(fold(F.col("doc_id")) == 1)
    unseen = written(score_texts(unseen if other else unseen.limit(0), other).select("doc_id", "lang", "score"), "toxicity-calibration")
    cuts = written(thresholds(unseen, labels), "toxicity-cuts")
    joined = scores.withColumn("__l", F.coalesce("lang", F.lit(""))).join(
        cuts.withColumnRenamed("lang", "__l"), "__l", "left").crossJoin(
        F.broadcast(cuts.where("lang is null").agg(F.max("threshold").alias("__common"))))   # one row
    cut = F.coalesce("threshold", "__common", F.lit(0.5))
    return joined.select("doc_id", "__t", "lang", "score", cut.alias("threshold"), (F.col("score") >= cut).alias("flagged"))


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The documents whose score is under their language's threshold."""
    gone = written(judged(docs, labels, per_class).where("flagged").select("doc_id", "__t").distinct(), "toxic-ids")
    d = docs.withColumn("__t", F.xxhash64(F.coalesce("text", F.lit(""))))
    # by exchange at every size: the cost stays linear as the ids outgrow a broadcast
    return d.join(gone.hint("merge"), d["doc_id"].eqNullSafe(gone["doc_id"]) & (d["__t"] == gone["__t"]), "left_anti").drop("__t")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Digest: score and decision for every document."""
    return judged(docs, labels).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "lang", "threshold", "flagged")
