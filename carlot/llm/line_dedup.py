"""Operator 10: drop lines that repeat across documents.

Lines are exploded and normalised, hashed, and the distinct documents per hash
are counted with map-side combined aggregates. A line found in ``min_docs``
documents or more stays only in the largest id that holds it. The text is
rebuilt by position inside its row, so the documents themselves are never
exploded through a shuffle: only (id, position, hash) of the long lines is.

Defined cases: null or empty text is one empty line; rows that repeat an id
count as one document; a row with a null id cannot be counted as a document
and passes unchanged; a text all of whose lines go becomes empty. Other
columns pass through, and columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import BLANKS, ascii_lower, written

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    """The normalised line: blanks stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(__id, __fp, __pos, __key): the hashed keys of the lines long enough.
    ``__fp`` tells rows apart that share an id but not a text."""
    lines = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__fp"),
        F.posexplode(_lines(F.col(text_col))).alias("__pos", "__line"))
    keyed = lines.select("__id", "__fp", "__pos", line_key(F.col("__line")).alias("__k"))
    return keyed.where(F.char_length("__k") >= min_chars).select(
        "__id", "__fp", "__pos", F.unhex(F.md5(F.col("__k"))).alias("__key"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(__id, __fp, __drop): per text, the positions of the lines to drop."""
    keys = written(long_lines(docs, id_col, text_col, min_chars), "line-keys")
    # The distinct count runs as (key, id) partial sums first, so a line that a
    # third of all documents share is spread over the tasks by id.
    # The few repeated keys are written: the join then reads plain exchanges,
    # whose hot keys Spark splits, or broadcasts them if their files are small.
    repeated = written(keys.groupBy("__key").agg(F.count_distinct("__id").alias("__n"), F.max("__id").alias("__stay"))
                       .where(F.col("__n") >= min_docs).select("__key", "__stay"), "line-repeats")
    hits = keys.join(repeated, "__key").where(F.col("__id") != F.col("__stay"))
    return hits.groupBy("__id", "__fp").agg(F.collect_set("__pos").alias("__drop"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with repeated lines taken out of ``text_col``, plus
    ``n_lines`` (before) and ``n_dropped``."""
    drops = dropped_lines(docs, id_col, text_col, min_chars, min_docs)
    d = docs.withColumn("__fp", F.xxhash64(F.col(text_col)))
    j = d.join(drops, (d[id_col] == drops["__id"]) & (d["__fp"] == drops["__fp"]), "left").drop(
        drops["__id"]).drop(drops["__fp"]).drop(d["__fp"])
    lines = _lines(F.col(text_col))
    # array_except is a hash lookup: linear in the lines, order kept.
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    kept = F.array_join(F.transform(stay, lambda p: F.get(F.col("__lines"), p)), "\n")
    out = j.withColumn("__lines", lines)
    text = F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(kept)
    cols = [F.col(f"`{c}`") if c != text_col else text.alias(text_col)
            for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return out.select(*cols, F.size("__lines").cast("bigint").alias("n_lines"),
                      F.coalesce(F.size("__drop"), F.lit(0)).cast("bigint").alias("n_dropped"))


def line_report(docs: DataFrame) -> DataFrame:
    """Digest of ``dedup_lines``: one row per document."""
    r = dedup_lines(docs.select("doc_id", "text"))
    kept = F.sha2(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"), 256)
    return r.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))
