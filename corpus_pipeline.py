"""The corpus pipeline: toxicity filter, line dedup, near-duplicate removal,
benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All stages but the
last return the columns of ``documents``; each decision takes effect:

1. toxicity: documents whose score reaches their language's threshold go;
2. line dedup: repeated lines leave their texts (``n_chars`` follows);
3. near duplicates: of each group of linked documents the least id stays;
4. decontamination: documents that overlap a benchmark item go;
5. packing: what is left becomes pieces placed in sequences.

Defined cases: a null or empty text stays as it is in stages 1 to 4 (it has no word,
no long line, no shingle and no overlap; only where the score's bias alone reaches
the threshold, as can be with few labels, does stage 1 drop it) and is packed as the end id. Rows with a null id count as no other's
documents in stages 2 and 3 and stay. Rows that repeat an id are judged by their own
texts in stages 1, 2 and 4, are one document with the links of each in stage 3, and
are packed each by itself. An empty table passes all stages. Columns beyond those of
``documents`` pass stages 1 to 4 unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.llm import kk_packing, line_dedup, prefix_join, spaced_seeds, toxicity_cnn
from carlot.llm.common import read_table, written
from carlot.session import ship_package


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_cnn.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the operator's own counts must not take the place of columns of their name
    aside = {c: f"__kept_{c}" for c in docs.columns if c.lower() in ("n_lines", "n_dropped")}
    d = line_dedup.dedup_lines(docs.withColumnsRenamed(aside))
    chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    d = d.withColumn("n_chars", chars).drop("n_lines", "n_dropped")
    return d.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return prefix_join.keep_one(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spaced_seeds.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return kk_packing.packing_report(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
