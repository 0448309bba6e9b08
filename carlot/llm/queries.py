"""The registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from carlot.llm import (bond_negatives, collocations, fingerprint_dedup, kk_packing, line_dedup, link_trust, pfor,
                        pivot_join, prefix_join, rendezvous, spaced_seeds, surrogates, toxicity_cnn)
from carlot.llm.common import read_table


def op1_fingerprint_dedup(spark, sf_dir):
    return fingerprint_dedup.dedup_report(read_table(spark, sf_dir, "documents"))


def op2_surrogates(spark, sf_dir):
    return surrogates.surrogate_report(read_table(spark, sf_dir, "documents"))


def op3_link_trust(spark, sf_dir):
    return link_trust.url_report(read_table(spark, sf_dir, "pages"))


def op4_toxicity_cnn(spark, sf_dir):
    return toxicity_cnn.toxicity_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_kk_packing(spark, sf_dir):
    return kk_packing.packing_report(read_table(spark, sf_dir, "documents"))


def op6_pfor_ids(spark, sf_dir):
    return pfor.ids_report(read_table(spark, sf_dir, "documents"))


def op7_prefix_join(spark, sf_dir):
    return prefix_join.link_report(read_table(spark, sf_dir, "documents"))


def op8_spaced_seeds(spark, sf_dir):
    return spaced_seeds.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_rendezvous(spark, sf_dir):
    return rendezvous.shard_report(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark, sf_dir):
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"))


def op11_pivot_join(spark, sf_dir):
    return pivot_join.near_report(read_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark, sf_dir):
    return collocations.collocation_report(read_table(spark, sf_dir, "documents"))


def op13_bond_negatives(spark, sf_dir):
    return bond_negatives.negatives_report(read_table(spark, sf_dir, "embeddings"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_fingerprint_dedup, op2_surrogates, op3_link_trust, op4_toxicity_cnn, op5_kk_packing, op6_pfor_ids,
    op7_prefix_join, op8_spaced_seeds, op9_rendezvous, op10_line_dedup, op11_pivot_join, op12_collocations,
    op13_bond_negatives, pipeline)}
