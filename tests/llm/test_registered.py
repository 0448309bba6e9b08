"""The registered queries against DuckDB, and the pipeline stage by stage."""
import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from carlot.llm import toxicity_cnn as TX
from carlot.llm.common import written
from carlot.llm.oracles import SQL
from carlot.llm.queries import QUERIES
from carlot.sources.tables import TABLES
from tests.conftest import SF0001
from tests.llm import reference as R


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(QUERIES) - set(SQL) == {"op2_surrogates", "op4_toxicity_cnn", "op5_kk_packing", "op6_pfor_ids", "pipeline"}
    assert CP.ORACLE_SQL is None and len(CP.STAGES) == 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    got = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    assert sorted(df.columns) == sorted(cols)
    assert got == sorted(map(repr, (tuple(r[i] for i in order) for r in cur.fetchall())))


def test_pipeline_stages(spark, duck):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    items = dict(duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    stage = dict(CP.STAGES)
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    before = text(docs)
    d1 = written(stage["toxicity"](spark, docs, SF0001), "t1")
    flagged = {r.doc_id for r in TX.judged(docs, labels).where("flagged").collect()}
    assert d1.columns == docs.columns and set(text(d1)) == set(before) - flagged
    d2 = written(stage["line_dedup"](spark, d1, SF0001), "t2")
    assert d2.columns == docs.columns and text(d2) == {d: x[2] for d, x in R.line_dedup(text(d1)).items()}
    assert all(r.n_chars == len(r.text) for r in d2.collect())
    d3 = written(stage["near_duplicates"](spark, d2, SF0001), "t3")
    assert d3.columns == docs.columns and set(text(d3)) == {c for _, c in R.near_components(text(d2)).values()}
    d4 = written(stage["decontamination"](spark, d3, SF0001), "t4")
    short = {d: t for d, t in text(d3).items() if len(t) < 6000}
    hit = {d for d, _ in R.overlaps(short, items)}
    assert d4.columns == docs.columns and {d for d in text(d4) if d in short} == set(short) - hit and hit
    d5 = stage["packing"](spark, d4, SF0001)
    assert {r.doc_id for r in d5.collect()} == set(text(d4))


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").where("false")
    for name, f in CP.STAGES:
        assert f(spark, docs, SF0001).count() == 0, name


def test_stages_take_odd_rows_and_other_columns(spark):
    """Null and repeated ids, null and empty texts, columns named like the operators' own."""
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    shared = "a line that the three odd documents all hold\n"
    odd = spark.createDataFrame([(None, None), (None, ""), (-1, None), (-2, ""), (-3, shared + "x one"), (-4, shared + "y two"),
                                 (-5, shared + "z three"), (-5, "another text of the same id")], "doc_id bigint, text string")
    extra = ("n_lines", "n_dropped", "score", "item_id", "threshold", "component", "y", "w")
    d = docs.unionByName(odd, allowMissingColumns=True).withColumns({c: F.lit(f"own {c}") for c in extra})
    for name, f in CP.STAGES[:-1]:
        out = written(f(spark, d, SF0001), f"odd-{name}")
        assert out.columns == d.columns, name
        assert out.where(" or ".join(f"{c} is distinct from 'own {c}'" for c in extra)).isEmpty(), name
        if name == "toxicity":          # the few labels here leave the bias of the score to chance
            continue
        assert out.where("doc_id is null").count() == 2 and out.where("doc_id in (-1, -2)").count() == 2, name
        if name == "line_dedup":
            got = {(r.doc_id, r.text) for r in out.where("doc_id < -2").collect()}
            assert got == {(-5, "z three"), (-4, "y two"), (-3, shared + "x one"), (-5, "another text of the same id")}
        d = out
    pieces = CP.STAGES[-1][1](spark, d, SF0001)
    assert pieces.where("doc_id in (-1, -2) and doc_tokens = 1").count() == 2
