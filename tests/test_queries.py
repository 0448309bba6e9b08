"""Every registered query against its DuckDB oracle on sf0.001, plus the
driver's smoke entry."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from carlot.sources.tables import TABLES
from tests.conftest import SF0001

from carlot.plans.oracles import SQL  # noqa: E402
from carlot.plans.queries import QUERIES  # noqa: E402



def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (2, repr([_norm(x) for x in v]))
    from decimal import Decimal
    if isinstance(v, Decimal):
        return (1, repr(float(v)))
    return (4, str(v))


def _key(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["production_year", "listings", "median_price"]


def test_every_query_has_an_oracle_or_is_known():
    assert set(SQL) <= set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert set(QUERIES) - set(SQL) == {"page_parse", "document_text_normalize"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _key(df.columns, srows) == _key(dcols, drows)
