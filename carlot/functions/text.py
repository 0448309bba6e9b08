"""Text helpers that Spark SQL has no built-in for: Unicode NFKC (C2) and the
URL query edit of result-page links (D39). Both are Arrow-batched pandas
UDFs over the standard library; everything else is a native expression.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carlot.functions.clean import normalize_text
from carlot.session import ship_package


def _nfkc(s: pd.Series) -> pd.Series:
    import unicodedata
    return s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else v)


def nfkc(c) -> Column:
    """Unicode NFKC normalization (full-width forms, ligatures, NBSP...)."""
    ship_package()
    udf = F.pandas_udf(_nfkc, T.StringType())
    return udf(F.col(c) if isinstance(c, str) else c)


def nfkc_normalize_text(c) -> Column:
    """C2 + C1: NFKC, then NBSP -> blank, collapse whitespace, strip."""
    return normalize_text(nfkc(c))


def _set_query_param(urls: pd.Series, values: pd.Series, key: str) -> pd.Series:
    from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

    def one(u, v):
        if u is None or v is None:
            return None
        parts = urlsplit(u)
        params = dict(parse_qsl(parts.query, keep_blank_values=True))
        params[key] = str(v)
        return urlunsplit((parts.scheme, parts.netloc, parts.path, urlencode(params), parts.fragment))
    return pd.Series([one(u, v) for u, v in zip(urls, values)], dtype=object)


def add_page_param(url, page, key: str = "page") -> Column:
    """Set ``key=page`` in the URL query: the last duplicate of a key
    wins, blank values are kept, parameter order is kept, fragment kept."""
    def fn(u: pd.Series, p: pd.Series) -> pd.Series:
        return _set_query_param(u, p, key)
    ship_package()
    udf = F.pandas_udf(fn, T.StringType())
    u = F.col(url) if isinstance(url, str) else url
    p = page if isinstance(page, Column) else F.lit(page)
    return udf(u, p.cast("string"))
