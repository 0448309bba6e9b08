"""Make/model catalogue: label cleaning, make tagging, model tagging, slugs.

Tagging is a whole-word, case-insensitive search of every catalogue name in
every title. Instead of a nested-loop (title x name) join, titles and names
are both cut into word tokens; each name is found through one rare token, and
the candidates are confirmed with the exact ``\\b<name>\\b`` regex. Catalogues of
up to ``LOOKUP`` names are looked up in the title's row, so that titles aren't
moved or stored; larger ones meet the tokens in an equi-join.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carlot.operators.scans import dense_index
from carlot.session import stored

# ---------------------------------------------------------------------------
# FIXED VALUES: URL slugs that do not follow the generic rule
# ---------------------------------------------------------------------------
SLUG_OVERRIDES = {
    "BMW-ALPINA": "alpina",
    "Citroën": "citroen",
    "Doosan": "doosan",
    "e.GO": "e-go",
    "Lynk & Co": "lynk-and-co",
    "Warszawa": "marka_warszawa",
    "Wołga": "wolga",
    "Zaporożec": "zaporozec",
    "Zastava": "zastava",
}

#: Names of a catalogue that go to every task as a constant hash table (about 2 MB).
LOOKUP = 20_000

_TOKEN_SPLIT = r"(?U)[\W_]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _tokens(c) -> Column:
    return F.filter(F.split(F.lower(_c(c)), _TOKEN_SPLIT), lambda x: x != "")


def word_pattern(term, case_insensitive: bool = True) -> Column:
    """``(?iU)\\b\\Q<term>\\E\\b``: whole-word literal match."""
    flags = "(?iU)" if case_insensitive else "(?U)"
    return F.concat(F.lit(flags + r"\b\Q"), _c(term), F.lit(r"\E\b"))


def clean_catalogue_labels(labels: DataFrame, col: str = "label",
                           drop=("wszystkie marki", "wszystkie modele", "all makes", "all models")) -> DataFrame:
    """C14: ``'Toyota (123)'`` -> ``'Toyota'``; 'all makes/models' entries dropped."""
    name = F.trim(F.split_part(F.col(col), F.lit(" ("), F.lit(1)))
    return labels.withColumn("name", name).where(~F.lower("name").isin(*drop) & (F.col("name") != ""))


def with_order(catalogue: DataFrame, order_cols) -> DataFrame:
    """Catalogue position ``ord`` by explicit order columns (a total order)."""
    return dense_index(catalogue, list(order_cols), out="ord", start=1)


def _ordered(catalogue: DataFrame) -> DataFrame:
    if "ord" not in catalogue.columns:
        raise ValueError("the catalogue needs its order: a column 'ord' (read_catalogue, with_order)")
    return catalogue


def _anchored(names: DataFrame, name: str, scope: list[str]) -> DataFrame:
    """``names`` with ``__key``: of the word tokens of each name, the one that
    the fewest names of its scope share (ties: the longest). A title can hold
    the name only if it holds this token."""
    ex = names.select(*scope, name, F.explode(F.array_distinct(_tokens(name))).alias("__key"))
    shared = ex.groupBy(*scope, "__key").agg(F.count_distinct(name).alias("__n"))
    best = (ex.join(shared, [*scope, "__key"]).groupBy(*scope, name)
            .agg(F.min_by("__key", F.struct("__n", -F.length("__key"), "__key")).alias("__key")))
    return names.join(best, [*scope, name])


def _numbered(titles: DataFrame) -> DataFrame:
    """The titles written once, each row with a number of its own: tokens and
    tags meet by it, whatever ids the rows have or lack."""
    return stored(titles.withColumn("__row", F.monotonically_increasing_id()), "titles")


def _with_candidates(titles: DataFrame, names: DataFrame, scope: list[str], item: Column, title: str, most: int) -> DataFrame:
    """``titles`` with ``__c``: the ``item`` of each name of the row's scope whose
    anchor token is in the title (none or NULL without any).

    Up to ``most`` names are a constant, a list of as many slots as there are names, and
    a title's tokens find their slot by hash. More names meet the distinct tokens in
    an equi-join that carries ids only, whose few candidates join the titles once.
    """
    names = stored(names.select(*scope, "__key", item.alias("__item")), "names")
    n = names.count()
    if n > most:
        titles = _numbered(titles)
        tokens = titles.select("__row", *scope, F.explode(F.array_distinct(_tokens(title))).alias("__key"))
        cand = tokens.join(names, [*scope, "__key"]).groupBy("__row").agg(F.collect_set("__item").alias("__c"))
        return titles.join(cand, "__row", "left").drop("__row")
    slots = max(1, n)
    slot = lambda *key: F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")
    rows = names.withColumn("__slot", slot(*scope, "__key"))
    kind = rows.drop("__slot").schema
    held: list[list] = [[] for _ in range(slots)]
    for r in rows.collect():                              # at most ``most`` rows
        held[r["__slot"]].append(r.asDict(recursive=True))
    # a constant: one for all rows of a task
    table = F.from_json(F.lit(json.dumps(held)), T.ArrayType(T.ArrayType(kind)))
    own = [F.col(c).cast(kind[c].dataType) for c in scope]

    def found(token):
        same = lambda x: reduce(Column.__and__, [x[c] == v for c, v in zip(scope, own, strict=True)], x["__key"] == token)
        return F.transform(F.filter(F.get(table, slot(*own, token)), same), lambda x: x["__item"])

    return titles.withColumn("__c", F.flatten(F.transform(F.array_distinct(_tokens(title)), found)))


def tag_make(titles: DataFrame, catalogue: DataFrame, title: str = "title", out: str = "make", lookup: int = LOOKUP) -> DataFrame:
    """the catalogue make found as a whole word in the title; when several
    match, the one latest in catalogue order wins (as the source loop did).

    ``catalogue``: (brand, ord). Titles without a match get NULL. Distinct
    title tokens find the makes by their anchor tokens, in the row or (more than
    ``lookup`` makes) by an equi-join; the few candidates are confirmed there.
    """
    brands = _ordered(catalogue).groupBy("brand").agg(F.max("ord").alias("ord"))
    brands = _anchored(brands, "brand", [])
    j = _with_candidates(titles, brands, [], F.struct("ord", "brand"), title, lookup)
    hit = F.filter(F.sort_array("__c", asc=False), lambda c: F.regexp_like(F.col(title), word_pattern(c["brand"])))
    return j.withColumn(out, F.get(hit, F.lit(0))["brand"]).drop("__c")


def tag_model(titles: DataFrame, catalogue: DataFrame, title: str = "title", make: str = "make",
              out: str = "model", policy: str = "parity", lookup: int = LOOKUP) -> DataFrame:
    """model within the tagged make.

    Models of the make are tried longest first (ties in catalogue order);
    a match sets the model and cuts the match from a working copy of the
    title, so later (shorter) models see the rest. ``policy='parity'`` keeps
    the last match (the source behaviour); ``policy='longest'`` keeps the
    first. Only models whose anchor token is in the title are tried: found by
    (make, token) in the row or (more than ``lookup`` models) by an equi-join.
    """
    models = _ordered(catalogue).groupBy(F.col("brand").alias(make), "model").agg(F.max("ord").alias("ord"))
    models = _anchored(models, "model", [make])
    item = F.struct((-F.length("model")).alias("neg_len"), "ord", "model")
    j = _with_candidates(titles, models, [make], item, title, lookup)
    init = F.struct(F.col(title).alias("t"), F.lit(None).cast("string").alias("m"))

    def step(acc, m):
        name = m["model"]
        found = F.regexp_like(acc["t"], word_pattern(name))
        cut = F.trim(F.regexp_replace(acc["t"], word_pattern(name, case_insensitive=False), F.lit("")))
        if policy == "longest":
            return F.when(found & acc["m"].isNull(), F.struct(cut.alias("t"), name.alias("m"))).otherwise(acc)
        return F.when(found, F.struct(cut.alias("t"), name.alias("m"))).otherwise(acc)

    folded = F.aggregate(F.coalesce(F.array_sort("__c"), F.array().cast(
        "array<struct<neg_len:int,ord:bigint,model:string>>")), init, step)
    return j.withColumn(out, folded["m"]).drop("__c")


def slugify(c) -> Column:
    """Trim, lower, blanks -> '-'."""
    return F.replace(F.lower(F.trim(_c(c))), F.lit(" "), F.lit("-"))


def make_slug(brand, overrides: dict | None = None) -> Column:
    """Override table, else slug + percent-encoding (``/`` kept)."""
    ov = overrides if overrides is not None else SLUG_OVERRIDES
    m = F.create_map(*[x for k, v in ov.items() for x in (F.lit(k), F.lit(v))])
    enc = F.url_encode(slugify(brand))
    enc = F.replace(F.replace(F.replace(enc, F.lit("%2F"), F.lit("/")), F.lit("*"), F.lit("%2A")),
                    F.lit("%7E"), F.lit("~"))
    return F.coalesce(F.try_element_at(m, _c(brand)), enc)


def search_url(make, model, year_from: int, year_to: int,
               base_url: str = "https://listings.example") -> Column:
    """Search URL of a (make, model) with the year filter."""
    q = ("search%5Bfilter_float_year%3Afrom%5D={f}&search%5Bfilter_float_year%3Ato%5D={t}"
         "&search%5Badvanced_search_expanded%5D=true").format(f=year_from, t=year_to)
    return F.concat(F.lit(base_url + "/osobowe/"), slugify(make), F.lit("/"), slugify(model), F.lit("?" + q))
