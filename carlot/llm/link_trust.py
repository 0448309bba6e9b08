"""Operator 3: URL rules and trust propagated over the links between hosts.

Rules (action, host, path) decide the urls they fit; the longest wins. All
other urls are judged by their host: trust starts at hosts whose pages the
allow rules take, distrust at hosts whose pages the block rules take, each in
proportion to those pages. Trust runs along links as a personalised PageRank;
distrust runs against them (linking to a blocked host is a bad sign). Both run
until no score grows by more than ``TOLERANCE`` of it (of 1, if it is less)
between two lineage cuts, or exactly ``iterations`` steps if these are given. A host
whose distrust exceeds its trust by ``threshold`` is blocked. Scores are in
units of the restart share, so a host without links scores exactly the share
of its own pages, and 0.5 means "as bad as a host half of which is blocked".

Rules meet distinct hosts through an equi-join on host suffixes; pages meet
hosts through an equi-join whose hot hosts Spark splits. Page text only feeds
the link extraction, a narrow step before a combined count per host pair.

Defined cases: a null url, or one without ``://``, has an empty host and path
and fits no rule (its verdict is allow); null html has no links; self-links
are ignored; repeated pages count each time and all come back; without rules
or links every verdict is allow.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import ascii_lower, literal_rows, written

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DAMPING = 0.85
#: Steps of the SQL twin, and of ``judge_urls`` unless told to converge.
ITERATIONS = 10
#: Growth of a score over ``CUT_EVERY`` steps at which it counts as converged.
TOLERANCE = 1e-6
#: Iterations between two lineage cuts.
CUT_EVERY = 5
THRESHOLD = 0.5
HREF = r"""(?i)href\s*=\s*["']?([^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def host_rules(hosts: DataFrame, rules: DataFrame, labels: int) -> DataFrame:
    """(host, __rules): for each distinct host the rules of its suffixes,
    longest first. No rule's host has more than ``labels`` labels, so only as
    many of a host's last ones are looked up."""
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in range(1, labels + 1)]))
    ex = hosts.where(F.col("host") != "").select("host", F.explode(suffixes).alias("rule_host"))
    hit = ex.join(rules, "rule_host").select("host", F.struct(
        (-F.char_length(F.col("rule"))).alias("order"), "rule", "rule_path", "action").alias("r"))
    return hit.groupBy("host").agg(F.array_sort(F.collect_set("r")).alias("__rules"))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, w): links between different hosts, counted."""
    hrefs = F.filter(F.regexp_extract_all(F.col("html"), F.lit(HREF), F.lit(1)),
                     lambda h: h.contains("://") | h.startswith("//"))
    ex = pages.select(url_host(F.col("url")).alias("src"), F.explode(hrefs).alias("h"))
    dst = url_host(F.when(F.col("h").startswith("//"), F.concat(F.lit("x:"), F.col("h"))).otherwise(F.col("h")))
    return (ex.select("src", dst.alias("dst"))
            .where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w")))


def _settled(rank: DataFrame, last: DataFrame) -> bool:
    """Whether no score has moved by more than ``TOLERANCE`` since ``last``."""
    old = last.withColumnRenamed("score", "old")
    moved = rank.join(old, ["host", "kind"], "left").where(
        F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))) > TOLERANCE * F.greatest(F.col("score"), F.lit(1.0)))
    return moved.isEmpty()


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING,
              iterations: int | None = ITERATIONS) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust) and links
    (src, dst, w). Both scores move in one job per step: a link is a trust
    edge forwards and a distrust edge backwards. With None, steps are made until
    the scores have converged; a step shrinks what is left to move by ``damping``."""
    out_w = links.groupBy(F.col("src").alias("__s")).agg(F.sum("w").alias("__o"))
    in_w = links.groupBy(F.col("dst").alias("__d")).agg(F.sum("w").alias("__i"))
    fwd = links.join(out_w, F.col("src") == F.col("__s")).select(
        F.lit("t").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"),
        (F.lit(damping) * F.col("w") / F.col("__o")).alias("p"))
    rev = links.join(in_w, F.col("dst") == F.col("__d")).select(
        F.lit("d").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"),
        (F.lit(damping) * F.col("w") / F.col("__i")).alias("p"))
    edges = written(fwd.unionByName(rev), "host-edges")
    start = written(seeds.select("host", F.inline(F.array(
        F.struct(F.lit("t").alias("kind"), F.col("trust").alias("score")),
        F.struct(F.lit("d").alias("kind"), F.col("distrust").alias("score"))))).where("score > 0"), "host-seeds")
    rank = last = start
    for step in count(1) if iterations is None else range(1, iterations + 1):
        sent = (edges.join(rank.withColumnRenamed("host", "a"), ["kind", "a"])
                .select(F.col("b").alias("host"), "kind", (F.col("p") * F.col("score")).alias("score")))
        rank = start.unionByName(sent).groupBy("host", "kind").agg(F.sum("score").alias("score"))
        if step % CUT_EVERY == 0 and step != iterations:
            rank = written(rank, "host-rank")
            if iterations is None and _settled(rank, last):
                break
            last = rank
    pick = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0))
    return rank.groupBy("host").agg(pick("t").alias("trust"), pick("d").alias("distrust"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None,
               damping: float = DAMPING, iterations: int | None = ITERATIONS,
               threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), a row per page."""
    spark = pages.sparkSession
    rules = RULES if rules is None else rules
    table = literal_rows(spark, [(a, h, p, h + p) for a, h, p in rules],
                         "action string, rule_host string, rule_path string, rule string")
    labels = max((h.count(".") + 1 for _, h, _ in rules), default=1)
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    # Written, so that the planner knows the size of the host tables: small ones
    # are broadcast, and beyond that a join of plain exchanges splits hot hosts.
    by_host = written(host_rules(urls.select("host").distinct(), table, labels), "host-rules")
    fit = F.get(F.filter(F.col("__rules"), lambda r: F.col("path").startswith(r["rule_path"])), F.lit(0))
    ruled = urls.join(by_host, "host", "left").select("page_id", "host", "path", fit.alias("__r"))
    ruled = written(ruled.select("page_id", "host", "path", F.col("__r.rule").alias("rule"),
                                 F.col("__r.action").alias("__action")), "ruled-urls")
    share = lambda a: F.avg((F.coalesce(F.col("__action"), F.lit("")) == a).cast("double"))
    seeds = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = written(propagate(seeds, host_links(pages), damping, iterations), "host-scores")
    bad = F.col("distrust") - F.col("trust") >= threshold
    own = F.when(F.coalesce(bad, F.lit(False)), "block").otherwise("allow")
    return ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("__action", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def url_report(pages: DataFrame) -> DataFrame:
    """Digest of ``judge_urls`` at convergence, without the scores."""
    return judge_urls(pages.select("page_id", "url", "html"), iterations=None).select("page_id", "host", "path", "rule", "verdict")
