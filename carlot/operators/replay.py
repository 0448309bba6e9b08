"""Ordered crawl-log replay (K1/K2/C17/G24) as set operations.

Input: one row per listing reference seen on a result page, with
``run``, ``page``, an in-page order, the advert id and the captured fetch
outcome of its detail page. The source application walked these in order
and kept mutable state (a running count of new records, a set of taken
ids, a stop flag). Here the same decisions come from:

* ``first ok position`` per (run, id): a partial aggregate ("taken");
* the running count of new records before each reference: a distributed
  prefix sum (``prefix_sum``), so a run with a third of all rows is still
  spread over many tasks;
* the first stop position per run: a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.operators.scans import prefix_sum


def fetch_outcome(status: Column, retry_after: Column | None = None, captcha: Column | None = None) -> Column:
    """C17: captured response -> outcome, in the client's order of checks.

    403 AccessBlocked, 429 RateLimited, >=500 FetchFailed, other >=400
    HTTPError, then a captcha page CaptchaDetected, else ok.
    """
    captcha = captcha if captcha is not None else F.lit(False)
    return (F.when(status == 403, "AccessBlocked").when(status == 429, "RateLimited")
            .when(status >= 500, "FetchFailed").when(status >= 400, "HTTPError")
            .when(captcha, "CaptchaDetected").otherwise("ok"))


def retry_after_seconds(status: Column, retry_after: Column) -> Column:
    """Retry-After seconds of a 429 when the header is all digits, else NULL."""
    return F.when((status == 429) & retry_after.rlike(r"^[0-9]+$"), retry_after.try_cast("int"))


BLOCKING = ("AccessBlocked", "RateLimited", "CaptchaDetected")


def replay(refs: DataFrame, known: DataFrame, max_listings: int, max_pages: int | None = None,
           run: str = "run", page: str = "page", pos: str = "pos", key: str = "advert_id",
           outcome: str = "outcome") -> DataFrame:
    """Classify every reference of every run: saved / skipped / parse_error /
    stop / not_reached, plus the run's stop reason.

    ``refs`` must already hold one row per (run, page, id) (first wins in a
    page) and a total order ``(page, pos)`` within a run. ``known`` holds the
    ids already stored (column ``key``).
    """
    r = refs
    if max_pages is not None:
        r = r.where(F.col(page) <= max_pages)                       # K2 page cap
    kn = known.select(key).dropDuplicates().withColumn("__known", F.lit(True))
    r = r.join(kn, key, "left").withColumn("__known", F.coalesce("__known", F.lit(False)))
    ok = F.col(outcome) == "ok"
    first_ok = (r.where(ok & ~F.col("__known")).groupBy(run, key)
                .agg(F.min(F.struct(page, pos)).alias("__first_ok")))
    r = r.join(first_ok, [run, key], "left")
    here = F.struct(page, pos)
    taken = F.col("__first_ok").isNotNull() & (here > F.col("__first_ok"))
    r = r.withColumn("__taken", F.coalesce(taken, F.lit(False)))
    fresh = ~F.col("__known") & ~F.col("__taken")
    r = r.withColumn("__new", (fresh & ok).cast("bigint"))
    r = prefix_sum(r, "__new", "__n_before", group_cols=[run], order_cols=[page, pos], inclusive=False)
    stop_reason = (F.when(F.col("__n_before") >= max_listings, F.lit("max_listings"))
                   .when(fresh & F.col(outcome).isin(*BLOCKING), F.col(outcome)))
    r = r.withColumn("__stop", stop_reason)
    stops = (r.where(F.col("__stop").isNotNull()).groupBy(run)
             .agg(F.min_by("__stop", F.struct(page, pos)).alias("stopped_reason"),
                  F.min(F.struct(page, pos)).alias("__stop_at")))
    r = r.join(stops, run, "left")
    before = F.col("__stop_at").isNull() | (here < F.col("__stop_at"))
    action = (F.when(~before & (here == F.col("__stop_at")), "stop")
              .when(~before, "not_reached")
              .when(F.col("__known") | F.col("__taken"), "skipped")
              .when(ok, "saved")
              .otherwise("parse_error"))
    return r.select(run, page, pos, key, outcome, action.alias("action"), "stopped_reason",
                    F.col("__stop_at")[page].alias("stop_page"))


def run_stats(classified: DataFrame, run: str = "run", page: str = "page") -> DataFrame:
    """Per run: pages visited, listings found, new, skipped, parse
    errors, saved, stop reason. Pages up to the stop page are visited and all
    their references count as found."""
    visited = F.col("stop_page").isNull() | (F.col(page) <= F.col("stop_page"))
    return classified.groupBy(run).agg(
        F.count_distinct(F.when(visited, F.col(page))).alias("pages_visited"),
        F.count_if(visited).alias("listings_found"),
        F.count_if(F.col("action") == "saved").alias("new_listings"),
        F.count_if(F.col("action") == "skipped").alias("skipped_duplicates"),
        F.count_if(F.col("action") == "parse_error").alias("parse_errors"),
        F.count_if(F.col("action") == "saved").alias("saved_records"),
        F.first("stopped_reason", ignorenulls=True).alias("stopped_reason"))
