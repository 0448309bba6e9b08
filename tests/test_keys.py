"""Upsert, known keys, crawl replay (the reference's storage and pipeline
cases), and brute-force checks of the distributed scans."""
import random
import statistics
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from carlot.operators import keys as K
from carlot.operators import replay as R
from carlot.operators import scans as S
from carlot.operators import quality as Q

T0 = datetime(2026, 1, 1)
T1 = datetime(2026, 1, 2)
COLS = ["source_url", "price"]


def _target(spark):
    return spark.createDataFrame([], "source string, advert_id string, source_url string, price double, "
                                     "first_seen_at timestamp_ntz, last_seen_at timestamp_ntz")


def test_upsert_updates_price_keeps_first_seen(spark):
    b1 = spark.createDataFrame([("site", "1001", "u", 89900.0)], "source string, advert_id string, "
                                                                  "source_url string, price double")
    t1 = K.upsert(_target(spark), b1, ["source", "advert_id"], COLS, F.lit(T0).cast("timestamp_ntz"))
    b2 = b1.withColumn("price", F.lit(91000.0))
    t2 = K.upsert(t1, b2, ["source", "advert_id"], COLS, F.lit(T1).cast("timestamp_ntz")).collect()
    assert len(t2) == 1
    r = t2[0]
    assert r["price"] == 91000.0 and r["first_seen_at"] == T0 and r["last_seen_at"] == T1


def test_partial_record_and_known_keys(spark):
    full = spark.createDataFrame([("site", "1001", "u", 1.0)], "source string, advert_id string, "
                                                              "source_url string, price double")
    t = K.upsert(_target(spark), full, ["source", "advert_id"], COLS, F.lit(T0).cast("timestamp_ntz"))
    partial = spark.createDataFrame([("site", "1001", "u2")], "source string, advert_id string, source_url string")
    t2 = K.upsert(t, partial, ["source", "advert_id"], COLS, F.lit(T1).cast("timestamp_ntz"))
    r = t2.collect()[0]
    assert r["source_url"] == "u2" and r["price"] is None          # absent column -> NULL
    keep = K.upsert(t, partial, ["source", "advert_id"], COLS, F.lit(T1).cast("timestamp_ntz"),
                    coalesce_missing=True).collect()[0]
    assert keep["price"] == 1.0
    assert [x["advert_id"] for x in K.known_keys(t2, "site").collect()] == ["1001"]


def test_upsert_idempotent(spark):
    b = spark.createDataFrame([("s", str(i), "u", float(i)) for i in range(20)],
                              "source string, advert_id string, source_url string, price double")
    ts = F.lit(T0).cast("timestamp_ntz")
    t1 = K.upsert(_target(spark), b, ["source", "advert_id"], COLS, ts)
    t2 = K.upsert(t1, b, ["source", "advert_id"], COLS, ts)
    assert sorted(map(tuple, t1.collect())) == sorted(map(tuple, t2.collect()))


def _refs(spark, rows):
    return spark.createDataFrame(rows, "run long, page int, pos long, advert_id string, outcome string")


def test_replay_runs_like_the_pipeline_tests(spark):
    refs = _refs(spark, [(1, 1, 0, "1001", "ok"), (1, 1, 1, "1002", "ok")])
    none = spark.createDataFrame([], "advert_id string")
    s1 = R.run_stats(R.replay(refs, none, max_listings=1, max_pages=1)).collect()[0]
    assert (s1["saved_records"], s1["stopped_reason"]) == (1, "max_listings")
    known = spark.createDataFrame([("1001",)], "advert_id string")
    s2 = R.run_stats(R.replay(refs, known, max_listings=1, max_pages=1)).collect()[0]
    assert (s2["saved_records"], s2["skipped_duplicates"], s2["stopped_reason"]) == (1, 1, None)


def test_replay_block_and_errors(spark):
    refs = _refs(spark, [(7, 1, 0, "a", "ok"), (7, 1, 1, "b", "FetchFailed"), (7, 1, 2, "a", "ok"),
                         (7, 2, 0, "c", "AccessBlocked"), (7, 2, 1, "d", "ok"), (7, 3, 0, "e", "ok")])
    none = spark.createDataFrame([], "advert_id string")
    c = {r["pos"] + 10 * r["page"]: r["action"] for r in R.replay(refs, none, 30).collect()}
    assert c == {10: "saved", 11: "parse_error", 12: "skipped", 20: "stop", 21: "not_reached", 30: "not_reached"}
    s = R.run_stats(R.replay(refs, none, 30)).collect()[0]
    assert (s["pages_visited"], s["listings_found"], s["stopped_reason"]) == (2, 5, "AccessBlocked")


def test_prefix_sum_and_dense_index_brute_force(spark):
    rnd = random.Random(7)
    data = [(rnd.choice([0, 0, 0, 1, 2]), i, rnd.randint(0, 5)) for i in range(3000)]  # group 0 is hot
    df = spark.createDataFrame(data, "g int, o int, v int")
    got = {(r["g"], r["o"]): r["run"] for r in
           S.prefix_sum(df, "v", "run", group_cols=["g"], order_cols=["o"]).collect()}
    pdf = pd.DataFrame(data, columns=["g", "o", "v"]).sort_values(["g", "o"])
    pdf["run"] = pdf.groupby("g")["v"].cumsum()
    assert got == {(g, o): r for g, o, r in zip(pdf.g, pdf.o, pdf.run)}
    ids = sorted(r["id"] for r in S.dense_index(df, ["o"]).collect())
    assert ids == list(range(1, 3001))


def test_grouped_median_brute_force(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["hot", "hot", "hot", "a", "b"]), float(rnd.randint(0, 1000))) for _ in range(2001)]
    data.append(("nulls", None))
    df = spark.createDataFrame(data, "k string, x double")
    got = {r["k"]: r["median_x"] for r in S.grouped_median(df, ["k"], ["x"]).collect()}
    for k in ("hot", "a", "b"):
        assert got[k] == statistics.median([x for kk, x in data if kk == k]), k
    assert "nulls" not in got
    q = S.grouped_percentiles(df.where("k = 'a'"), ["k"], ["x"], (0.25, 0.75)).collect()[0]
    import numpy as np
    xs = [x for kk, x in data if kk == "a"]
    assert abs(q["p25_x"] - np.percentile(xs, 25)) < 1e-9 and abs(q["p75_x"] - np.percentile(xs, 75)) < 1e-9


def test_dedup_idempotent_and_null_safe(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("", None), (None, None), ("b", 1)], "x string, y int")
    d1 = Q.dedup_full_row(df)
    assert d1.count() == 3                       # ('a',NULL), (NULL,NULL) [''==NULL], ('b',1)
    assert Q.dedup_full_row(d1).count() == 3
    dup = Q.duplicate_groups(df, ["x", "y"]).count()
    assert dup == 2


def test_aggregate_with_medians_hot_group(spark):
    rnd = random.Random(11)
    data = [(rnd.choice(["hot"] * 6 + ["a", "b", None]), float(rnd.randint(0, 500))) for _ in range(1500)]
    df = spark.createDataFrame(data, "k string, x double")
    aggs = [F.count(F.lit(1)).alias("n"), F.max("x").alias("mx")]
    want = {}
    for k in {kk for kk, _ in data}:
        xs = [x for kk, x in data if kk == k]
        want[k] = (len(xs), max(xs), statistics.median(xs))
    got = {r["k"]: (r["n"], r["mx"], r["median_x"]) for r in
           S.aggregate_with_medians(df, ["k"], aggs, ["x"]).collect()}
    assert got == want


def test_dense_index_needs_no_python_rows(spark, monkeypatch):
    """places come from Spark's row numbers of sorted partitions, in groups with NULLs and repeats too."""
    from carlot.operators import scans
    monkeypatch.setattr(scans, "prefix_sum", None)
    data = [(g, v) for g in ("a", None, "b") for v in range(40)] * 2
    df = spark.createDataFrame(data, "g string, v int").repartition(5)
    got = scans.dense_index(df, ["v"], out="n", start=3, group_cols=["g"]).collect()
    for g in ("a", None, "b"):
        rows = sorted((r["n"], r["v"]) for r in got if r["g"] == g)
        assert [n for n, _ in rows] == list(range(3, 83)) and [v for _, v in rows] == sorted([*range(40)] * 2)
    assert sorted(r["n"] for r in scans.dense_index(df, ["v", "g"], out="v2").withColumnRenamed("v2", "n").collect()) == list(range(1, 241))


def test_a_batch_is_collapsed_once(spark, tmp_path, monkeypatch):
    """an upsert of a collapsed batch doesn't group it by key again."""
    from carlot.operators import keys as K
    from carlot.sources import keyed as KT
    path = str(tmp_path / "keyed")
    old = spark.createDataFrame([("a", 1, 1.0, "x", "x"), ("a", 2, 2.0, "x", "x")], "s string, k int, v double, first_seen_at string, last_seen_at string")
    KT.write_keyed(old, path, ["s", "k"], 4, ["s"])
    calls = []
    monkeypatch.setattr(K, "last_per_key", lambda df, *a: calls.append(a) or df)
    batch = spark.createDataFrame([("a", 2, 5.0, 1), ("a", 2, 6.0, 2), ("a", 3, None, 1)], "s string, k int, v double, t int")
    KT.upsert_keyed(spark, path, batch, ["s", "k"], ["v"], F.lit("y"), 4, ["s"], ["t"])
    assert not calls
    assert sorted((r["k"], r["v"], r["first_seen_at"], r["last_seen_at"]) for r in KT.read_keyed(spark, path).collect()) == [
        (1, 1.0, "x", "x"), (2, 6.0, "x", "y"), (3, None, "y", "y")]
