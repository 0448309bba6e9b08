"""Operator 3 on small link graphs."""
import numpy as np
from pyspark.sql import functions as F

from carlot.llm import link_trust as LT

A = '<a href="{}">x</a>'


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")


def verdicts(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in df.collect()}


def test_rules_hosts_and_paths(spark):
    urls = ["http://a.net/x", "http://NET/", "http://a.net", "http://example.net/en/1?q#f", "http://b.example.net/de/1",
            "https://x.example.com/de/", "http://x.org/fr/a#b", "http://x.org/FR/a", None, "no scheme", "", "http://", "http://xnet/"]
    got = verdicts(LT.judge_urls(pages(spark, [(u, None) for u in urls]).withColumns({c: F.lit(0) for c in ("host", "rule", "src")})))
    assert got[0] == ("a.net", "/x", "net/", "block") and got[1] == ("net", "/", "net/", "block")
    assert got[2][:3] == ("a.net", "", None)
    assert got[3] == ("example.net", "/en/1", "example.net/en/", "allow")
    assert got[4] == ("b.example.net", "/de/1", "net/", "block")
    assert got[5][2:] == ("example.com/de/", "block") and got[6] == ("x.org", "/fr/a", "org/fr/", "allow")
    assert got[7][2] is None
    for i in (8, 9, 10, 11):
        assert got[i][0] == "" and got[i][2:] == (None, "allow")
    assert got[12][2] is None


def test_propagation_matches_a_dense_computation(spark):
    r = np.random.default_rng(4)
    hosts = [f"h{i}.{t}" for i, t in enumerate(["net", "com", "com", "org", "info", "info", "info", "info"])]
    rows = []
    for i, h in enumerate(hosts):
        for p in range(3):
            links = [f"http://{hosts[j]}/z" for j in r.choice(len(hosts), 3)] + ["/own", f"//{hosts[(i + 1) % 8]}/y"]
            rows.append((f"http://{h}/{'fr' if p else 'q'}/{p}", " ".join(A.format(x) for x in links)))
    rows += rows[:2]                                                     # repeated pages count again
    got = LT.judge_urls(pages(spark, rows)).collect()
    w = np.zeros((8, 8))
    allow, block, n = np.zeros(8), np.zeros(8), np.zeros(8)
    import re
    for u, h in rows:
        i = hosts.index(re.match(r"http://([^/]*)", u).group(1))
        n[i] += 1
        block[i] += hosts[i].endswith("net")
        allow[i] += hosts[i].endswith("org") and "/fr/" in u
        for x in re.findall(r'href="(?:http:)?//([^/"]*)', h):
            if hosts.index(x) != i:
                w[i, hosts.index(x)] += 1
    trust, bad = allow / n, block / n
    t, b = trust.copy(), bad.copy()
    out, into = w / np.maximum(w.sum(1, keepdims=True), 1), w / np.maximum(w.sum(0, keepdims=True), 1)
    for _ in range(LT.ITERATIONS):
        t, b = trust + LT.DAMPING * out.T @ t, bad + LT.DAMPING * into @ b
    for x in got:
        i = hosts.index(x.host)
        assert abs(x.trust - t[i]) < 1e-9 and abs(x.distrust - b[i]) < 1e-9
        if x.rule is None:
            assert x.verdict == ("block" if b[i] - t[i] >= LT.THRESHOLD else "allow")


def test_converged_scores_match_the_closed_form(spark, monkeypatch):
    # a host with 15 % blocked pages that exchanges links with one other host: 0.15 / (1 - 0.85^2) = 0.5405
    hosts = ["a.info", "b.info", "c.net", "d.info"]
    links = {"a.info": ["b.info"], "b.info": ["a.info"], "c.net": ["d.info"], "d.info": ["c.net", "a.info"]}
    rows = [(f"http://{h}/{p}", A.format(f"http://{x}/") if p < 3 else "") for h in hosts[:1] + hosts[2:] for x in links[h] for p in range(17)]
    rows += [(f"http://a.info/bad/{p}", "") for p in range(3)] + [("http://b.info/", A.format("http://a.info/"))]
    rules = [("block", "a.info", "/bad/"), ("block", "net", "/")]
    p = pages(spark, rows)
    got = LT.judge_urls(p, rules, iterations=None).collect()
    share = np.array([3 / 20, 0, 1, 0])
    w = np.zeros((4, 4))
    for h, xs in links.items():
        for x in xs:
            w[hosts.index(h), hosts.index(x)] = 3 if h != "b.info" else 1
    into = w / np.maximum(w.sum(0, keepdims=True), 1)
    want = np.linalg.solve(np.eye(4) - LT.DAMPING * into, share)
    for x in got:
        i = hosts.index(x.host)
        assert abs(x.distrust - want[i]) < 1e-5 and x.trust == 0
    pair = pages(spark, [r for r in rows if "a.info/" in r[0] or "b.info" in r[0]])
    monkeypatch.setattr(LT, "RULES", rules)
    assert {r.verdict for r in LT.url_report(pair).where("host = 'a.info'").collect()} == {"block"}


def test_empty_tables(spark):
    none = pages(spark, [("http://a.net/", "")]).where("false")
    assert LT.judge_urls(none).count() == 0
    some = pages(spark, [("http://a.net/", ""), (None, None)])
    assert {r.verdict for r in LT.judge_urls(some, rules=[]).collect()} == {"allow"}
