"""Operators 11 and 13 against brute force over made-up vectors."""
import numpy as np
from pyspark.sql import functions as F

from carlot.llm import bond_negatives as BN
from carlot.llm import pivot_join as PJ

KINDS = "vec_id bigint, embedding array<double>, label int"


def linked(rows, similarity=0.95):
    """[(id, vector)] -> {place: (links, least id reachable)} by all pairs."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(good):
        for j in good[k + 1:]:
            if len(rows[i][1]) == len(rows[j][1]) and PJ.exact_cosine(np.array(rows[i][1]), np.array(rows[j][1])) >= similarity:
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(rows[i][0]), links[i], str(least.get(find(i)))) for i in range(len(rows)))


def clustered(n, dim, seed, spread=0.2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(1, n // 12), dim))
    v = centres[r.integers(0, len(centres), n)] + spread * r.normal(size=(n, dim))
    v[::5] = r.normal(size=v[::5].shape)
    return v


def result(df):
    return sorted((str(r.id), r.n_links, str(r.component)) for r in df.collect())


def test_links_match_all_pairs_for_any_cells_and_blocks(spark):
    v = clustered(260, 12, 1).tolist()
    rows = [(i * 3 - 40, x) for i, x in enumerate(v)]
    rows += [(1000 + i, v[7]) for i in range(9)] + [(2000, [2 * x for x in v[7]]), (3, v[9]), (3, v[9]), (None, v[7]), (None, v[12])]
    rows += [(4001, None), (4002, []), (4003, [0.0] * 12), (4004, [None] * 12), (4005, [float("nan")] * 12), (4006, [float("inf")] * 12)]
    rows += [(4007, [1.0, 2.0]), (4008, [1.0, 2.0001]), (4009, [1e200] * 12), (4010, [1e-200] * 12)]
    df = spark.createDataFrame([(d, x, 1) for d, x in rows], KINDS).withColumns(
        {c: F.lit(0) for c in ("gid", "n", "component", "cell", "gv")}).repartition(5)
    want = linked(rows)
    for cell, block in ((4096, 4096), (20, 8), (500, 30)):
        assert result(PJ.near_links(df, cell=cell, block=block)) == want, (cell, block)
    kept = PJ.near_dedup(df, cell=20, block=8)
    assert set(kept.columns) == set(df.columns)
    assert {r.vec_id for r in kept.collect()} == {int(c) for d, _, c in want if d == c and c != "None"}


def test_one_cell_holds_most_vectors(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=16)
    rows = [(i, (base + 0.08 * r.normal(size=16)).tolist()) for i in range(150)] + [(500 + i, r.normal(size=16).tolist()) for i in range(60)]
    df = spark.createDataFrame([(d, x, None) for d, x in rows], KINDS)
    assert result(PJ.near_links(df, cell=10, block=16)) == linked(rows)


def test_bound_is_met_exactly():
    a, b = np.array([3.0, 4.0]), np.array([4.0, 3.0])                 # cosine 24 / 25
    assert PJ.exact_cosine(a, b) == 0.96
    import pyarrow as pa
    t = pa.table({"gid": [1, 2], "n": [1, 1], "v": [a.tolist(), b.tolist()], "left": [True, True], "same": [True, True]})
    assert PJ.join_tile(t, 0.96)["links"].drop_null().to_pylist() == [1, 1]
    assert PJ.join_tile(t, float(np.nextafter(0.96, 1)))["links"].drop_null().to_pylist() == []


def test_no_vectors(spark):
    empty = spark.createDataFrame([], KINDS)
    assert PJ.near_links(empty).count() == 0 and PJ.near_report(empty).columns == ["vec_id", "n_links", "component_id", "kept"]
    none = spark.createDataFrame([(1, None, 1), (2, [], 2)], KINDS)
    assert result(PJ.near_links(none)) == [("1", 0, "1"), ("2", 0, "2")]
    assert BN.negatives_report(empty).count() == 0 and BN.negatives_report(none).count() == 0


def negatives(rows, every, positives, k, least, most):
    rows = {d: (y, tuple(int(np.floor(256 * x)) for x in v)) for d, y, v in rows}
    out = []
    for a, (ya, va) in rows.items():
        if a % every:
            continue
        dot = {d: sum(p * q for p, q in zip(va, v, strict=True)) for d, (_, v) in rows.items() if d != a and len(v) == len(va)}
        near = sorted((-dot[d], d) for d in dot if rows[d][0] == ya)[:positives]
        for s, p in near:
            far = sorted((-dot[d], d) for d in dot if rows[d][0] != ya and least * -s <= 100 * dot[d] <= most * -s)[:k]
            out += [(a, p, i + 1, d, -s, -x) for i, (x, d) in enumerate(far)]
    return sorted(out)


def test_negatives_match_brute_force(spark):
    v = clustered(400, 20, 5, 0.5)
    v[50:60] = v[50]                                                  # ties
    r = np.random.default_rng(6)
    rows = [(i - 30, int(r.integers(0, 4)), x.tolist()) for i, x in enumerate(v)] + [(900 + i, 1, [1.0, -2.0 + i]) for i in range(5)]
    df = spark.createDataFrame([(d, x, y) for d, y, x in rows], KINDS)
    bad = [(5001, None, 1), (None, [1.0] * 20, 1), (5003, [1.0] * 20, None), (5004, [None] * 20, 1), (5005, [float("nan")] * 20, 1),
           (5006, [float("-inf")] * 20, 1), (5007, [], 1), (5008, [1e300] * 20, 1)]
    df = df.unionByName(df.limit(40)).unionByName(spark.createDataFrame(bad, KINDS)).withColumns(
        {c: F.lit(0) for c in ("dim", "v", "id", "rank", "rb", "ab")}).repartition(4)
    want = negatives(rows, 10, 4, 6, 30, 90)
    assert want
    for n, m in ((8192, 4096), (50, 7)):
        got = BN.hard_negatives(BN.usable(df), 10, 4, 6, rows_per=n, anchors_per=m)
        assert sorted(map(tuple, got.collect())) == want, (n, m)


def test_scores_past_double_precision_are_exact(spark):
    r = np.random.default_rng(8)
    rows = [(i, i % 3, (r.integers(-2 ** 20, 2 ** 20, 6) + r.integers(0, 256, 6) / 256).tolist()) for i in range(60)]
    df = spark.createDataFrame([(d, x, y) for d, y, x in rows], KINDS)
    got = BN.hard_negatives(BN.usable(df), 5, 3, 4, rows_per=16, anchors_per=4)
    want = negatives(rows, 5, 3, 4, 30, 90)
    assert want and max(x[4] for x in want) > 2 ** 53 and sorted(map(tuple, got.collect())) == want


def test_scan_gives_candidates_up_early():
    r = np.random.default_rng(9)
    v = np.floor(256 * r.normal(size=(2000, 32)) * np.geomspace(8, 0.01, 32))
    block, seen = BN.Columns(v), []

    def keep(low, high):
        seen.append(len(low))
        return high >= BN.kth(low, 5)

    rows, scores = block.scan(v[0], np.ones(2000, bool), keep, step=4)
    full = v @ v[0]
    assert seen[0] == 2000 and seen[-1] < 200
    top = BN.best(rows, scores, np.arange(2000), 5)
    assert list(rows[top]) == list(np.lexsort((np.arange(2000), -full))[:5])
