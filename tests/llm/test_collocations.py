"""Operator 12 against plain counting."""
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carlot.llm import collocations as CO
from tests.llm.reference import low

KINDS = "doc_id bigint, text string, lang string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def counted(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    return f, n


def plain(rows, least=10, inside=50, top=2000):
    f, n = counted(rows)
    cand = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            s, _, left, right = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
            cand[lang, p] = (s, a, left, right)
    out = []
    for lang in n:
        rest = [(-s, -a, " ".join(p).encode(), left, right) for (x, p), (s, a, left, right) in cand.items() if x == lang
                and not any(y == lang and len(q) > len(p) and p in (q[:2], q[1:]) and 100 * c[1] >= inside * a for (y, q), c in cand.items())]
        for i, (s, a, p, left, right) in enumerate(sorted(rest)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def made(seed, docs=500):
    r = random.Random(seed)
    word = [f"w{i}" for i in range(14)] + ["Über", "łódź", "don't", "a-b", "x\x1cy", "日本"]
    fixed = ["New York City", "of the", "red, hot", "stop. Go now", "łódź Über alles", "tick\ttock  tick"]
    rows = []
    for i in range(docs):
        parts = [r.choice(fixed) if r.random() < 0.3 else r.choice(word) for _ in range(r.randrange(0, 60))]
        rows.append((i, r.choice([" ", "  ", "\t", "\n", ", "]).join(parts), r.choice(["en", "de", None, "und", "ü"])))
    rows += [(7, None, "en"), (8, "", None), (None, "of the of the of the", "de"), (5, "of the of the", "en"), (5, "of the of the", "en")]
    return rows + [(9000, "long tail " * 20000 + "end", "en"), (9001, " \t\n.,;:!? ", "en"), (9002, "!" * 5000, "fr")]


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("fold,block,part", [((1 << 64) - 1, 16 << 20, 32 << 20), ((1 << 64) - 1, 3000, 5000), (0x3F0, 1 << 20, 32 << 20), (0xF << 60, 500, 1000), (0, 2000, 32 << 20)])
def test_any_collisions_and_blocks(spark, fold, block, part):
    rows = made(3)
    df = spark.createDataFrame(rows, KINDS).withColumns({c: F.lit("x") for c in ("n", "doc", "key", "times", "w", "f")}).repartition(3)
    want = plain(rows, top=40)
    assert len(want) > 50 and got(CO.collocations(df, top=40, fold=fold, block=block, part=part)) == want


def test_many_salts(spark):
    rows = made(4)
    assert got(CO.collocations(spark.createDataFrame(rows, KINDS), least=2, top=3)) == plain(rows, least=2, top=3)


def test_scores_past_64_bits(spark):
    big = 10 ** 13
    counts = spark.createDataFrame([("en", 0, "", 9 * big), ("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 3)],
                                   "lang string, words int, phrase string, f bigint")
    r = CO.scored(counts).first()
    assert (r.l, r.r, r.score) == (big, big + 7, 1000000 * (big - 3) ** 2 // (big * (big + 7)))


def test_empty(spark):
    df = CO.collocations(spark.createDataFrame([], KINDS))
    assert df.count() == 0 and df.columns == COLUMNS
    assert dict(df.dtypes)["rank"] == "bigint"


def test_pointers_of_frequent_fingerprints():
    keys = np.array([1] * 4 + [2] * 12 + [3] * 9 + [4, 5, 5], np.uint64) << np.uint64(40)
    check = np.array([7] * 26 + [8, 9], np.uint32)                     # the last two share a fingerprint only
    r = np.random.default_rng(1).permutation(28)
    cols = [keys, check, np.array([1] * 27 + [10], np.uint8), np.arange(28, dtype=np.uint16) * 4, np.arange(28, dtype=np.uint8)]
    t = pa.table({f"c{i}": [c[r[:10]].tobytes(), c[r[10:]].tobytes()] for i, c in enumerate(cols)} | {"c5": [np.arange(28).tobytes()] * 2})
    out = CO.frequent_pointers(t, 10).to_pylist()
    assert sorted((x["doc"], x["at"], x["times"], x["key"] >> 40, x["check"]) for x in out) == [(4, 16, 12, 2, 7), (15, 60, 0, 2, 7), (27, 108, 10, 5, 9)]


def test_prefix_polynomials_depend_on_words_only():
    h = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    two = CO.fingerprints(h, 2)
    assert two[0] == two[3] and two[1] == two[4] and len(set(two.tolist())) == 4
    assert len(CO.fingerprints(h, 8)) == 0


def test_tasks_hold_shares_not_blocks_or_ranges(monkeypatch):
    """A block is counted, and a range of fingerprints summed, in work arrays of bounded size;
    one block at a time is held."""
    import gc
    import tracemalloc
    texts = [" ".join(f"{i}w{j}" for j in range(60000)) for i in range(8)]
    live = []

    class Seen(CO.Block):
        def __init__(self, *args):
            live.append(sum(isinstance(x, Seen) for x in gc.get_objects()))
            super().__init__(*args)
    monkeypatch.setattr(CO, "Block", Seen)
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["en"] * 8})
    fold, parts = (1 << 64) - 1, 4
    out = pa.Table.from_batches(list(CO.pack(iter([batch]), 1, None, fold, 1 << 18, parts)))
    assert len(live) == 8 and max(live) == 1
    assert sum(len(x) for x in out["c0"].to_pylist()) == 8 * 8 * 60000

    r = np.random.default_rng(2)
    n = 2_000_000
    keys = np.sort(r.integers(0, 1 << 62, n, dtype=np.uint64))
    cols = [keys.tobytes(), np.zeros(n, np.uint32).tobytes(), r.integers(1, 11, n).astype(np.uint8).tobytes(),
            np.zeros(n, np.uint8).tobytes(), np.zeros(n, np.uint8).tobytes(), np.zeros(1, np.int64).tobytes()]
    t = pa.table({f"c{i}": pa.array([c], pa.binary()) for i, c in enumerate(cols)})
    many = int((np.frombuffer(cols[2], np.uint8) == 10).sum())
    tracemalloc.start()
    got = CO.frequent_pointers(t, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.num_rows == many and peak < 40 * n                       # all at once took over 100 bytes an entry
    few = CO.frequent_bits(0, pa.table({"c0": pa.array([((keys & ~np.uint64(15)) | np.uint64(10)).tobytes()], pa.binary())}), 10, 4)
    bits = np.unpackbits(np.frombuffer(few["bits"][0].as_py(), np.uint8))
    assert bits.sum() == len(np.unique(keys >> np.uint64(64 - CO.BITS)))


def test_shuffles_go_with_their_query(spark):
    """The shuffles of counting don't lie on the disks while the next steps write theirs."""
    import time
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {x for i in range(files.size()) if (x := files.apply(i).getName()).startswith("shuffle_")}
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 5000, dtype=np.uint64)) << np.uint64(1)
    packed = spark.createDataFrame([(0, bytearray(((keys & ~np.uint64(15)) | np.uint64(10)).tobytes()))], "part int, c0 binary")
    before, option = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(option, None)
    bits = CO.bitmap_of(packed, 10, 1)
    assert np.unpackbits(bits).sum() == len(np.unique(keys >> np.uint64(64 - CO.BITS)))
    end = time.time() + 20
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(option, None) == was
