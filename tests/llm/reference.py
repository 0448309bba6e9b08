"""Plain Python versions of the operators, for small fixtures."""
import hashlib
import re
from itertools import combinations

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"


def low(t):
    return (t or "").translate(UP)


def words(t):
    return WORD.findall(low(t))


def exact(rows):
    """rows: (doc_id, text) -> {index: (keep_id, size, sha)}"""
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(low(t), []).append(d)
    return [(max((x for x in groups[low(t)] if x is not None), default=None), len(groups[low(t)]),
             hashlib.sha256(low(t).encode()).hexdigest()) for _, t in rows]


def line_dedup(docs, min_chars=20, min_docs=3):
    """{doc_id: text} -> {doc_id: (n_lines, n_dropped, text)}"""
    key = lambda line: low(line.strip(BLANKS))
    where = {}
    for d, t in docs.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                where.setdefault(key(line), set()).add(d)
    out = {}
    for d, t in docs.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(where.get(key(x), ())) >= min_docs and max(where[key(x)]) != d)]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def shingle_set(t, k=5):
    w = words(t)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_components(docs, percent=75):
    """{doc_id: text} -> {doc_id: (set size, least linked id)}"""
    sets = {d: shingle_set(t) for d, t in docs.items()}
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(docs), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d)) for d in docs}


def overlaps(docs, items, window=20, share=80, tolerant=10, least=1, run=13):
    """{(doc_id, item_id): (places, first, best)} by trying every alignment."""
    out = {}
    for d, t in docs.items():
        w = words(t)
        for i, s in items.items():
            v = words(s)
            if len(v) < least:
                continue
            n = min(window, len(v))
            need = n if len(v) < tolerant else -(-n * share // 100)
            for at in range(-len(v) + 1, len(w)):
                same = [0 <= at + k < len(w) and w[at + k] == v[k] for k in range(len(v))]
                best = max(sum(same[k:k + n]) for k in range(len(v) - n + 1))
                if best >= need or any(all(same[k:k + run]) for k in range(len(v) - run + 1)):
                    places, first, top = out.get((d, i), (0, at, 0))
                    out[d, i] = (places + 1, min(first, at), max(top, best))
    return out
