"""DuckDB twins of the corpus queries, on the views of the data folder."""

from __future__ import annotations

from carlot.llm import (bond_negatives, collocations, line_dedup, link_trust, pivot_join, prefix_join, rendezvous,
                        spaced_seeds)
from carlot.llm.common import LOWER, UPPER

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _low(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


OP1 = f"""
WITH d AS (SELECT doc_id, {_low("coalesce(text, '')")} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

OP10 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT doc_id, pos, line, {_low(f'trim(line, {BLANKS})')} AS key FROM l),
r AS (SELECT key, max(doc_id) AS stay FROM k WHERE length(key) >= {line_dedup.MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
m AS (SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND r.stay <> k.doc_id AS gone
      FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_HOST = _low("regexp_extract(coalesce({u}, ''), '^(?s).*?://([^/?#]*)', 1)")


def _op3() -> str:
    rules = ", ".join(f"('{a}', '{h}', '{p}', '{h + p}')" for a, h, p in link_trust.RULES)
    host, dst = _HOST.format(u="url"), _HOST.format(u="CASE WHEN h LIKE '//%' THEN 'x:' || h ELSE h END")
    href = link_trust.HREF.replace("'", "''")
    d = link_trust.DAMPING
    steps, last = [], "s"
    for i in range(1, link_trust.ITERATIONS + 1):
        steps.append(f"""r{i} AS (SELECT host, kind, sum(score) AS score FROM (
  SELECT host, kind, score FROM s UNION ALL
  SELECT e.b, e.kind, e.p * r.score FROM e JOIN {last} r ON e.a = r.host AND e.kind = r.kind) GROUP BY host, kind)""")
        last = f"r{i}"
    return f"""
WITH rules(action, rh, rp, rule) AS (VALUES {rules}),
u AS (SELECT row_number() OVER () AS n, page_id, html, {host} AS host,
             regexp_extract(coalesce(url, ''), '^(?s).*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
f AS (SELECT u.n, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
      FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY u.n),
p AS (SELECT u.page_id, u.host, u.path, f.rule, f.action FROM u LEFT JOIN f ON u.n = f.n),
links AS (SELECT src, dst, count(*) AS w FROM (
  SELECT src, {dst} AS dst FROM (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS h FROM u)
  WHERE contains(h, '://') OR starts_with(h, '//')) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
e AS (SELECT 't' AS kind, src AS a, dst AS b, {d} * w / sum(w) OVER (PARTITION BY src) AS p FROM links
  UNION ALL SELECT 'd', dst, src, {d} * w / sum(w) OVER (PARTITION BY dst) FROM links),
h AS (SELECT host, avg((coalesce(action, '') = 'allow')::INT::DOUBLE) AS t,
             avg((coalesce(action, '') = 'block')::INT::DOUBLE) AS b FROM p WHERE host <> '' GROUP BY host),
s AS (SELECT host, 't' AS kind, t AS score FROM h WHERE t > 0 UNION ALL SELECT host, 'd', b FROM h WHERE b > 0),
{", ".join(steps)},
v AS (SELECT host, coalesce(sum(score) FILTER (kind = 't'), 0) AS t, coalesce(sum(score) FILTER (kind = 'd'), 0) AS b
      FROM {last} GROUP BY host)
SELECT p.page_id, p.host, p.path, p.rule,
       coalesce(p.action, CASE WHEN v.b - v.t >= {link_trust.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN v ON p.host = v.host
"""


#: crc32 of a text's UTF-8 bytes, its table made by the usual rule.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(
  regexp_extract_all(hex(encode({t})), '..'), lambda b: ('0x' || b)::BIGINT)),
  lambda c, b: xor(c >> 8, tab[(xor(c & 255, b) + 1)::INT]))"""


def _op9() -> str:
    def draw(n: int) -> str:
        return f"""(SELECT arg_min(s, -ln((('0x' || substr(md5('shard:' || s || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
          + 0.5::DOUBLE) / {1 << 52}::DOUBLE)) FROM range({n}) r(s))::INT"""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    return f"""
WITH tab AS (SELECT list(v ORDER BY i) AS tab FROM (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: {step}) AS v FROM range(256) r(i))),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
             xor({_CRC.format(t="coalesce(text, '')")}, 4294967295) AS text_crc32 FROM documents, tab),
p AS (SELECT doc_id, size, text_crc32, {draw(rendezvous.SHARDS)} AS shard, {draw(rendezvous.SHARDS + 1)} AS grown_shard FROM d)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY
         md5(concat_ws('|', coalesce(doc_id::VARCHAR, 'null'), size::VARCHAR, text_crc32::VARCHAR)), doc_id, size, text_crc32) - 1 AS slot,
       grown_shard
FROM p
"""


def _words(table: str, key: str) -> str:
    return f"""SELECT {key}, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS pos, len(w) AS n
      FROM (SELECT {key}, regexp_extract_all({_low("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table} WHERE text IS NOT NULL)"""


def _op8() -> str:
    s = spaced_seeds
    need = f"CASE WHEN n < {s.LEAST_TOLERANT} THEN n ELSE ceil(least(n, {s.WINDOW}) * {s.SHARE} / 100.0) END"
    return f"""
WITH d AS ({_words("documents", "doc_id")}), b AS ({_words("benchmark", "item_id")}),
m AS (SELECT doc_id, item_id, d.pos - b.pos AS start, b.pos AS q, b.n FROM d JOIN b ON d.w = b.w WHERE b.n >= {s.LEAST_WORDS}),
c AS (SELECT doc_id, item_id, start, n, list(q) AS qs FROM m GROUP BY ALL HAVING count(*) >= least({need}, {s.RUN})),
v AS (SELECT doc_id, item_id, start, n, qs, unnest(qs) AS q FROM c),
f AS (SELECT doc_id, item_id, start, n,
             len(list_filter(qs, lambda x: x >= least(q, n - least(n, {s.WINDOW})) AND x < least(q, n - least(n, {s.WINDOW})) + {s.WINDOW})) AS same,
             len(list_filter(qs, lambda x: x >= q AND x < q + {s.RUN})) AS run
      FROM v),
g AS (SELECT doc_id, item_id, start, max(same) AS best FROM f GROUP BY doc_id, item_id, start, n HAVING max(same) >= {need} OR max(run) >= {s.RUN})
SELECT doc_id, item_id, count(*) AS n_places, min(start) AS first_word, max(best) AS best FROM g GROUP BY doc_id, item_id
"""


OP7 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {prefix_join.SHINGLE} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {prefix_join.SHINGLE - 2}), lambda i: array_to_string(w[i:i + {prefix_join.SHINGLE - 1}], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * m >= {prefix_join.PERCENT} * (p.n + q.n - m)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN c ON d.doc_id = c.x
"""


OP11 = f"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS x, vec_id, embedding FROM embeddings),
v AS MATERIALIZED (SELECT x, vec_id, embedding::DOUBLE[] AS v FROM e
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS MATERIALIZED (SELECT a.x, b.x AS y FROM v a JOIN v b ON len(a.v) = len(b.v) AND a.x <> b.x
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= {pivot_join.SIMILARITY}),
r AS (SELECT x, x AS y FROM e UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT r.x, min(e.vec_id) AS component_id FROM r JOIN e ON r.y = e.x GROUP BY r.x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, coalesce(e.vec_id = c.component_id, false) AS kept
FROM e JOIN c ON e.x = c.x LEFT JOIN n ON e.x = n.x
"""


def _op12() -> str:
    c = collocations
    grams = " UNION ALL ".join(f"""SELECT lang, {n} AS words, unnest(list_transform(range(1, len(w) - {n - 2}),
      lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS phrase FROM p""" for n in range(1, c.WORDS + 1))
    cuts = " UNION ALL ".join(f"""SELECT lang, words, phrase, a, {k} AS k, array_to_string(w[1:{k}], ' ') AS head,
      array_to_string(w[{k + 1}:], ' ') AS tail FROM b WHERE words > {k}""" for k in range(1, c.WORDS))
    return f"""
WITH s AS (SELECT coalesce(lang, '{c.UNKNOWN}') AS lang,
                  unnest(regexp_split_to_array({_low("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM s),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
f AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {c.LEAST}),
b AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
q AS (SELECT x.lang, x.words, x.phrase, x.a, x.k, h.f AS l, g.f AS r, 1000000::HUGEINT * x.a * x.a // (h.f::HUGEINT * g.f) AS score
      FROM ({cuts}) x JOIN f h ON h.lang = x.lang AND h.phrase = x.head JOIN f g ON g.lang = x.lang AND g.phrase = x.tail),
z AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, phrase, max(a) AS longer FROM (
  SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM b WHERE words = 3) GROUP BY ALL),
o AS (SELECT z.* FROM z LEFT JOIN i ON i.lang = z.lang AND i.phrase = z.phrase
      WHERE i.longer IS NULL OR 100 * i.longer < {c.INSIDE} * z.a),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score::BIGINT AS score FROM k JOIN t ON t.lang = k.lang WHERE k.rank <= {c.TOP}
"""


def _op13() -> str:
    b = bond_negatives
    return f"""
WITH r AS MATERIALIZED (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({b.SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS MATERIALIZED (SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
      FROM r a JOIN r ON a.id <> r.id AND len(a.v) = len(r.v) WHERE a.id % {b.EVERY} = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {b.POSITIVES}),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INT AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND {b.LEAST} * p.score <= 100 * s.score AND 100 * s.score <= {b.MOST} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {b.NEGATIVES}
"""


SQL = {"op11_pivot_join": OP11, "op12_collocations": _op12(), "op13_bond_negatives": _op13(), "op7_prefix_join": OP7, "op8_spaced_seeds": _op8(), "op1_fingerprint_dedup": OP1, "op3_link_trust": _op3(), "op9_rendezvous": _op9(), "op10_line_dedup": OP10}
