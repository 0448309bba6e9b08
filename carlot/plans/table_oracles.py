"""DuckDB twins of ``carlot.plans.table_queries``."""

from __future__ import annotations

from carlot.plans.oracles import _CAT, _EQ, _LAST, LISTINGS, SQL, w

# --- keyed tables ---------------------------------------------------------------------

_VALUES = ["price", "make", "model", "mileage_km", "advert_date"]


def _upserted(target: str, batch: str, run: str) -> str:
    took = "b.advert_id IS NOT NULL"
    cols = ", ".join(f"CASE WHEN {took} THEN b.{c} ELSE t.{c} END AS {c}" for c in _VALUES)
    return f"""SELECT COALESCE(b.source, t.source) AS source, COALESCE(b.advert_id, t.advert_id) AS advert_id, {cols},
       COALESCE(t.first_seen_at, TIMESTAMP '{run}') AS first_seen_at,
       CASE WHEN {took} THEN TIMESTAMP '{run}' ELSE t.last_seen_at END AS last_seen_at
FROM {target} t FULL OUTER JOIN {batch} b ON t.source = b.source AND t.advert_id = b.advert_id"""


SQL["keyed_upsert"] = w(LISTINGS) + f""",
old AS (SELECT * FROM listings WHERE advert_date < TIMESTAMP '2000-01-01'),
hist AS (SELECT source, advert_id, MIN(advert_date) AS first_seen_at, MAX(advert_date) AS last_seen_at FROM old GROUP BY ALL),
t0 AS (SELECT o.*, h.first_seen_at, h.last_seen_at FROM old o JOIN hist h USING (source, advert_id)
       QUALIFY row_number() OVER (PARTITION BY source, advert_id {_LAST}) = 1),
bat AS (SELECT * FROM listings WHERE advert_date >= TIMESTAMP '2000-01-01'
        QUALIFY row_number() OVER (PARTITION BY source, advert_id {_LAST}) = 1),
b0 AS (SELECT * FROM bat WHERE source = 'src0'), b2 AS (SELECT * FROM bat WHERE source = 'src2'),
t1 AS ({_upserted("t0", "b0", "2030-01-01 00:00:00")})
{_upserted("t1", "b2", "2030-01-02 00:00:00")}
"""

# --- streams ---------------------------------------------------------------------------

SQL["stream_new_keys"] = """
WITH known AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-08')
SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS event_id,
       MIN(ts) AS first_seen_at, MAX(ts) AS last_seen_at, COUNT(*) AS sightings
FROM (SELECT DISTINCT user_id, event_type, ts, event_id, value FROM events) e
WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.user_id = e.user_id AND k.event_type = e.event_type)
GROUP BY user_id, event_type
"""

# --- growing dimensions -------------------------------------------------------------------

SQL["equipment_dim_grown"] = _EQ + """,
o AS (SELECT DISTINCT name FROM items WHERE listing_id % 2 = 1),
n AS (SELECT DISTINCT name FROM items WHERE name NOT IN (SELECT name FROM o))
SELECT row_number() OVER (ORDER BY name) - 1 AS id, name, true AS old FROM o
UNION ALL SELECT (SELECT COUNT(*) FROM o) + row_number() OVER (ORDER BY name) - 1, name, false FROM n
"""

SQL["listing_equipment_grown"] = SQL["listing_equipment_view"]
SQL["star_read_back"] = SQL["listing_equipment_view"]

# --- checks of written tables ------------------------------------------------------------------

_TEXT = " || ',' || ".join(f"COALESCE(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
                           for c in ("o_orderkey", "{cust}", "o_orderstatus", "o_orderpriority"))


def _sum(version: str, cust: str) -> str:
    return f"""SELECT '{version}' AS version, COUNT(*) AS rows, SUM(('0x' || substr(md5({_TEXT.format(cust=cust)}), 1, 15))::HUGEINT)::VARCHAR AS checksum,
       COUNT(*) FILTER (o_orderkey % 100 = 0) AS changed FROM orders"""


_CHANGED = "(CASE WHEN o_orderkey % 100 = 0 THEN o_custkey + 1 ELSE o_custkey END)"
SQL["table_fingerprints"] = f"""
SELECT rows, checksum, version, changed AS only_left, changed AS only_right FROM (
{_sum("written", "o_custkey")} UNION ALL {_sum("read", "o_custkey")} UNION ALL {_sum("changed", _CHANGED)})
"""

SQL["merged_exports"] = """
SELECT c_custkey, c_name, CASE WHEN c_nationkey % 3 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer WHERE c_nationkey % 3 < 2
"""

# --- landed pages and parameter maps --------------------------------------------------------------

SQL["pruned_pages"] = """
SELECT page_id, strftime(DATE '2026-01-01' + CAST(page_id % 28 AS INTEGER), '%Y-%m-%d') AS run_date, CAST(length(html) AS INTEGER) AS chars
FROM pages WHERE dayofweek(DATE '2026-01-01' + CAST(page_id % 28 AS INTEGER)) = 1
"""

SQL["raw_parameters"] = """
SELECT event_id, event_type, CAST(props->>'$.k' AS BIGINT) AS k, props->>'$.k' AS k_text, CAST(NULL AS VARCHAR) AS absent FROM events
"""

SQL["raw_parameter_kinds"] = """
SELECT event_type, 'OBJECT<k: BIGINT>' AS kinds, COUNT(props) AS maps FROM events GROUP BY event_type
"""

# --- bands --------------------------------------------------------------------------------------------

SQL["mileage_bands"] = w(LISTINGS) + """,
b AS (SELECT DISTINCT CAST(p_size AS INTEGER) AS band FROM part)
SELECT b.band, COUNT(*) AS listings, MIN(mileage_km) AS least, MAX(mileage_km) AS most, COUNT(price) AS priced
FROM listings LEFT JOIN b ON mileage_km >= band * 4000 AND mileage_km < band * 4000 + 3000 + band * 100
GROUP BY b.band
"""

# --- key lists and catalogues -----------------------------------------------------------------------------

SQL["seen_ids_file"] = """
SELECT CAST(length(CAST(o_custkey AS VARCHAR)) AS INTEGER) AS digits, COUNT(*) AS ids, CAST(SUM(o_custkey) AS BIGINT) AS id_sum
FROM (SELECT DISTINCT o_custkey FROM orders) GROUP BY 1
"""

SQL["catalogue_file"] = """
WITH c AS (SELECT p_brand, p_type, MIN(p_partkey) AS k FROM part GROUP BY ALL)
SELECT p_brand AS brand, p_type AS model, row_number() OVER (ORDER BY k) AS ord FROM c
"""

# --- clean_batch --------------------------------------------------------------------------------------------

_RAW = w(LISTINGS) + """,
r AS (SELECT DISTINCT advert_id, make, model, production_year, fuel_type, engine_capacity_cm3, p_size, mileage_km, l_linestatus,
             CAST(advert_date AS DATE) AS d, floor(price) AS price, currency,
             upper(split_part(p_name, ' ', 1)) || '|Bezpieczeństwo|' || string_split(p_name, ' ')[-1] AS equipment FROM listings),
"""

SQL["clean_batch_gaps"] = _RAW + """
n AS (SELECT COUNT(*) AS listings FROM r)
SELECT column_name, expected_type, listings FROM (VALUES {gaps}) v(column_name, expected_type), n
"""


def _gaps() -> str:
    from carlot.schemas import CAST_SPEC, DATE_SPEC
    have = {"advert_id", "make", "model", "production_year", "fuel_type", "engine_capacity_cm3", "power_hp", "mileage_km",
            "accident_free", "first_registration_date", "price", "currency"}
    return ", ".join(f"('{c}', '{t}')" for c, t in {**CAST_SPEC, **DATE_SPEC}.items() if c not in have)


SQL["clean_batch_gaps"] = SQL["clean_batch_gaps"].replace("{gaps}", _gaps())

SQL["clean_batch_star"] = _RAW + """
e AS (SELECT *, lower(split_part(equipment, '|', 1)) AS x, lower(split_part(equipment, '|', 3)) AS y FROM r)
SELECT advert_id, make, model, CAST(production_year AS SMALLINT) AS production_year, CAST(engine_capacity_cm3 AS FLOAT) AS engine_capacity_cm3,
       CAST(p_size AS FLOAT) AS power_hp, mileage_km, l_linestatus = 'F' AS accident_free, strftime(d, '%Y-%m-%d') AS first_registration,
       CAST(price AS FLOAT) AS price, CASE WHEN x = y THEN x ELSE least(x, y) || ', ' || greatest(x, y) END AS equipment
FROM e
"""

# --- profiles ------------------------------------------------------------------------------------------------

SQL["profile_by_source"] = w(LISTINGS) + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS nulls,
       COUNT(DISTINCT {c}) AS n_distinct, true AS estimate_near FROM listings"""
    for c in ("advert_id", "make", "model", "production_year", "price", "currency", "mileage_km", "fuel_type", "transmission",
              "engine_capacity_cm3", "advert_date"))
