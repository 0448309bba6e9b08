"""DuckDB SQL oracles for the registered queries.

Each string runs on DuckDB over the driver's parquet views and must give the
same rows as the Spark query of the same name. ``LISTINGS`` is the SQL twin
of ``carlot.sources.tables.listings``.
"""

from __future__ import annotations

LISTINGS = """
listings AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT)                         AS advert_id,
         'src' || CAST(l_suppkey % 3 AS VARCHAR)                               AS source,
         p_brand                                                               AS make,
         p_type                                                                AS model,
         CASE WHEN l_partkey % 29 = 0 THEN NULL
              ELSE CAST(2000 + l_partkey % 26 AS INTEGER) END                  AS production_year,
         CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice END           AS price,
         CASE WHEN l_returnflag = 'R' THEN 'EUR' ELSE 'PLN' END                AS currency,
         CAST(l_quantity * 5000 AS INTEGER)                                    AS mileage_km,
         CASE p_size % 7 WHEN 0 THEN 'Benzyna' WHEN 1 THEN 'Diesel'
              WHEN 2 THEN 'Benzyna+LPG' WHEN 3 THEN 'Hybryda'
              WHEN 4 THEN 'Elektryczny' WHEN 5 THEN 'Hybryda Plug-in' END      AS fuel_type,
         CASE WHEN l_linestatus = 'F' THEN 'Manualna' ELSE 'Automatyczna' END  AS transmission,
         CAST(900 + 50 * p_size AS INTEGER)                                    AS engine_capacity_cm3,
         l_shipdate                                                            AS advert_date,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag,
         l_linestatus, p_size, p_name
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""

PLN = """
pln AS (
  SELECT * REPLACE (round_even(price * CASE currency WHEN 'EUR' THEN 4.28 WHEN 'PLN' THEN 1.0
                                         ELSE 1.0 END, 0) AS price,
                    'PLN' AS currency)
  FROM listings)
"""

MEAN = "CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({c})"


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


SQL: dict[str, str] = {}

SQL["median_price_by_year"] = w(LISTINGS) + """
SELECT production_year, COUNT(*) AS listings, round(median(price), 4) AS median_price
FROM listings
WHERE price IS NOT NULL AND production_year IS NOT NULL AND production_year <> 0
GROUP BY production_year
"""

SQL["avg_price_by_fuel"] = w(LISTINGS) + f"""
SELECT COALESCE(NULLIF(fuel_type, ''), 'unknown') AS fuel_type,
       {MEAN.format(c='price')} AS avg_price, COUNT(*) AS listings
FROM listings WHERE price IS NOT NULL
GROUP BY 1
"""

SQL["offers_by_make_model"] = w(LISTINGS) + """
SELECT COALESCE(NULLIF(make, ''), 'unknown') AS make, COALESCE(NULLIF(model, ''), 'unknown') AS model,
       COUNT(*) AS offers
FROM listings WHERE price IS NOT NULL
GROUP BY 1, 2
"""

SQL["avg_price_by_mileage_band"] = w(LISTINGS) + f"""
SELECT printf('%06d-%06d km', CAST(floor(mileage_km / 50000) AS BIGINT) * 50000,
              CAST(floor(mileage_km / 50000) AS BIGINT) * 50000 + 49999) AS mileage_band,
       {MEAN.format(c='price')} AS avg_price, COUNT(*) AS listings
FROM listings WHERE price IS NOT NULL AND mileage_km IS NOT NULL
GROUP BY 1
"""

SQL["offers_avg_by_year_null_kept"] = w(LISTINGS) + f"""
SELECT production_year, COUNT(*) AS offers, {MEAN.format(c='price')} AS avg_price
FROM listings GROUP BY production_year
"""

SQL["age_band_profile"] = w(LISTINGS, PLN) + """,
bands(age_group, band_order, lo, hi) AS (VALUES ('0–4', 0, 0, 5), ('5–9', 1, 5, 10),
   ('10–14', 2, 10, 15), ('15–19', 3, 15, 20), ('20–25', 4, 20, 26)),
banded AS (
  SELECT b.age_group, p.price, p.mileage_km
  FROM pln p JOIN bands b ON 2025 - p.production_year >= b.lo AND 2025 - p.production_year < b.hi),
agg AS (
  SELECT age_group, COUNT(*) AS listings, round(median(price), 4) AS median_price,
         round(median(mileage_km), 4) AS median_mileage_km
  FROM banded GROUP BY age_group)
SELECT b.age_group, b.band_order, CAST(COALESCE(a.listings, 0) AS BIGINT) AS listings,
       a.median_price, a.median_mileage_km
FROM bands b LEFT JOIN agg a USING (age_group)
"""

SQL["mileage_usage_by_year"] = w(LISTINGS, PLN) + """,
agg AS (
  SELECT production_year, round(median(mileage_km), 4) AS median_mileage_km,
         AVG(CAST(mileage_km AS DOUBLE)) AS mean_mileage
  FROM pln WHERE production_year IS NOT NULL GROUP BY production_year)
SELECT production_year, median_mileage_km, mean_mileage,
       round_even(CASE WHEN 2025 - production_year = 0 THEN NULL
                  ELSE median_mileage_km / (2025 - production_year) END, 0) AS avg_annual_km,
       round_even(round_even(CASE WHEN 2025 - production_year = 0 THEN NULL
                  ELSE median_mileage_km / (2025 - production_year) END, 0) / 12, 0) AS avg_monthly_km,
       2025 - production_year AS age
FROM agg
"""

SQL["fuel_counts_pivot"] = w(LISTINGS, PLN) + """,
n AS (SELECT production_year, fuel_type, COUNT(*) AS n FROM pln
      WHERE production_year IS NOT NULL AND fuel_type IS NOT NULL GROUP BY ALL)
SELECT y.production_year, f.fuel_type, COALESCE(n.n, 0) AS listings
FROM (SELECT DISTINCT production_year FROM n) y CROSS JOIN (SELECT DISTINCT fuel_type FROM n) f
LEFT JOIN n ON n.production_year = y.production_year AND n.fuel_type = f.fuel_type
"""

SQL["fuel_share_by_year"] = w(LISTINGS, PLN) + """
SELECT production_year,
       COUNT(*) FILTER (WHERE fuel_type = 'Benzyna') / COUNT(*)         AS share_benzyna,
       COUNT(*) FILTER (WHERE fuel_type = 'Diesel') / COUNT(*)          AS share_diesel,
       COUNT(*) FILTER (WHERE fuel_type = 'Benzyna+LPG') / COUNT(*)     AS share_benzyna_lpg,
       COUNT(*) FILTER (WHERE fuel_type = 'Hybryda') / COUNT(*)         AS share_hybryda,
       COUNT(*) FILTER (WHERE fuel_type = 'Elektryczny') / COUNT(*)     AS share_elektryczny,
       COUNT(*) FILTER (WHERE fuel_type = 'Hybryda Plug-in') / COUNT(*) AS share_hybryda_plug_in
FROM pln WHERE production_year IS NOT NULL AND fuel_type IS NOT NULL
GROUP BY production_year
"""

SQL["top_models_vs_market"] = w(LISTINGS, PLN) + """,
win AS (SELECT * FROM pln WHERE production_year BETWEEN 2010 AND 2020),
agg AS (
  SELECT make, model, COUNT(*) AS listings, round(median(price), 4) AS median_price,
         round(median(mileage_km), 4) AS median_mileage_km
  FROM win WHERE make IS NOT NULL AND model IS NOT NULL GROUP BY make, model
  ORDER BY listings DESC, make ASC, model ASC LIMIT 10),
mkt AS (SELECT round(median(price), 4) AS market_median_price,
               round(median(mileage_km), 4) AS market_median_mileage_km FROM win)
SELECT agg.*, mkt.market_median_price, mkt.market_median_mileage_km FROM agg, mkt
"""

SQL["top3_config_prices"] = w(LISTINGS, PLN) + """,
win AS (SELECT * FROM pln WHERE production_year BETWEEN 2010 AND 2020
        AND make IS NOT NULL AND model IS NOT NULL),
top AS (SELECT make, model FROM win GROUP BY make, model
        ORDER BY COUNT(*) DESC, make ASC, model ASC LIMIT 3),
sel AS (
  SELECT w.*, concat_ws(' | ',
           COALESCE(CAST(CAST(round(CAST(engine_capacity_cm3 AS DECIMAL(12,4)) / 1000, 1) AS DECIMAL(12,1)) AS VARCHAR), '?'),
           COALESCE(upper(substr(fuel_type, 1, 1)), '?'),
           COALESCE(upper(substr(transmission, 1, 1)), '?')) AS config_short
  FROM win w SEMI JOIN top USING (make, model))
SELECT make, model, config_short, COUNT(price) AS listings, round(median(price), 4) AS median_price,
       round(median(mileage_km), 4) AS median_mileage_km
FROM sel GROUP BY make, model, config_short
"""

SQL["depreciation_curve"] = w(LISTINGS, PLN) + """,
agg AS (
  SELECT model, production_year, COUNT(*) AS listings, round(median(price), 4) AS median_price
  FROM pln WHERE production_year BETWEEN 2010 AND 2022
    AND model IN ('ECONOMY', 'SMALL', 'LARGE', 'PROMO')
  GROUP BY model, production_year)
SELECT *, round(median_price - lag(median_price) OVER (PARTITION BY model ORDER BY production_year), 4)
          AS yoy_change
FROM agg
"""

_GEARBOX = """,
g AS (
  SELECT model, transmission, COUNT(*) AS listings, round(median(price), 4) AS median_price
  FROM pln WHERE production_year BETWEEN 2015 AND 2023
    AND transmission IN ('Automatyczna', 'Manualna')
    AND model IN ('ECONOMY', 'SMALL', 'LARGE', 'PROMO') AND price > 5000
  GROUP BY model, transmission)
"""

SQL["gearbox_prices"] = w(LISTINGS, PLN) + _GEARBOX + "SELECT * FROM g"

SQL["gearbox_premium"] = w(LISTINGS, PLN) + _GEARBOX + """
SELECT model,
       MAX(median_price) FILTER (WHERE transmission = 'Automatyczna') AS median_automatic,
       MAX(median_price) FILTER (WHERE transmission = 'Manualna') AS median_manual,
       round(MAX(median_price) FILTER (WHERE transmission = 'Automatyczna')
           - MAX(median_price) FILTER (WHERE transmission = 'Manualna'), 4) AS premium
FROM g GROUP BY model
"""

SQL["currency_normalize"] = w(LISTINGS) + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price, currency AS currency_in,
       round_even(price * COALESCE(CASE currency WHEN 'EUR' THEN 4.28 WHEN 'PLN' THEN 1.0 END, 1.0), 0)
         AS price_pln,
       round_even(price / COALESCE(CASE currency WHEN 'EUR' THEN 4.28 WHEN 'PLN' THEN 1.0 END, 1.0), 0)
         AS price_pln_notebook
FROM listings
"""

_K = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

SQL["clean_numeric_fields"] = w(LISTINGS) + f"""
SELECT {_K},
       CAST(floor(price) AS DECIMAL(12,2)) AS price_whole,
       CAST(CAST(round(price * 100) AS BIGINT) AS DECIMAL(12,2)) AS price_digits,
       CAST(CAST(round(price * 100) AS BIGINT) / 100 AS DECIMAL(12,2)) AS price_decimal,
       CAST(CAST(floor(price) AS BIGINT) AS DOUBLE)
         + CAST(CAST(round(price * 100) AS BIGINT) % 100 AS DOUBLE) / 100 AS price_legacy,
       mileage_km,
       CASE WHEN l_partkey % 2 = 0 THEN CAST(round_even(p_size * 1.35962, 0) AS INTEGER) ELSE p_size END
         AS power_hp,
       engine_capacity_cm3,
       CAST(mileage_km AS DOUBLE) AS mileage_first_number
FROM listings
"""

SQL["unit_measures"] = w(LISTINGS) + f"""
SELECT {_K},
       CASE WHEN l_linenumber IN (6, 7) THEN NULL
            ELSE CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS battery_kwh,
       l_linenumber NOT IN (6, 7) AS battery_ok,
       CASE WHEN l_linenumber = 7 THEN NULL
            WHEN l_linenumber = 6 AND CAST(l_quantity AS INTEGER) < 10 THEN 5.0
            WHEN l_linenumber = 6 THEN NULL
            ELSE CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS battery_kwh_parity,
       CASE WHEN l_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) * CAST(1.35962 AS DOUBLE)
            ELSE CAST(p_size AS DOUBLE) END AS power_hp,
       CAST(engine_capacity_cm3 AS DOUBLE) AS engine_cm3,
       mileage_km
FROM listings
"""

SQL["unit_violations"] = """
WITH r AS (
  SELECT CASE l_linenumber WHEN 7 THEN q || ' kW' WHEN 6 THEN q || ',5 kWh' ELSE q || ' kWh' END AS b
  FROM (SELECT CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, l_linenumber
        FROM lineitem JOIN part ON l_partkey = p_partkey)),
u AS (SELECT regexp_extract(b, '(\\d+\\.?\\d*)\\s*(\\w+)', 2) AS unit FROM r
      WHERE regexp_matches(b, '(\\d+\\.?\\d*)\\s*(\\w+)'))
SELECT 'battery_capacity_kwh' AS measure, unit, COUNT(*) AS n FROM u WHERE unit <> 'kWh' GROUP BY unit
"""

SQL["polish_date_parse"] = w(LISTINGS) + f"""
SELECT {_K},
       CASE WHEN l_linenumber IN (6, 7) THEN NULL ELSE CAST(advert_date AS TIMESTAMP) END AS advert_ts,
       l_linenumber = 7 AS rejected,
       CASE WHEN l_linenumber IN (6, 7) THEN NULL ELSE CAST(advert_date AS TIMESTAMP) END AS advert_ts_batch
FROM listings
"""

SQL["tak_nie_bool"] = w(LISTINGS) + f"""
SELECT {_K}, l_linestatus = 'F' AS flag, CAST(NULL AS BOOLEAN) AS flag_noise FROM listings
"""

SQL["location_split"] = """
SELECT c_custkey, n_name AS city, r_name AS province
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

SQL["description_extract"] = w(LISTINGS) + f"""
SELECT {_K}, engine_capacity_cm3 AS engine_capacity, p_size AS power, CAST(mileage_km AS DOUBLE) AS mileage_km
FROM listings
"""

# --- data quality ---------------------------------------------------------------------

_LCOLS = ["advert_id", "source", "make", "model", "production_year", "price", "currency",
          "mileage_km", "fuel_type", "transmission", "engine_capacity_cm3", "advert_date"]

SQL["null_profile"] = w(LISTINGS) + "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls FROM listings" for c in _LCOLS
) + ") ORDER BY nulls DESC, column_name ASC LIMIT 10"

SQL["column_profile"] = w(LISTINGS) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT({c}) AS non_null, "
    f"COUNT(*) - COUNT({c}) AS nulls, COUNT(DISTINCT {c}) AS n_distinct FROM listings" for c in _LCOLS)

SQL["describe_profile"] = w(LISTINGS) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, round(AVG(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, CAST(MIN({c}) AS DOUBLE) AS min, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(MAX({c}) AS DOUBLE) AS max "
    f"FROM listings" for c in ["price", "mileage_km", "production_year", "engine_capacity_cm3"])

_DUP = "make, model, production_year, fuel_type, transmission, currency"

SQL["dedup_full_row"] = w(LISTINGS) + f"SELECT DISTINCT {_DUP} FROM listings"

SQL["dup_groups"] = w(LISTINGS) + """
SELECT source, advert_id, l_partkey, l_suppkey, price FROM listings
QUALIFY COUNT(*) OVER (PARTITION BY source, advert_id) > 1
"""

SQL["distinct_by_subset"] = w(LISTINGS) + """
SELECT COUNT(*) AS n_distinct FROM (SELECT DISTINCT make, model, production_year, fuel_type, transmission,
  engine_capacity_cm3, currency, mileage_km, l_returnflag FROM listings)
"""

SQL["dup_count"] = w(LISTINGS) + f"""
SELECT COUNT(*) AS rows, (SELECT COUNT(*) FROM (SELECT DISTINCT {_DUP} FROM listings)) AS distinct_rows,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {_DUP} FROM listings)) AS duplicates
FROM listings
"""

SQL["drop_missing"] = w(LISTINGS) + f"""
SELECT {', '.join(_LCOLS)}, l_partkey, l_suppkey FROM listings
WHERE price IS NOT NULL AND production_year IS NOT NULL AND fuel_type IS NOT NULL
"""

# --- keys -----------------------------------------------------------------------------

SQL["known_key_anti_join"] = w(LISTINGS) + """
SELECT source, advert_id, l_partkey, l_suppkey, advert_date FROM listings l
WHERE NOT EXISTS (SELECT 1 FROM listings k WHERE k.advert_date < TIMESTAMP '2000-01-01'
                  AND k.source = l.source AND k.advert_id = l.advert_id)
"""

_LAST = "ORDER BY advert_date DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC"

SQL["upsert_latest"] = w(LISTINGS) + f""",
old AS (SELECT * FROM listings WHERE advert_date < TIMESTAMP '2000-01-01'),
hist AS (SELECT source, advert_id, MIN(advert_date) AS first_seen_at, MAX(advert_date) AS last_seen_at
         FROM old GROUP BY source, advert_id),
tgt AS (SELECT o.*, h.first_seen_at, h.last_seen_at FROM old o JOIN hist h USING (source, advert_id)
        QUALIFY row_number() OVER (PARTITION BY source, advert_id {_LAST}) = 1),
bat AS (SELECT * FROM listings WHERE advert_date >= TIMESTAMP '2000-01-01'
        QUALIFY row_number() OVER (PARTITION BY source, advert_id {_LAST}) = 1)
SELECT COALESCE(b.source, t.source) AS source, COALESCE(b.advert_id, t.advert_id) AS advert_id,
       CASE WHEN b.advert_id IS NOT NULL THEN b.price ELSE t.price END AS price,
       CASE WHEN b.advert_id IS NOT NULL THEN b.make ELSE t.make END AS make,
       CASE WHEN b.advert_id IS NOT NULL THEN b.model ELSE t.model END AS model,
       CASE WHEN b.advert_id IS NOT NULL THEN b.production_year ELSE t.production_year END AS production_year,
       CASE WHEN b.advert_id IS NOT NULL THEN b.mileage_km ELSE t.mileage_km END AS mileage_km,
       CASE WHEN b.advert_id IS NOT NULL THEN b.advert_date ELSE t.advert_date END AS advert_date,
       COALESCE(t.first_seen_at, TIMESTAMP '2030-01-01 00:00:00') AS first_seen_at,
       CASE WHEN b.advert_id IS NOT NULL THEN TIMESTAMP '2030-01-01 00:00:00' ELSE t.last_seen_at END
         AS last_seen_at
FROM tgt t FULL OUTER JOIN bat b ON t.source = b.source AND t.advert_id = b.advert_id
"""

SQL["first_wins_in_page"] = """
SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
"""

SQL["surrogate_ids"] = w(LISTINGS) + """
SELECT advert_id, source, l_partkey, l_suppkey,
       row_number() OVER (ORDER BY advert_id, source, advert_date, l_partkey, l_suppkey, l_quantity) AS local_id
FROM listings
"""

_CRAWL = """
WITH refs0 AS (
  SELECT user_id AS run, CAST(dayofmonth(ts) AS INTEGER) AS page, event_id AS pos,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS advert_id,
         CASE event_type WHEN 'error' THEN 'AccessBlocked' WHEN 'signup' THEN 'FetchFailed' ELSE 'ok' END
           AS outcome
  FROM events),
refs AS (SELECT * FROM refs0 QUALIFY row_number() OVER (PARTITION BY run, page, advert_id ORDER BY pos) = 1),
known AS (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS advert_id FROM events
          WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-08'),
k AS (SELECT r.*, CAST(r.page AS BIGINT) * 1000000000 + r.pos AS seq, (kn.advert_id IS NOT NULL) AS is_known
      FROM refs r LEFT JOIN known kn USING (advert_id) WHERE r.page <= 20),
fo AS (SELECT run, advert_id, MIN(seq) AS first_ok FROM k WHERE outcome = 'ok' AND NOT is_known
       GROUP BY run, advert_id),
t AS (SELECT k.*, COALESCE(fo.first_ok < k.seq, false) AS taken FROM k LEFT JOIN fo USING (run, advert_id)),
n AS (SELECT *, COALESCE(SUM(CASE WHEN NOT is_known AND NOT taken AND outcome = 'ok' THEN 1 ELSE 0 END)
                OVER (PARTITION BY run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS n_before FROM t),
s AS (SELECT *, CASE WHEN n_before >= 30 THEN 'max_listings'
                     WHEN NOT is_known AND NOT taken
                          AND outcome IN ('AccessBlocked', 'RateLimited', 'CaptchaDetected') THEN outcome
                END AS stop FROM n),
st AS (SELECT run, arg_min(stop, seq) AS stopped_reason, MIN(seq) AS stop_seq FROM s
       WHERE stop IS NOT NULL GROUP BY run),
c AS (
  SELECT s.run, s.page, s.pos, s.advert_id, s.outcome,
         CASE WHEN st.stop_seq IS NOT NULL AND s.seq = st.stop_seq THEN 'stop'
              WHEN st.stop_seq IS NOT NULL AND s.seq > st.stop_seq THEN 'not_reached'
              WHEN is_known OR taken THEN 'skipped'
              WHEN outcome = 'ok' THEN 'saved' ELSE 'parse_error' END AS action,
         st.stopped_reason, CAST(st.stop_seq // 1000000000 AS INTEGER) AS stop_page
  FROM s LEFT JOIN st USING (run))
"""

SQL["crawl_replay"] = _CRAWL + "SELECT * FROM c"

SQL["crawl_stats"] = _CRAWL + """
SELECT run,
       COUNT(DISTINCT CASE WHEN stop_page IS NULL OR page <= stop_page THEN page END) AS pages_visited,
       COUNT(*) FILTER (WHERE stop_page IS NULL OR page <= stop_page) AS listings_found,
       COUNT(*) FILTER (WHERE action = 'saved') AS new_listings,
       COUNT(*) FILTER (WHERE action = 'skipped') AS skipped_duplicates,
       COUNT(*) FILTER (WHERE action = 'parse_error') AS parse_errors,
       COUNT(*) FILTER (WHERE action = 'saved') AS saved_records,
       MAX(stopped_reason) AS stopped_reason
FROM c GROUP BY run
"""

# --- equipment ------------------------------------------------------------------------

_EQ = """
WITH eq AS (
  SELECT p_partkey AS listing_id,
         CASE WHEN p_size % 10 = 0 THEN NULL ELSE
           ' ' || upper(split_part(p_name, ' ', 1)) || ' |Bezpieczeństwo|' || string_split(p_name, ' ')[-1]
           || '||' || lower(split_part(p_name, ' ', 1)) END AS equipment
  FROM part),
items AS (
  SELECT DISTINCT listing_id, lower(trim(item)) AS name
  FROM (SELECT listing_id, unnest(string_split(COALESCE(equipment, ''), '|')) AS item FROM eq)
  WHERE lower(trim(item)) NOT IN ('audio i multimedia', 'komfort i dodatki',
                                  'systemy wspomagania kierowcy', 'bezpieczeństwo')
    AND lower(trim(item)) <> ''),
dim AS (SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS BIGINT) AS id, name
        FROM (SELECT DISTINCT name FROM items))
"""

SQL["equipment_dim"] = _EQ + "SELECT id, name FROM dim"

SQL["listing_equipment"] = _EQ + """
SELECT DISTINCT i.listing_id, d.id AS equipment_id FROM items i JOIN dim d USING (name)
"""

SQL["listing_equipment_view"] = _EQ + """
SELECT e.listing_id, string_agg(d.name, ', ' ORDER BY d.name) AS equipment
FROM eq e LEFT JOIN items i USING (listing_id) LEFT JOIN dim d USING (name)
GROUP BY e.listing_id
"""

# --- catalogue ------------------------------------------------------------------------

_CAT = """,
cat AS (SELECT brand, model, row_number() OVER (ORDER BY k) AS ord
        FROM (SELECT p_brand AS brand, p_type AS model, MIN(p_partkey) AS k FROM part GROUP BY ALL)),
brands AS (SELECT brand, MAX(ord) AS ord FROM cat GROUP BY brand),
titles AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  concat_ws(' ', make, upper(substr(model, 1, 1)) || lower(substr(model, 2)), p_name,
                    CASE WHEN l_linenumber % 3 = 0 THEN 'swap Brand#' || CAST(l_suppkey % 5 + 1 AS VARCHAR)
                         || CAST(l_partkey % 5 + 1 AS VARCHAR) END) AS title FROM listings),
tagged AS (
  SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, t.title,
         (SELECT arg_max(b.brand, b.ord) FROM brands b
          WHERE regexp_matches(t.title, '(?i)\\b' || b.brand || '\\b')) AS make
  FROM titles t)
"""

SQL["make_tagging"] = w(LISTINGS) + _CAT + "SELECT * FROM tagged"

SQL["model_tagging"] = w(LISTINGS) + _CAT + """,
models AS (SELECT brand, model, row_number() OVER (PARTITION BY brand ORDER BY length(model) DESC, ord) AS k
           FROM cat),
nmod AS (SELECT brand, MAX(k) AS kmax FROM models GROUP BY brand)
SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, t.make,
  (WITH RECURSIVE r(k, tt, m) AS (
     SELECT 0, t.title, CAST(NULL AS VARCHAR)
     UNION ALL
     SELECT r.k + 1,
            CASE WHEN regexp_matches(r.tt, '(?i)\\b' || mo.model || '\\b')
                 THEN trim(regexp_replace(r.tt, '\\b' || mo.model || '\\b', '', 'g')) ELSE r.tt END,
            CASE WHEN regexp_matches(r.tt, '(?i)\\b' || mo.model || '\\b') THEN mo.model ELSE r.m END
     FROM r JOIN models mo ON mo.brand = t.make AND mo.k = r.k + 1)
   SELECT m FROM r ORDER BY k DESC LIMIT 1) AS model
FROM tagged t
"""

SQL["catalogue_labels"] = """
SELECT p_brand || ' (' || CAST(COUNT(*) AS VARCHAR) || ')' AS label, p_brand AS brand FROM part GROUP BY p_brand
"""

SQL["search_urls"] = """
SELECT brand, model, replace(replace(lower(trim(brand)), ' ', '-'), '#', '%23') AS make_slug,
       replace(lower(trim(model)), ' ', '-') AS model_slug,
       'https://listings.example/osobowe/' || replace(lower(trim(brand)), ' ', '-') || '/'
         || replace(lower(trim(model)), ' ', '-')
         || '?search%5Bfilter_float_year%3Afrom%5D=2019&search%5Bfilter_float_year%3Ato%5D=2021'
         || '&search%5Badvanced_search_expanded%5D=true' AS url
FROM (SELECT DISTINCT p_brand AS brand, p_type AS model FROM part)
"""

# --- segments -------------------------------------------------------------------------

_SEGMENTS = """,
c AS (SELECT production_year AS y, transmission AS g, COUNT(*) AS n FROM listings GROUP BY ALL),
lv AS (SELECT y, g, n, SUM(n) OVER (PARTITION BY y) AS year_n, SUM(n) OVER () AS total FROM c),
s AS (SELECT l.*, lv.n, CASE WHEN total <= 1000 THEN 'all' WHEN year_n <= 1000 THEN 'year' WHEN n <= 1000 THEN 'year_gearbox'
                             ELSE 'range' END AS level,
             CASE WHEN level = 'range' THEN ((row_number() OVER (PARTITION BY production_year, transmission
               ORDER BY advert_id, l_partkey, l_suppkey) - 1) * ((lv.n + 999) // 1000)) // lv.n END AS part
      FROM listings l JOIN lv ON l.production_year IS NOT DISTINCT FROM lv.y AND l.transmission = lv.g)
"""

SQL["segment_plan"] = w(LISTINGS) + _SEGMENTS + """
SELECT level, CASE WHEN level <> 'all' THEN production_year END AS production_year,
       CASE WHEN level IN ('year_gearbox', 'range') THEN transmission END AS transmission, part::INT AS part, COUNT(*) AS listings,
       CASE WHEN level = 'range' THEN MIN(advert_id) END AS first_key, CASE WHEN level = 'range' THEN MAX(advert_id) END AS last_key
FROM s GROUP BY level, 2, 3, part
"""

# --- extraction round trip ----------------------------------------------------------------

SQL["offer_roundtrip"] = w(LISTINGS) + f"""
SELECT {_K}, CAST(advert_id AS VARCHAR) AS advert_id, make, model, p_name AS version, production_year,
       CAST(floor(price) AS DECIMAL(12,2)) AS price, CASE WHEN price IS NULL THEN NULL ELSE currency END AS currency,
       mileage_km, fuel_type, transmission,
       CASE WHEN l_partkey % 2 = 0 THEN CAST(round_even(p_size * 1.35962, 0) AS INTEGER) ELSE p_size END AS power_hp,
       engine_capacity_cm3, CAST(advert_date AS TIMESTAMP) AS advert_date,
       CASE WHEN split_part(p_name, ' ', 1) = split_part(p_name, ' ', 2) THEN split_part(p_name, ' ', 1)
            ELSE replace(p_name, ' ', ', ') END AS equipment,
       7 + CASE WHEN production_year IS NULL THEN 0 ELSE 1 END + CASE WHEN fuel_type IS NULL THEN 0 ELSE 1 END
         AS n_params
FROM listings
"""

# --- files and streaming ------------------------------------------------------------------------

SQL["multi_file_merge"] = """
WITH r AS (SELECT o_orderstatus AS s, row_number() OVER (ORDER BY o_orderstatus NULLS FIRST) - 1 AS i
           FROM (SELECT DISTINCT o_orderstatus FROM orders))
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN r.i % 3 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders JOIN r ON o_orderstatus IS NOT DISTINCT FROM r.s
"""

SQL["stream_upsert"] = """
SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS event_id,
       MIN(ts) AS first_seen_at, MAX(ts) AS last_seen_at, COUNT(*) AS sightings
FROM events GROUP BY user_id, event_type
"""

# --- text helpers ---------------------------------------------------------------------------

SQL["page_param_urls"] = """
WITH u AS (
  SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) AS base,
         regexp_extract(url, '\\?([^#]*)', 1) AS q, regexp_extract(url, '#(.*)$', 1) AS frag
  FROM pages)
SELECT page_id,
       base || '?' || CASE WHEN q = '' THEN 'page=3'
                           WHEN regexp_matches(q, '(^|&)page=') THEN regexp_replace(q, '(^|&)page=[^&]*', '\\1page=3')
                           ELSE q || '&page=3' END
            || CASE WHEN frag <> '' THEN '#' || frag ELSE '' END AS page_url
FROM u
"""

# --- batch export chain -----------------------------------------------------------------------

SQL["batch_export_chain"] = w(LISTINGS) + """
SELECT DISTINCT make, model, p_name AS version, split_part(p_name, ' ', 1) AS color,
       CAST(CASE WHEN p_size % 2 = 0 THEN 5 ELSE 3 END AS TINYINT) AS number_of_doors,
       CAST(production_year AS SMALLINT) AS production_year, fuel_type,
       CAST(engine_capacity_cm3 AS FLOAT) AS engine_capacity_cm3,
       CAST(CASE WHEN l_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) * CAST(1.35962 AS DOUBLE)
                 ELSE CAST(p_size AS DOUBLE) END AS FLOAT) AS power_hp,
       transmission, mileage_km, l_linestatus = 'F' AS accident_free,
       CASE WHEN fuel_type = 'Elektryczny' THEN CAST(CAST(l_quantity AS INTEGER) AS FLOAT) END
         AS battery_capacity_kwh,
       CAST(floor(price) AS FLOAT) AS price, CASE WHEN price IS NOT NULL THEN currency END AS currency,
       CASE WHEN l_returnflag = 'A' THEN 'W granicach średniej' END AS price_level,
       CAST(advert_date AS TIMESTAMP) AS advert_date, advert_id,
       'Stan bardzo dobry.Wersja ' || p_name AS description, 
       array_to_string(list_sort(list_distinct(list_transform(string_split(p_name, ' '), lambda x: lower(x)))), '|')
         AS equipment_items
FROM listings
"""

# --- remaining operators ----------------------------------------------------------------------

SQL["unit_measures_rest"] = w(LISTINGS) + f"""
SELECT {_K}, CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS range_km,
       CAST(p_size AS DOUBLE) AS co2_emissions_gpkm, p_size + 0.5::DOUBLE AS urban_fuel_consumption_l_per_100km,
       CAST(p_size AS DOUBLE) AS extraurban_fuel_consumption_l_per_100km,
       p_size + 0.25::DOUBLE AS average_energy_consumption_kwh_per_100km,
       CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber + 90 AS DOUBLE) END AS battery_health_percent,
       CASE WHEN l_linenumber <> 6 THEN CAST(p_size AS DOUBLE) END AS max_electric_power_hp
FROM listings
"""

SQL["unit_rejects"] = w(LISTINGS) + f"""
SELECT {_K}, 'range_km' AS measure, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' mil' AS raw, 'mil' AS unit
FROM listings WHERE l_linenumber = 7
UNION ALL
SELECT {_K}, 'max_electric_power_hp', CAST(p_size AS VARCHAR) || ' KM', 'KM' FROM listings WHERE l_linenumber = 6
"""

SQL["median_hot_group"] = """
SELECT CASE WHEN l_linenumber < 7 THEN 'hot' ELSE l_returnflag END AS grp, COUNT(*) AS n,
       quantile_cont(l_quantity::DOUBLE, 0.25) AS p25_l_quantity, quantile_cont(l_quantity::DOUBLE, 0.5) AS p50_l_quantity,
       quantile_cont(l_quantity::DOUBLE, 0.75) AS p75_l_quantity
FROM lineitem GROUP BY 1
"""

SQL["config_labels"] = w(LISTINGS) + """
SELECT CAST(engine_capacity_cm3 AS VARCHAR) || 'L | ' || COALESCE(fuel_type, 'unknown') || ' | '
         || COALESCE(transmission, 'unknown') AS config_long,
       make || ' ' || model AS model_label, COUNT(*) AS listings
FROM listings GROUP BY 1, 2
"""

SQL["scrape_dates"] = """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - INTERVAL 32 DAY, '%Y-%m-%d') AS scrape_date FROM orders
"""

SQL["coercion_report"] = """
WITH t AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority WHEN o_orderkey % 11 = 0 THEN ''
                       ELSE CAST(o_totalprice AS VARCHAR) END AS p, CAST(o_custkey AS VARCHAR) AS c FROM orders)
SELECT 'price_text' AS column_name, COUNT(*) FILTER (p <> '' AND try_cast(p AS DOUBLE) IS NULL) AS invalid,
       COUNT(*) FILTER (p IS NULL OR p = '') AS missing FROM t
UNION ALL SELECT 'customer_text', COUNT(*) FILTER (try_cast(c AS BIGINT) IS NULL AND c IS NOT NULL),
       COUNT(*) FILTER (c IS NULL OR c = '') FROM t
"""

SQL["numeric_profile"] = w(LISTINGS) + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS nulls FROM listings"
    for c in ("advert_id", "production_year", "price", "mileage_km", "engine_capacity_cm3"))

SQL["segment_files"] = w(LISTINGS) + _SEGMENTS + """
SELECT CASE level WHEN 'all' THEN 'all' WHEN 'year' THEN 'y_' || COALESCE(CAST(production_year AS VARCHAR), 'null')
            ELSE 'yg_' || COALESCE(CAST(production_year AS VARCHAR), 'null') || '_' || transmission || COALESCE('_' || part, '') END AS segment,
       COUNT(*) AS listings
FROM s GROUP BY 1
"""
SQL["text_normalize"] = """
SELECT doc_id, sha256(trim(regexp_replace(replace(text, chr(160), ' '), '\\s+', ' ', 'g'))) AS text_sha256 FROM documents
"""

SQL["clean_titles"] = w(LISTINGS) + """
SELECT CAST((l_orderkey * 8 + l_linenumber) * 100000000 + l_partkey * 1000 + l_suppkey % 1000 AS DOUBLE) AS ID,
       make AS Make, model AS Model, CAST(mileage_km AS DOUBLE) AS mileage_km, floor(price) AS Price,
       CAST(production_year AS DOUBLE) AS Year, CAST(engine_capacity_cm3 AS DOUBLE) AS engine_capacity,
       CAST(p_size AS DOUBLE) AS Power, CASE WHEN l_linenumber % 2 = 0 THEN 'Dealer' END AS seller_type,
       'Kraków' AS City, 'Małopolskie' AS Province, '2025-12-31' AS scraping_date
FROM listings WHERE price IS NOT NULL
"""


from carlot.plans import table_oracles  # noqa: E402, F401
