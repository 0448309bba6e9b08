"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables (or data Spark derives from them) and
runs one or more carlot operators over the whole tables. The SQL twin of
every query is in ``carlot.plans.oracles.SQL`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.functions import clean as C
from carlot.operators import market as M
from carlot.sources.tables import listings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _pln(spark, sf):
    return M.in_pln(listings(spark, sf))


# --- example report (N5) ----------------------------------------------------------

@query("median_price_by_year")
def q_median_price_by_year(spark, sf):
    return M.median_price_by_year(listings(spark, sf))


@query("avg_price_by_fuel")
def q_avg_price_by_fuel(spark, sf):
    return M.avg_price_by_fuel(listings(spark, sf))


@query("offers_by_make_model")
def q_offers_by_make_model(spark, sf):
    return M.offers_by_make_model(listings(spark, sf))


@query("avg_price_by_mileage_band")
def q_avg_price_by_mileage_band(spark, sf):
    return M.avg_price_by_mileage_band(listings(spark, sf))


@query("offers_avg_by_year_null_kept")
def q_offers_avg_by_year(spark, sf):
    return M.offers_avg_by_year(listings(spark, sf))


# --- notebook analytics (N6), prices in PLN ----------------------------------------

@query("age_band_profile")
def q_age_band_profile(spark, sf):
    return M.age_band_profile(_pln(spark, sf))


@query("mileage_usage_by_year")
def q_mileage_usage_by_year(spark, sf):
    return M.mileage_usage_by_year(_pln(spark, sf))


@query("fuel_counts_pivot")
def q_fuel_counts_pivot(spark, sf):
    return M.fuel_counts(_pln(spark, sf))


@query("fuel_share_by_year")
def q_fuel_share_by_year(spark, sf):
    return M.fuel_share_by_year(_pln(spark, sf))


@query("top_models_vs_market")
def q_top_models_vs_market(spark, sf):
    return M.top_models_vs_market(_pln(spark, sf))


@query("top3_config_prices")
def q_top3_config_prices(spark, sf):
    return M.top3_config_prices(_pln(spark, sf))


@query("depreciation_curve")
def q_depreciation_curve(spark, sf):
    return M.depreciation_curve(_pln(spark, sf))


@query("gearbox_prices")
def q_gearbox_prices(spark, sf):
    return M.gearbox_prices(_pln(spark, sf))


@query("gearbox_premium")
def q_gearbox_premium(spark, sf):
    return M.gearbox_premium(_pln(spark, sf))


@query("currency_normalize")
def q_currency_normalize(spark, sf):
    lst = listings(spark, sf)
    return lst.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price",
                      F.col("currency").alias("currency_in"),
                      C.to_pln("price", "currency").alias("price_pln"),
                      C.to_pln("price", "currency", op="divide").alias("price_pln_notebook"))


# --- cleaners over rendered text (D1–D27) -------------------------------------------

from carlot.functions import measures as MS  # noqa: E402
from carlot.sources.render import listing_text, thousands  # noqa: E402
from carlot.sources.tables import table  # noqa: E402

_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("clean_numeric_fields")
def q_clean_numeric_fields(spark, sf):
    t = listing_text(listings(spark, sf))
    return t.select(
        *_KEYS,
        C.clean_price("price_raw").alias("price_whole"),
        C.clean_price("price_cents_raw").alias("price_digits"),
        C.clean_price("price_cents_raw", mode="decimal").alias("price_decimal"),
        C.legacy_price(F.regexp_replace("price_cents_raw", " PLN$", "")).alias("price_legacy"),
        C.clean_mileage("mileage_raw").alias("mileage_km"),
        C.clean_power_hp("power_raw").alias("power_hp"),
        C.clean_engine_capacity("engine_raw").alias("engine_capacity_cm3"),
        C.first_number("mileage_raw", drop=" km").alias("mileage_first_number"),
    )


@query("unit_measures")
def q_unit_measures(spark, sf):
    t = listing_text(listings(spark, sf))
    bat, moc = MS.SPEC_BY_TARGET["battery_capacity_kwh"], MS.SPEC_BY_TARGET["power_hp"]
    eng, mil = MS.SPEC_BY_TARGET["engine_capacity_cm3"], MS.SPEC_BY_TARGET["mileage_km"]
    return t.select(
        *_KEYS,
        MS.measure("battery_raw", bat)["value"].alias("battery_kwh"),
        MS.measure("battery_raw", bat)["ok"].alias("battery_ok"),
        MS.measure("battery_raw", bat, parity=True)["value"].alias("battery_kwh_parity"),
        MS.measure("power_raw", moc, parity=True)["value"].alias("power_hp"),
        MS.measure("engine_raw", eng, parity=True)["value"].alias("engine_cm3"),
        MS.measure("mileage_raw", mil, parity=True)["value"].alias("mileage_km"),
    )


@query("unit_violations")
def q_unit_violations(spark, sf):
    t = listing_text(listings(spark, sf)).select(
        F.col("battery_raw").alias("Pojemność baterii"), F.col("power_raw").alias("Moc"),
        F.col("engine_raw").alias("Pojemność skokowa"), F.col("mileage_raw").alias("Przebieg"))
    return MS.unexpected_units(t, parity=True)


@query("polish_date_parse")
def q_polish_date_parse(spark, sf):
    t = listing_text(listings(spark, sf))
    return t.select(*_KEYS, C.polish_date("date_raw").alias("advert_ts"),
                    C.polish_date_rejected("date_raw").alias("rejected"),
                    C.month_replace_date("date_raw").alias("advert_ts_batch"))


@query("tak_nie_bool")
def q_tak_nie_bool(spark, sf):
    t = listing_text(listings(spark, sf))
    return t.select(*_KEYS, C.tak_nie("bool_raw").alias("flag"),
                    C.tak_nie(F.concat(F.col("bool_raw"), F.lit("?"))).alias("flag_noise"))


@query("location_split")
def q_location_split(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions.
    nat = F.broadcast(table(spark, sf, "nation"))
    reg = F.broadcast(table(spark, sf, "region"))
    loc = (cust.join(nat, cust.c_nationkey == nat.n_nationkey)
           .join(reg, F.col("n_regionkey") == reg.r_regionkey)
           .select("c_custkey", F.concat_ws("", "n_name", F.lit(" ("), "r_name", F.lit(")")).alias("location")))
    return loc.select("c_custkey", C.city("location").alias("city"), C.province("location").alias("province"))


@query("description_extract")
def q_description_extract(spark, sf):
    lst = listings(spark, sf)
    desc = F.concat(F.lit("Auto w dobrym stanie.\nSilnik "), thousands("engine_capacity_cm3"),
                    F.lit("cm3, moc "), F.col("p_size").cast("string"), F.lit(" KM, przebieg "),
                    thousands("mileage_km"), F.lit(" km."))
    return lst.select(*_KEYS, C.engine_from_description(desc).alias("engine_capacity"),
                      C.power_from_description(desc).alias("power"),
                      C.first_number(F.concat(thousands("mileage_km"), F.lit(" km")), drop=" km")
                      .alias("mileage_km"))


# --- data quality (G17–G23, F3–F5, E13) ---------------------------------------------

from carlot.operators import keys as K  # noqa: E402
from carlot.operators import quality as Q  # noqa: E402
from carlot.operators import replay as R  # noqa: E402
from carlot.operators import scans as SC  # noqa: E402

LISTING_COLUMNS = ["advert_id", "source", "make", "model", "production_year", "price", "currency",
                   "mileage_km", "fuel_type", "transmission", "engine_capacity_cm3", "advert_date"]
DUP_SUBSET = ["make", "model", "production_year", "fuel_type", "transmission", "currency"]
DISTINCT_SUBSET = ["make", "model", "production_year", "fuel_type", "transmission",
                   "engine_capacity_cm3", "currency", "mileage_km", "l_returnflag"]


@query("null_profile")
def q_null_profile(spark, sf):
    return Q.null_profile(listings(spark, sf).select(*LISTING_COLUMNS), top=10)


@query("column_profile")
def q_column_profile(spark, sf):
    return Q.column_profile(listings(spark, sf).select(*LISTING_COLUMNS))


@query("describe_profile")
def q_describe_profile(spark, sf):
    return Q.describe_profile(listings(spark, sf),
                              ["price", "mileage_km", "production_year", "engine_capacity_cm3"])


@query("dedup_full_row")
def q_dedup_full_row(spark, sf):
    return Q.dedup_full_row(listings(spark, sf).select(*DUP_SUBSET))


@query("dup_groups")
def q_dup_groups(spark, sf):
    lst = listings(spark, sf).select("source", "advert_id", "l_partkey", "l_suppkey", "price")
    return Q.duplicate_groups(lst, ["source", "advert_id"])


@query("distinct_by_subset")
def q_distinct_by_subset(spark, sf):
    return Q.distinct_count(listings(spark, sf), DISTINCT_SUBSET)


@query("dup_count")
def q_dup_count(spark, sf):
    return Q.duplicate_count(listings(spark, sf).select(*DUP_SUBSET))


@query("drop_missing")
def q_drop_missing(spark, sf):
    lst = listings(spark, sf).select(*LISTING_COLUMNS, "l_partkey", "l_suppkey")
    return lst.na.drop(subset=["price", "production_year", "fuel_type"])


# --- keys and keyed state (F1, F2, F10, F12, K3) -----------------------------------------

CUTOFF = "2000-01-01"
RUN_TS = "2030-01-01 00:00:00"
_ORDER = ["advert_date", "l_partkey", "l_suppkey", "l_quantity"]


@query("known_key_anti_join")
def q_known_key_anti_join(spark, sf):
    lst = listings(spark, sf)
    known = K.known_keys(lst.where(F.col("advert_date") < F.lit(CUTOFF).cast("timestamp_ntz")))
    return K.new_keys_only(lst, known, ["source", "advert_id"]).select(
        "source", "advert_id", "l_partkey", "l_suppkey", "advert_date")


@query("upsert_latest")
def q_upsert_latest(spark, sf):
    lst = listings(spark, sf).select("source", "advert_id", "price", "make", "model", "production_year",
                                     "mileage_km", *_ORDER)
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    cols = ["price", "make", "model", "production_year", "mileage_km", "advert_date"]
    old = lst.where(F.col("advert_date") < cut)
    target = K.latest_with_history(old, ["source", "advert_id"], _ORDER, "advert_date")
    batch = lst.where(F.col("advert_date") >= cut)
    return K.upsert(target, batch, ["source", "advert_id"], cols,
                    F.lit(RUN_TS).cast("timestamp_ntz"), order_cols=_ORDER)


@query("first_wins_in_page")
def q_first_wins_in_page(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return K.first_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"])


@query("surrogate_ids")
def q_surrogate_ids(spark, sf):
    lst = listings(spark, sf).select("advert_id", "source", *_ORDER)
    return K.surrogate_ids(lst, ["advert_id", "source", *_ORDER], out="local_id").select(
        "advert_id", "source", "l_partkey", "l_suppkey", "local_id")


# --- crawl-log replay (K1, K2, C17, G24) ------------------------------------------------------

MAX_LISTINGS = 30
MAX_PAGES = 20


def crawl_refs(spark, sf):
    """References from the events table: run = user, page = day of month,
    position = event id, id = props.k, detail outcome from the event type."""
    ev = table(spark, sf, "events")
    status = (F.when(F.col("event_type") == "error", 403)
              .when(F.col("event_type") == "signup", 503).otherwise(200))
    refs = ev.select(F.col("user_id").alias("run"), F.dayofmonth("ts").alias("page"),
                     F.col("event_id").alias("pos"),
                     F.get_json_object("props", "$.k").cast("bigint").alias("advert_id"),
                     R.fetch_outcome(status).alias("outcome"))
    refs = K.first_per_key(refs, ["run", "page", "advert_id"], ["pos"])       # F1 in-page first wins
    known = ev.where((F.col("event_type") == "purchase") &
                     (F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))) \
        .select(F.get_json_object("props", "$.k").cast("bigint").alias("advert_id"))
    return refs, known


@query("crawl_replay")
def q_crawl_replay(spark, sf):
    refs, known = crawl_refs(spark, sf)
    return R.replay(refs, known, MAX_LISTINGS, MAX_PAGES)


@query("crawl_stats")
def q_crawl_stats(spark, sf):
    refs, known = crawl_refs(spark, sf)
    return R.run_stats(R.replay(refs, known, MAX_LISTINGS, MAX_PAGES))


# --- equipment star schema (F7–F9, F11, I2) ------------------------------------------------

from carlot.operators import catalogue as CT  # noqa: E402
from carlot.operators import equipment as EQ  # noqa: E402
from carlot.operators import segments as SG  # noqa: E402


def equipment_listings(spark, sf):
    """Parts as listings: the raw equipment string comes from the part name
    words, with case/blank noise, a section header, a repeat and blanks;
    every tenth size has no equipment (NULL)."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    w = F.split("p_name", " ")
    raw = F.concat_ws("|", F.concat(F.lit(" "), F.upper(F.element_at(w, 1)), F.lit(" ")),
                      F.lit("Bezpieczeństwo"), F.element_at(w, -1), F.lit(""), F.lower(F.element_at(w, 1)))
    raw = F.when(F.col("p_size") % 10 == 0, F.lit(None)).otherwise(raw)
    return part.select(F.col("p_partkey").alias("listing_id"), raw.alias("equipment")) \
        .withColumn("equipment_list", EQ.equipment_items("equipment"))


@query("equipment_dim")
def q_equipment_dim(spark, sf):
    return EQ.option_dimension(equipment_listings(spark, sf))


@query("listing_equipment")
def q_listing_equipment(spark, sf):
    lst = equipment_listings(spark, sf)
    return EQ.listing_equipment(lst, EQ.option_dimension(lst))


@query("listing_equipment_view")
def q_listing_equipment_view(spark, sf):
    lst = equipment_listings(spark, sf)
    opts = EQ.option_dimension(lst)
    return EQ.equipment_view(lst, EQ.listing_equipment(lst, opts), opts)


# --- catalogue tagging (C14, F13, F14, D36–D38) -------------------------------------------

def catalogue_from_parts(spark, sf):
    """Distinct (brand, model) pairs of ``part`` in the order in which they
    first appear there, which is not their alphabetical order."""
    cat = table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("model")) \
        .agg(F.min("p_partkey").alias("first_key"))
    return CT.with_order(cat, ["first_key"]).select("brand", "model", "ord")


def titles(spark, sf):
    """Titles of listings; every third names a second make."""
    lst = listings(spark, sf)
    other = F.concat(F.lit("swap Brand#"), (F.col("l_suppkey") % 5 + 1).cast("string"), (F.col("l_partkey") % 5 + 1).cast("string"))
    return lst.select(*_KEYS, F.concat_ws(" ", "make", F.initcap("model"), "p_name",
                                          F.when(F.col("l_linenumber") % 3 == 0, other)).alias("title"))


@query("make_tagging")
def q_make_tagging(spark, sf):
    return CT.tag_make(titles(spark, sf), catalogue_from_parts(spark, sf))


@query("model_tagging")
def q_model_tagging(spark, sf):
    cat = catalogue_from_parts(spark, sf)
    tagged = CT.tag_make(titles(spark, sf), cat)
    return CT.tag_model(tagged, cat).select(*_KEYS, "make", "model")


@query("catalogue_labels")
def q_catalogue_labels(spark, sf):
    part = table(spark, sf, "part")
    labels = part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.col("p_brand"), F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("label"))
    return CT.clean_catalogue_labels(labels).select("label", F.col("name").alias("brand"))


@query("search_urls")
def q_search_urls(spark, sf):
    cat = table(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("model")) \
        .dropDuplicates()
    return cat.select("brand", "model", CT.make_slug("brand").alias("make_slug"),
                      CT.slugify("model").alias("model_slug"),
                      CT.search_url("brand", "model", 2019, 2021).alias("url"))


# --- segment plan (L1) ---------------------------------------------------------------------

#: Listings of a segment at most; at sf0.01 some years fit whole, most cells need ranges.
SEGMENT_LIMIT = 1000


@query("segment_plan")
def q_segment_plan(spark, sf):
    return SG.segment_plan(listings(spark, sf), SEGMENT_LIMIT, ["advert_id", "l_partkey", "l_suppkey"])


# --- landed-page extraction (C1–C17, E1) ---------------------------------------------------

from carlot.operators import extract as X  # noqa: E402
from carlot.sources.render import offer_html  # noqa: E402


@query("offer_roundtrip")
def q_offer_roundtrip(spark, sf):
    # The slim rows are spread before pages are made of them; page text never moves.
    pages = offer_html(listings(spark, sf).repartition("advert_id"))
    rec = X.normalize_listing(X.parse_pages(pages), url="url")
    return rec.select(*_KEYS, "advert_id", "make", "model", "version", "production_year", "price",
                      "currency", "mileage_km", "fuel_type", "transmission", "power_hp", "engine_capacity_cm3",
                      "advert_date", F.array_join("equipment", ", ").alias("equipment"),
                      F.size("raw_parameters").alias("n_params"))


@query("page_parse")
def q_page_parse(spark, sf):
    pages = table(spark, sf, "pages")
    p = X.parse_pages(pages)
    return p.select("page_id", "url", "captcha", "total_pages", F.size("refs").alias("n_refs"),
                    R.fetch_outcome(F.lit(200), captcha=F.col("captcha")).alias("outcome"),
                    F.coalesce("page_advert_id", F.element_at(F.split(
                        F.regexp_replace("url", "/+$", ""), "/"), -1)).alias("advert_id"))


# --- files, sinks and streaming (A2–A4, B1, B7, I1, K4) --------------------------------------

from carlot.session import scratch_path  # noqa: E402
from carlot.sources import files as FL  # noqa: E402
from carlot.sources import sinks as SK  # noqa: E402
from carlot.streaming import ingest as ST  # noqa: E402

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("multi_file_merge")
def q_multi_file_merge(spark, sf):
    """Orders exported as CSV files per status, with differing headers (by the
    status's rank: without the priority column, complete, reordered), scanned
    back through one glob and merged by column name."""
    base = scratch_path(spark, "csv-export")
    orders = table(spark, sf, "orders")
    layouts = [ORDER_COLS[:-1], ORDER_COLS, ORDER_COLS[::-1]]
    ranks = SC.dense_index(orders.select("o_orderstatus").distinct(), ["o_orderstatus"], out="layout", start=0)
    ranked = SC.join_null_safe(orders, ranks, ["o_orderstatus"]).withColumn("layout", F.col("layout") % len(layouts))
    for i, layout in enumerate(layouts):
        SK.write_fixed_csv(ranked.where(F.col("layout") == i).drop("layout"), f"{base}/all_offers_{i}", layout)
    merged = FL.read_raw_csv(spark, f"{base}/all_offers_*", glob="*.csv")
    return merged.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        F.when(F.col("o_orderpriority") == "", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))


#: Files of a micro-batch: a day's events are a file for each task that wrote some.
DAYS_PER_BATCH = 8


def arrivals(events):
    """Events with the day that they arrive on."""
    return events.withColumn("day", F.to_date("ts"))


@query("stream_upsert")
def q_stream_upsert(spark, sf):
    """Events as a file stream of key sightings, some days a micro-batch, landed
    by epoch and merged by key; returns the merged table."""
    events = table(spark, sf, "events")
    source, base = scratch_path(spark, "stream-files"), scratch_path(spark, "stream-table")
    arrivals(events).write.partitionBy("day").parquet(source)
    stream = ST.file_stream(spark, source, arrivals(events).schema, max_files_per_trigger=DAYS_PER_BATCH).drop("day")
    keys, values, order = ["user_id", "event_type"], ["value", "event_id"], ["ts", "event_id"]
    q = ST.run_keyed_ingest(stream, base, keys, values, "ts", order, checkpoint=scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return ST.keyed_table(spark, base, keys, values, order)


# --- text helpers (C2, D39) ------------------------------------------------------------------

from carlot.functions import text as TX  # noqa: E402


@query("page_param_urls")
def q_page_param_urls(spark, sf):
    """D39 over every page URL: the URL of result page 3."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.select("page_id", TX.add_page_param("url", 3).alias("page_url"))


@query("document_text_normalize")
def q_document_text_normalize(spark, sf):
    """C1 + C2 over every document: normalized length and whether NFKC changed it."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    norm = TX.nfkc_normalize_text("text")
    return docs.select("doc_id", F.length(C.normalize_text("text")).alias("n_chars_normalized"),
                       F.length(norm).alias("n_chars_nfkc"),
                       (C.normalize_text("text") != norm).alias("nfkc_changed"))


# --- batch export chain (C-legacy rules -> N3) ------------------------------------------------

from carlot.plans import jobs as J  # noqa: E402
from carlot.sources.render import batch_offer_html  # noqa: E402

BATCH_OUT = ["make", "model", "version", "color", "number_of_doors", "production_year", "fuel_type",
             "engine_capacity_cm3", "power_hp", "transmission", "mileage_km", "accident_free",
             "battery_capacity_kwh", "price", "currency", "price_level", "advert_date", "advert_id", "description"]


@query("batch_export_chain")
def q_batch_export_chain(spark, sf):
    """Offer pages rendered from every listing -> batch-export rows (legacy
    rules) -> clean_batch (units, dates, sentinel dedup, renames, casts)."""
    pages = batch_offer_html(listings(spark, sf).repartition("advert_id"))
    raw = X.parse_batch_pages(pages, with_captcha=False).select(*X.BATCH_COLUMNS)
    typed, _ = J.clean_batch(raw)
    items = F.array_join(F.array_sort(EQ.equipment_items("equipment")), "|")
    return typed.select(*BATCH_OUT, items.alias("equipment_items"))


# --- operators the queries above don't reach -------------------------------------------------

def spec_text(spark, sf):
    """Raw text of the remaining unit measures, with wrong units on lines 6 and 7."""
    lst = listings(spark, sf)
    size, qty = F.col("p_size").cast("string"), F.col("l_quantity").cast("int").cast("string")
    ln = F.col("l_linenumber")
    return lst.select(
        *_KEYS, F.concat(qty, F.when(ln == 7, " mil").otherwise(" km")).alias("Autonomia"),
        F.concat(size, F.lit(" g/km")).alias("Emisja CO2"), F.concat(size, F.lit(".5 l/100km")).alias("Spalanie W Mieście"),
        F.concat(size, F.lit(" l/100 km")).alias("Spalanie Poza Miastem"),
        F.concat(size, F.lit(".25 kWh/100km")).alias("Średnie zużycie"),
        F.when(ln > 1, F.concat((ln + 90).cast("string"), F.lit(" %"))).alias("Kondycja baterii"),
        F.concat(size, F.when(ln == 6, " KM").otherwise(" HP")).alias("Elektryczna moc maksymalna HP"))


@query("unit_measures_rest")
def q_unit_measures_rest(spark, sf):
    """The other measures, bad units to NULL."""
    return MS.clean_measures(spec_text(spark, sf), parity=True)


@query("unit_rejects")
def q_unit_rejects(spark, sf):
    """K5: the rows whose unit is not allowed."""
    return MS.unit_violations(spec_text(spark, sf), _KEYS, parity=True)


@query("median_hot_group")
def q_median_hot_group(spark, sf):
    """Exact quartiles where one group holds most rows and few distinct values."""
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, "hot").otherwise(F.col("l_returnflag")).alias("grp"), "l_quantity")
    return SC.aggregate_with_percentiles(li, ["grp"], [F.count(F.lit(1)).alias("n")], ["l_quantity"], (0.25, 0.5, 0.75))


@query("config_labels")
def q_config_labels(spark, sf):
    """Long configuration and make-model labels, counted."""
    lst = listings(spark, sf)
    return lst.groupBy(C.long_config("engine_capacity_cm3", "fuel_type", "transmission").alias("config_long"),
                       C.model_label("make", "model").alias("model_label")).agg(F.count(F.lit(1)).alias("listings"))


@query("scrape_dates")
def q_scrape_dates(spark, sf):
    """The scrape-date stamp of every order date."""
    return table(spark, sf, "orders").select("o_orderkey", C.scrape_date_stamp("o_orderdate").alias("scrape_date"))


@query("coercion_report")
def q_coercion_report(spark, sf):
    """Values that don't convert, per column."""
    orders = table(spark, sf, "orders")
    text = (F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderpriority")).when(F.col("o_orderkey") % 11 == 0, F.lit(""))
            .otherwise(F.col("o_totalprice").cast("string")))
    df = orders.select(text.alias("price_text"), F.col("o_custkey").cast("string").alias("customer_text"))
    return Q.coerce_failures(df, {"price_text": "double", "customer_text": "bigint"})


@query("numeric_profile")
def q_numeric_profile(spark, sf):
    """The numeric columns, found by type, profiled."""
    lst = listings(spark, sf).select(*LISTING_COLUMNS)
    return Q.column_profile(lst, Q.columns_by_kind(lst, "numeric"), distinct=False)


@query("segment_files")
def q_segment_files(spark, sf):
    """L2: listings written by segment, one folder each, and counted from there."""
    lst = listings(spark, sf).select(SG.YEAR, SG.GEARBOX, "advert_id", "l_partkey", "l_suppkey")
    tagged = SG.assign_segments(lst, SEGMENT_LIMIT, ["advert_id", "l_partkey", "l_suppkey"])
    path = scratch_path(spark, "segments")
    SK.write_segments(tagged.select("segment", "advert_id"), path)
    return spark.read.parquet(path).groupBy("segment").agg(F.count(F.lit(1)).alias("listings"))


@query("text_normalize")
def q_text_normalize(spark, sf):
    """C1 over every document."""
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.sha2(F.encode(C.normalize_text("text"), "UTF-8"), 256).alias("text_sha256"))


@query("clean_titles")
def q_clean_titles(spark, sf):
    """Two exports with differing columns -> typed listings tagged from the catalogue."""
    lst = listings(spark, sf)
    key = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000000 + F.col("l_partkey") * 1000 + F.col("l_suppkey") % 1000
    rows = lst.select(
        "l_linenumber", key.cast("string").alias("ID"), C.model_label("make", F.initcap("model")).alias("Title"),
        F.concat(F.lit("Silnik "), thousands("engine_capacity_cm3"), F.lit("cm3, "), F.col("p_size"), F.lit(" KM")).alias("Description"),
        F.concat(thousands("mileage_km"), F.lit(" km")).alias("Mileage"), F.col("transmission").alias("Gearbox"),
        F.col("production_year").cast("string").alias("Year"), F.lit("Kraków (Małopolskie)").alias("Location"),
        F.concat(thousands(F.floor("price")), F.lit(" PLN")).alias("Price"))
    a = rows.where("l_linenumber % 2 = 0").drop("l_linenumber").withColumn("Seller Type", F.lit("Dealer"))
    b = rows.where("l_linenumber % 2 = 1").drop("l_linenumber")
    df, _ = J.clean_titles([a, b], catalogue_from_parts(spark, sf), run_date="2026-02-01")
    return df.select("ID", "Make", "Model", F.col("Mileage in km").alias("mileage_km"), "Price", "Year",
                     F.col("Engine capacity").alias("engine_capacity"), "Power", F.col("Seller Type").alias("seller_type"),
                     "City", "Province", F.col("Scraping Date").alias("scraping_date"))


from carlot.plans import table_queries  # noqa: E402, F401
