"""Queries over tables that the library writes and reads back: keyed upserts,
streams with state, growing dimensions, landed pages, parameter maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from carlot.operators import bands as B
from carlot.operators import equipment as EQ
from carlot.operators import keys as K
from carlot.operators import quality as Q
from carlot.plans import jobs as J
from carlot.plans.queries import (_ORDER, CUTOFF, DAYS_PER_BATCH, LISTING_COLUMNS, arrivals, catalogue_from_parts,
                                  equipment_listings, query)
from carlot.session import scratch_path, stored
from carlot.sources import files as FL
from carlot.sources import keyed as KT
from carlot.sources import sinks as SK
from carlot.sources.render import thousands
from carlot.sources.tables import listings, table
from carlot.streaming import ingest as ST

# --- keyed tables (B7, F12, A10) ------------------------------------------------------

BUCKETS = 16
UPSERT_VALUES = ["price", "make", "model", "mileage_km", "advert_date"]
BATCHES = [("src0", "2030-01-01 00:00:00"), ("src2", "2030-01-02 00:00:00")]


@query("keyed_upsert")
def q_keyed_upsert(spark, sf):
    """A keyed table by source and hash bucket; two batches, one of each of
    two sources, replace the buckets they touch; the third source's files stay."""
    lst = listings(spark, sf).select("source", "advert_id", "price", "make", "model", "mileage_km", *_ORDER)
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    keys = ["source", "advert_id"]
    old = K.latest_with_history(lst.where(F.col("advert_date") < cut), keys, _ORDER, "advert_date", keep=UPSERT_VALUES)
    path = scratch_path(spark, "keyed-listings")
    KT.write_keyed(old.select(*keys, *UPSERT_VALUES, "first_seen_at", "last_seen_at"), path, keys, BUCKETS, ["source"])
    for source, run in BATCHES:
        batch = lst.where((F.col("advert_date") >= cut) & (F.col("source") == source))
        KT.upsert_keyed(spark, path, batch, keys, UPSERT_VALUES, F.lit(run).cast("timestamp_ntz"), BUCKETS, ["source"], _ORDER)
    return KT.read_keyed(spark, path).drop(KT.BUCKET)


# --- streams with state (K4) --------------------------------------------------------------

@query("stream_new_keys")
def q_stream_new_keys(spark, sf):
    """K4: events as a stream that drops repeated sightings within a watermark and
    keys that are known already; epochs are compacted between two runs, the second
    of which finds more files, some of them repeating the first's."""
    events = table(spark, sf, "events")
    source, base, ckpt = (scratch_path(spark, f"stream-{x}") for x in ("arrivals", "keyed", "state"))
    keys, values, order = ["user_id", "event_type"], ["value", "event_id"], ["ts", "event_id"]
    known = events.where(F.col("event_type") == "purchase").where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    day = F.dayofmonth("ts")
    for part in (day <= 20, day >= 18):
        arrivals(events.where(part)).write.mode("append").partitionBy("day").parquet(source)
        stream = ST.file_stream(spark, source, arrivals(events).schema, max_files_per_trigger=DAYS_PER_BATCH).drop("day")
        ST.run_keyed_ingest(stream, base, keys, values, "ts", order, watermark="60 days", checkpoint=ckpt, known=known).awaitTermination()
        ST.compact_epochs(spark, base, keys, values, order)
    return ST.keyed_table(spark, base, keys, values, order)


# --- growing dimensions (F7, F9-F11) -----------------------------------------------------------

def _grown(spark, sf):
    lst = stored(equipment_listings(spark, sf), "equipped")
    half = lst.where(F.col("listing_id") % 2 == 1)
    options = stored(EQ.option_dimension(half).select("id", "name"), "options")
    bridge = stored(EQ.listing_equipment(half, options), "bridge")
    grown = stored(EQ.grow_options(options, lst), "options-grown")
    return options, grown, bridge, EQ.grow_bridge(bridge, grown, lst), lst


@query("equipment_dim_grown")
def q_equipment_dim_grown(spark, sf):
    """options of half of the listings, then of all: old ids stay."""
    options, grown, *_ = _grown(spark, sf)
    return grown.join(options.select("id", F.lit(True).alias("old")), "id", "left").select(
        "id", "name", F.coalesce("old", F.lit(False)).alias("old"))


@query("listing_equipment_grown")
def q_listing_equipment_grown(spark, sf):
    """bridge rows appended for the rest, and the view over both."""
    _, grown, bridge, more, lst = _grown(spark, sf)
    return EQ.equipment_view(lst, bridge.unionByName(more), grown)


# --- checks of written tables (B3, B4, B5, I3) --------------------------------------------------

ORDER_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("table_fingerprints")
def q_table_fingerprints(spark, sf):
    """A table and its read-back have one checksum of all rows; with one
    column changed in some rows they differ in so many rows."""
    orders = table(spark, sf, "orders").select(*ORDER_TEXT)
    back = SK.write_checked(orders, scratch_path(spark, "orders-checked"), ["o_orderstatus"])
    other = back.withColumn("o_custkey", F.when(F.col("o_orderkey") % 100 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    diff = Q.table_diff(orders, other).agg(F.count_if(F.col("side") == "left").alias("only_left"), F.count_if(F.col("side") == "right").alias("only_right"))
    rows = [Q.table_fingerprint(d, ORDER_TEXT).withColumn("version", F.lit(n)) for d, n in ((orders, "written"), (back, "read"), (other, "changed"))]
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return out.withColumn("one", F.lit(1)).join(diff.withColumn("one", F.lit(1)), "one").drop("one")


@query("star_read_back")
def q_star_read_back(spark, sf):
    """The star schema written and read back as the view."""
    base = scratch_path(spark, "star")
    lst = equipment_listings(spark, sf)
    options = EQ.option_dimension(lst)
    SK.write_star(lst.drop("equipment_list"), options, EQ.listing_equipment(lst, options), base)
    read = lambda t: spark.read.parquet(f"{base}/{t}")
    return EQ.equipment_view(read("listings"), read("listing_equipment"), read("equipment_options"))


@query("merged_exports")
def q_merged_exports(spark, sf):
    """Exports numbered by region, one number missing, united by column name."""
    base = scratch_path(spark, "numbered")
    cust = table(spark, sf, "customer").withColumn("n", F.col("c_nationkey") % 3)
    for i in (0, 1, 3):
        cols = ["c_custkey", "c_name"] + (["c_mktsegment"] if i else [])
        SK.write_fixed_csv(cust.where(F.col("n") == i % 3).select(*cols) if i < 3 else cust.where("false").select(*cols), f"{base}/part_{i}", cols)
    import warnings
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = FL.read_numbered_csv(spark, base + "/part_{}/*.csv", range(4), ["c_custkey", "c_name", "c_mktsegment"])
    out = base + "/merged"
    SK.write_merged([df], out, ["c_custkey", "c_name", "c_mktsegment"])
    back = FL.read_raw_csv(spark, out, glob="*.csv")
    return back.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment")


# --- landed pages and parameter maps (A1, B6, B10, E1) ---------------------------------------------

@query("pruned_pages")
def q_pruned_pages(spark, sf):
    """Pages landed by run date; the runs of one weekday prune the folders read."""
    pages = table(spark, sf, "pages").withColumn("run_date", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 28).cast("int")))
    path = scratch_path(spark, "landed")
    SK.write_pages(pages, path)
    runs = stored(pages.select("run_date").distinct().withColumn("weekday", F.dayofweek("run_date")), "runs")
    return FL.read_run_pages(spark, path, runs.where("weekday = 2")).select(
        "page_id", F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), F.char_length("html").alias("chars"))


@query("raw_parameters")
def q_raw_parameters(spark, sf):
    """Events with their raw parameter map as JSON lines, read back as a
    VARIANT; a parameter by name and kind."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "props")
    path = scratch_path(spark, "raw-params")
    SK.write_params(ev, path, "props")
    back = FL.read_params(spark, path, "event_id bigint, event_type string", "props")
    return back.select("event_id", "event_type", FL.param("props", "k", "bigint").alias("k"),
                       FL.param("props", "k", "string").alias("k_text"), FL.param("props", "absent", "string").alias("absent"))


@query("raw_parameter_kinds")
def q_raw_parameter_kinds(spark, sf):
    """The schema of all parameter maps, for each event type."""
    ev = table(spark, sf, "events").select("event_type", F.try_parse_json("props").alias("props"))
    return ev.groupBy("event_type").agg(F.schema_of_variant_agg("props").alias("kinds"), F.count("props").alias("maps"))


# --- bands as a table (D30, D31) ----------------------------------------------------------------------

@query("mileage_bands")
def q_mileage_bands(spark, sf):
    """Mileages in a band for each part size, of differing widths and overlapping."""
    size = table(spark, sf, "part").select(F.col("p_size").cast("int").alias("size")).distinct()
    bands = size.select(F.col("size").alias("band"), (F.col("size") * 4000).alias("low"),
                        (F.col("size") * 4000 + 3000 + F.col("size") * 100).alias("high"))
    lst = listings(spark, sf).select("advert_id", "mileage_km", "price")
    return B.in_bands(lst, "mileage_km", bands).groupBy("band").agg(
        F.count(F.lit(1)).alias("listings"), F.min("mileage_km").alias("least"), F.max("mileage_km").alias("most"),
        F.count("price").alias("priced"))


# --- key lists and catalogues as files (A5-A7, B2, B11, F16) ----------------------------------------------

@query("seen_ids_file")
def q_seen_ids_file(spark, sf):
    """Ids appended in two overlapping batches, each once, and read as a key file."""
    path, csv = scratch_path(spark, "seen"), scratch_path(spark, "seen-csv")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("advert_id"), "o_orderkey")
    SK.append_keys(orders.where("o_orderkey % 3 < 2").select("advert_id"), path)
    SK.append_keys(orders.where("o_orderkey % 3 > 0").select("advert_id"), path)
    SK.write_fixed_csv(spark.read.parquet(path), csv, ["advert_id"])
    seen = FL.read_seen_ids(spark, csv).where("advert_id <> 'advert_id'")            # the files' headers
    return seen.groupBy(F.length("advert_id").alias("digits")).agg(
        F.count(F.lit(1)).alias("ids"), F.sum(F.col("advert_id").cast("bigint")).alias("id_sum"))


@query("catalogue_file")
def q_catalogue_file(spark, sf):
    """The catalogue and its make list as files, read back in order."""
    path, names = scratch_path(spark, "catalogue"), scratch_path(spark, "makes")
    cat = stored(catalogue_from_parts(spark, sf), "catalogue-rows")
    SK.write_catalogue(cat, path)
    SK.write_name_list(cat.select("brand").distinct(), names, "brand")
    makes = FL.read_name_list(spark, names)
    back = FL.read_catalogue(spark, path)
    return back.join(makes, back.brand == makes.name).select("brand", "model", "ord")


# --- clean_batch as a whole (N3, E15, D23) ----------------------------------------------------------------

def raw_export(spark, sf):
    """Raw export rows of every listing, with the export's labels."""
    lst = listings(spark, sf)
    size = F.col("p_size").cast("string")
    w = F.split("p_name", " ")
    return lst.select(
        F.col("advert_id").cast("string").alias("advert_id"), F.col("make").alias("Marka pojazdu"), F.col("model").alias("Model pojazdu"),
        F.col("production_year").cast("string").alias("Rok produkcji"), F.col("fuel_type").alias("Rodzaj paliwa"),
        F.concat(thousands("engine_capacity_cm3"), F.lit(" cm3")).alias("Pojemność skokowa"),
        F.concat(size, F.lit(" KM")).alias("Moc"), F.concat(thousands("mileage_km"), F.lit(" km")).alias("Przebieg"),
        F.when(F.col("l_linestatus") == "F", "Tak").otherwise("Nie").alias("Bezwypadkowy"),
        F.date_format("advert_date", "yyyy-MM-dd").alias("Data pierwszej rejestracji w historii pojazdu"),
        F.concat(F.floor("price").cast("string"), F.lit("")).alias("price"), F.col("currency"),
        F.concat_ws("|", F.upper(F.element_at(w, 1)), F.lit("Bezpieczeństwo"), F.element_at(w, -1)).alias("equipment"))


@query("clean_batch_star")
def q_clean_batch_star(spark, sf):
    """A raw export cleaned, numbered and split into the star schema; the
    listings with their options from the bridge."""
    typed, _ = J.clean_batch(raw_export(spark, sf))
    numbered = stored(J.number_listings(typed), "numbered")
    lst, options, bridge = J.star_tables(numbered)
    view = EQ.equipment_view(numbered, bridge, options, "local_id").withColumnRenamed("listing_id", "local_id")
    return lst.join(view, "local_id").select(
        "advert_id", "make", "model", "production_year", "engine_capacity_cm3", "power_hp", "mileage_km",
        "accident_free", F.date_format("first_registration_date", "yyyy-MM-dd").alias("first_registration"), "price", "equipment")


@query("clean_batch_gaps")
def q_clean_batch_gaps(spark, sf):
    """The expected columns that the export lacks, with their listings."""
    typed, missing = J.clean_batch(raw_export(spark, sf))
    n = typed.agg(F.count(F.lit(1)).alias("listings"))                               # one row
    return missing.withColumn("one", F.lit(1)).join(n.withColumn("one", F.lit(1)), "one").drop("one")


# --- mergeable profiles (G18-G20) -----------------------------------------------------------------------------

@query("profile_by_source")
def q_profile_by_source(spark, sf):
    """Sketches of each source stored and united; exact counts, and whether
    the estimate of distinct values is within five deviations of the exact one."""
    lst = listings(spark, sf).select(*LISTING_COLUMNS)
    sketches = stored(Q.profile_sketches(lst, by=["source"]), "sketches")
    merged = Q.merge_profiles(sketches).withColumnRenamed("n_distinct", "estimate")
    exact = Q.column_profile(lst, [c for c in LISTING_COLUMNS if c != "source"]).select("column_name", "n_distinct")
    near = F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.08 * F.col("n_distinct")
    return merged.join(exact, "column_name").select("column_name", "rows", "non_null", "nulls", "n_distinct", near.alias("estimate_near"))
