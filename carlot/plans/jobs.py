"""Composite jobs (N1–N6): the operators a user of the source application
called, each a chain of carlot operators over DataFrames.

* ``ingest``        N1: captured crawl pages -> keyed listing table + run stats + rejects
* ``parse_offers``  N2: offer pages -> normalized records (no key state)
* ``clean_batch``   N3: raw CSV export -> listings, equipment options, bridge
* ``clean_titles``  N4: older CSV exports + catalogue -> tagged, typed listings
* ``market_report`` N5: the example report's four tables
* ``eda``           N6: the analysis notebook's tables
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.functions import clean as C
from carlot.functions import measures as MS
from carlot.operators import catalogue as CT
from carlot.operators import equipment as EQ
from carlot.operators import extract as X
from carlot.operators import keys as K
from carlot.operators import market as M
from carlot.operators import quality as Q
from carlot.operators import replay as R
from carlot.operators.scans import dense_index
from carlot.schemas import CAST_SPEC, DATE_SPEC, RENAME_MAP, UPSERT_COLUMNS
from carlot.session import stored


@dataclass(frozen=True)
class IngestConfig:
    max_pages: int = 2
    max_listings: int = 30
    source: str = "site"
    base_url: str = "https://listings.example"
    run_ts: str = "1970-01-01 00:00:00"


def _outcome(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("outcome", R.fetch_outcome(F.col("status_code"), F.col("retry_after"),
                                                        F.col("captcha")))


def ingest(result_pages: DataFrame, detail_pages: DataFrame, target: DataFrame | None,
           cfg: IngestConfig = IngestConfig()):
    """Replay captured crawls into the keyed listing table.

    The runs of one call are crawls of one moment: none sees what another
    saved. A later run belongs in a later call, with the new table as target.

    ``result_pages``: (run, page, url, html, status_code, retry_after);
    ``detail_pages``: (url, html, status_code, retry_after);
    ``target``: the current table (columns of ``schemas.LISTING_SCHEMA`` plus
    first/last seen), or None.
    Returns ``(new_table, stats, rejects)``; write ``new_table`` to a folder of
    its own, never over the one ``target`` reads.
    """
    spark = result_pages.sparkSession
    run_ts = F.lit(cfg.run_ts).cast("timestamp")
    # C17 on result pages; total pages from page 1, capped (K2).
    rp = _outcome(X.parse_pages(result_pages, base_url=cfg.base_url))
    first = rp.where(F.col("page") == 1).select("run", F.least(F.col("total_pages"), F.lit(cfg.max_pages))
                                                 .alias("n_pages"))
    rp = rp.join(first, "run").where(F.col("page") <= F.col("n_pages"))
    # A blocked or failed result page stops the run before any listing.
    gate = (rp.where(F.col("outcome") != "ok").groupBy("run")
            .agg(F.min_by("outcome", "page").alias("gate_reason")))
    ok_pages = rp.join(gate, "run", "left_anti")
    refs = ok_pages.select("run", "page", F.posexplode("refs").alias("pos", "ref")).select(
        "run", "page", "pos", F.col("ref.advert_id").alias("advert_id"), F.col("ref.url").alias("url"))
    known = (K.known_keys(target, cfg.source).select("advert_id") if target is not None
             else spark.createDataFrame([], "advert_id string"))
    # Only references that are not known need their detail page: filter
    # BEFORE the Python parse (Catalyst cannot push through it).
    need = refs.join(known, "advert_id", "left_anti").select("url").distinct()
    details = X.parse_pages(detail_pages.join(need, "url", "left_semi"), base_url=cfg.base_url)
    details = _outcome(details)
    recs = X.normalize_listing(details, url="url", source=cfg.source)
    recs = recs.withColumn("outcome", F.when((F.col("outcome") == "ok") & F.col("advert_date_rejected"),
                                             F.lit("ParseError")).otherwise(F.col("outcome")))
    # A detail page captured more than once counts once: a good capture first.
    rest = [c for c in recs.columns if c != "url"]
    best = F.min_by(F.struct(*rest), F.struct(F.col("outcome") != "ok", F.col("price"), F.col("advert_id")))
    recs = recs.groupBy("url").agg(best.alias("__r")).select("url", "__r.*")
    by_url = recs.select("url", "outcome")
    r = refs.join(by_url, "url", "left").withColumn("outcome", F.coalesce("outcome", F.lit("FetchFailed")))
    classified = R.replay(r.select("run", "page", "pos", "advert_id", "outcome"), known, cfg.max_listings)
    stats = R.run_stats(classified)
    gated = gate.select("run", F.lit(0).cast("bigint").alias("pages_visited"),
                        *[F.lit(0).cast("bigint").alias(c) for c in
                          ("listings_found", "new_listings", "skipped_duplicates", "parse_errors", "saved_records")],
                        F.col("gate_reason").alias("stopped_reason"))
    stats = stats.unionByName(gated)
    saved = (classified.where(F.col("action") == "saved").join(refs.select("run", "page", "pos", "url"),
                                                              ["run", "page", "pos"]))
    rows = (saved.select("run", "page", "pos", F.col("advert_id").alias("ref_advert_id"), "url")
            .join(recs.drop("outcome"), "url"))
    batch = rows.select(F.col("ref_advert_id").alias("advert_id"), F.col("advert_id").alias("page_advert_id"),
                        *[c for c in recs.columns if c in UPSERT_COLUMNS or c == "source"],
                        F.struct("run", "page", "pos").alias("__seq"))
    cols = [c for c in UPSERT_COLUMNS if c in batch.columns]
    if target is None:
        target = spark.createDataFrame([], batch.drop("__seq", "page_advert_id").schema.add(
            "first_seen_at", "timestamp").add("last_seen_at", "timestamp"))
    new_table = K.upsert(target, batch, ["source", "advert_id"], cols, run_ts, order_cols=["__seq"])
    rejects = (classified.where(F.col("action") == "parse_error").select("run", "page", "pos", "advert_id",
                                                                         F.col("outcome").alias("reason"))
               .unionByName(rows.where(F.col("ref_advert_id") != F.col("advert_id")).select(
                   "run", "page", "pos", F.col("ref_advert_id").alias("advert_id"),
                   F.concat(F.lit("page id "), F.col("advert_id")).alias("reason"))))
    return new_table, stats, rejects


def parse_offers(pages: DataFrame, url: str = "url", source: str = "site", scraped_at=None,
                 base_url: str = "https://listings.example") -> DataFrame:
    """Offer pages -> normalized records."""
    return X.normalize_listing(X.parse_pages(pages, base_url=base_url), url=url, source=source,
                               scraped_at=scraped_at)


def clean_batch(raw: DataFrame, parity: bool = True) -> tuple[DataFrame, DataFrame]:
    """N3, first half: raw 44-column CSV export -> (typed rows, missing columns).

    Unit measures (lenient: bad units -> NULL, see ``unit_violations``),
    price and date parsing, sentinel-folding full-row dedup, renaming, Tak/Nie
    booleans, the full cast spec. One pass and one dedup shuffle; ids and the
    equipment tables are steps of their own (``number_listings``, ``star_tables``).
    """
    df = MS.clean_measures(raw, parity=parity, mode="lenient")
    if "price" in df.columns:
        df = df.withColumn("price", C.legacy_price("price"))
    if "advert_date" in df.columns:
        df = df.withColumn("advert_date", C.month_replace_date("advert_date"))
    df = Q.dedup_full_row(df)
    df = df.withColumnsRenamed({k: v for k, v in RENAME_MAP.items() if k in df.columns})
    missing = Q.schema_gaps(df, {**CAST_SPEC, **DATE_SPEC})
    casts = {}
    for c, t in CAST_SPEC.items():
        if c not in df.columns:
            continue
        text = F.col(c).cast("string")
        if t == "boolean":
            casts[c] = C.tak_nie(c)
        elif t == "float":
            casts[c] = text.try_cast("double").cast("float")
        elif t != "string":
            casts[c] = text.try_cast(t)
    if "first_registration_date" in df.columns:
        casts["first_registration_date"] = C.any_date("first_registration_date")
    return df.withColumns(casts), missing


def number_listings(typed: DataFrame) -> DataFrame:
    """Consecutive ``local_id`` in the order of all columns."""
    return dense_index(typed, [c for c in typed.columns if c != "equipment"], out="local_id", start=1)


def star_tables(numbered: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """N3, second half: numbered rows -> (listings, equipment_options,
    listing_equipment)."""
    # the lists are made once, for the options and the bridge
    items = stored(numbered.select("local_id", EQ.equipment_items("equipment").alias("equipment_list")), "equipment-items")
    options = EQ.option_dimension(items)
    return numbered.drop("equipment"), options, EQ.listing_equipment(items, options, listing_id="local_id")


def clean_titles(frames: list[DataFrame], catalogue: DataFrame, row_id: str = "ID",
                 run_date: str = "1970-01-01"):
    """Older CSV exports (ID, Title, Link, Description, Mileage, Fuel Type,
    Gearbox, Year, Location, Seller Type, Price) -> typed, tagged listings and
    the per-column invalid-value report."""
    from carlot.sources.files import union_frames
    df = union_frames(frames).na.drop(subset=["Mileage", "Price", "Gearbox"])
    df = df.withColumnRenamed("Mileage", "Mileage in km")
    df = df.withColumn("Mileage in km", C.first_number("Mileage in km", drop=" km")) \
        .withColumn("Price", C.first_number("Price")) \
        .withColumn("Scraping Date", C.scrape_date_stamp(F.lit(run_date)))
    df = CT.tag_make(df, catalogue, title="Title", out="Make")
    df = CT.tag_model(df, catalogue, title="Title", make="Make", out="Model")
    df = df.withColumn("Engine capacity", C.engine_from_description("Description")) \
        .withColumn("Power", C.power_from_description("Description"))
    numeric = {c: "double" for c in (row_id, "Mileage in km", "Year", "Price", "Engine capacity", "Power")
               if c in df.columns}
    report = Q.coerce_failures(df, numeric)
    for c in numeric:
        df = df.withColumn(c, C.coerce_numeric(c))
    for c in [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]:
        df = df.withColumn(c, C.nullify_blank(c))
    if "Location" in df.columns:
        df = df.withColumn("City", C.city("Location")).withColumn("Province", C.province("Location")) \
            .drop("Location")
    return df, report


def market_report(listings: DataFrame) -> dict[str, DataFrame]:
    """The example report (A8 scan, G1–G4), each table sorted for display."""
    return {
        "median_price_by_year": M.median_price_by_year(listings).orderBy("production_year"),
        "avg_price_by_fuel": M.avg_price_by_fuel(listings).orderBy("fuel_type"),
        "offers_by_make_model": M.offers_by_make_model(listings).orderBy(F.desc("offers"), "make", "model"),
        "avg_price_by_mileage_band": M.avg_price_by_mileage_band(listings).orderBy("mileage_band"),
    }


def eda(listings: DataFrame, op: str = "multiply") -> dict[str, DataFrame]:
    """The analysis notebook's tables over PLN prices (D28 first)."""
    pln = M.in_pln(listings, op=op)
    return {
        "describe": Q.describe_profile(pln),
        "null_top10": Q.null_profile(pln),
        "duplicates": Q.duplicate_count(pln),
        "age_bands": M.age_band_profile(pln),
        "mileage_by_year": M.mileage_usage_by_year(pln),
        "fuel_counts": M.fuel_counts_pivot(pln),
        "fuel_shares": M.fuel_share_by_year(pln),
        "top_models": M.top_models_vs_market(pln),
        "top3_configs": M.top3_config_prices(pln),
        "depreciation": M.depreciation_curve(pln),
        "gearbox": M.gearbox_prices(pln),
        "gearbox_premium": M.gearbox_premium(pln),
    }
