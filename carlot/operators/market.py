"""Market analytics over a listings DataFrame (price, year, make, model, ...).

Every aggregate is a ``groupBy`` with map-side partial aggregation; medians go
through ``grouped_median`` (exact and distributed by default). Group keys
follow the source rules: the example report maps NULL text keys to
'unknown' and drops NULL/0 years; the notebook aggregates drop NULL keys
(pandas ``groupby``); the README SQL keeps NULL groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carlot.functions import clean as C
from carlot.operators.scans import aggregate_with_medians, dense_index, grouped_median
from carlot.operators.stats import money_mean
from carlot.schemas import AGE_BANDS, REFERENCE_YEAR
from carlot.session import stored


def _round(c, n=4):
    return F.round(F.col(c), n).alias(c)


# --- example report (N5) -------------------------------------------------------

def priced(listings: DataFrame) -> DataFrame:
    """The report's scan: listings with a price (projection pushed to the scan)."""
    return listings.where(F.col("price").isNotNull())


def median_price_by_year(listings: DataFrame) -> DataFrame:
    """G1: median price per production year; NULL and 0 years dropped."""
    base = priced(listings).where(F.col("production_year").isNotNull() & (F.col("production_year") != 0)) \
        .select("production_year", "price")
    out = aggregate_with_medians(base, ["production_year"], [F.count(F.lit(1)).alias("listings")], ["price"])
    return out.select("production_year", "listings", _round("median_price"))


def avg_price_by_fuel(listings: DataFrame) -> DataFrame:
    """Mean price per fuel type, NULL/'' fuel -> 'unknown'."""
    return (priced(listings).groupBy(C.unknown_if_blank("fuel_type").alias("fuel_type"))
            .agg(money_mean("price").alias("avg_price"), F.count(F.lit(1)).alias("listings")))


def offers_by_make_model(listings: DataFrame) -> DataFrame:
    """Offer count per make and model (report keys 'unknown')."""
    return (priced(listings)
            .groupBy(C.unknown_if_blank("make").alias("make"), C.unknown_if_blank("model").alias("model"))
            .agg(F.count(F.lit(1)).alias("offers")))


def avg_price_by_mileage_band(listings: DataFrame, width: int = 50000) -> DataFrame:
    """Mean price per 50,000 km band."""
    return (priced(listings).where(F.col("mileage_km").isNotNull())
            .groupBy(C.mileage_band("mileage_km", width).alias("mileage_band"))
            .agg(money_mean("price").alias("avg_price"), F.count(F.lit(1)).alias("listings")))


def offers_avg_by_year(listings: DataFrame) -> DataFrame:
    """README SQL, COUNT(*) and AVG(price) per year, NULL year kept."""
    return listings.groupBy("production_year").agg(
        F.count(F.lit(1)).alias("offers"), money_mean("price").alias("avg_price"))


# --- notebook analytics (N6) ------------------------------------------------------

def in_pln(listings: DataFrame, op: str = "multiply", rates: dict | None = None) -> DataFrame:
    """Price converted to PLN and rounded; currency becomes 'PLN'."""
    return listings.withColumn("price", C.to_pln("price", "currency", op, rates)) \
        .withColumn("currency", F.lit("PLN"))


def age_band_profile(listings: DataFrame, bands=AGE_BANDS, reference_year: int = REFERENCE_YEAR) -> DataFrame:
    """Median price, median mileage and count per age band; every band
    appears even when empty (count 0, medians NULL)."""
    spark = listings.sparkSession
    band_tbl = spark.createDataFrame([(lbl, i) for i, (_, _, lbl) in enumerate(bands)],
                                     "age_group string, band_order int")
    base = listings.select(C.age_band(C.age("production_year", reference_year), bands).alias("age_group"),
                           "price", "mileage_km").where(F.col("age_group").isNotNull())
    agg = aggregate_with_medians(base, ["age_group"], [F.count(F.lit(1)).alias("listings")], ["price", "mileage_km"])
    # Band table: five literal rows, a proven size bound for the broadcast.
    return (F.broadcast(band_tbl).join(agg, "age_group", "left")
            .select("age_group", "band_order",
                    F.coalesce("listings", F.lit(0)).cast("bigint").alias("listings"),
                    _round("median_price"), _round("median_mileage_km")))


def mileage_usage_by_year(listings: DataFrame, reference_year: int = REFERENCE_YEAR) -> DataFrame:
    """Median and mean mileage per year, km per year and month."""
    base = listings.where(F.col("production_year").isNotNull()).select("production_year", "mileage_km")
    out = aggregate_with_medians(base, ["production_year"], [F.avg(F.col("mileage_km").cast("double")).alias("mean_mileage")],
                       ["mileage_km"])
    annual = C.usage_per_year("median_mileage_km", "production_year", reference_year)
    return out.select(
        "production_year", _round("median_mileage_km"), "mean_mileage",
        annual.alias("avg_annual_km"), F.rint(annual / 12).alias("avg_monthly_km"),
        C.age("production_year", reference_year).alias("age"))


FUELS = ("Benzyna", "Diesel", "Benzyna+LPG", "Hybryda", "Elektryczny", "Hybryda Plug-in")


def fuel_column(f: str) -> str:
    return "n_" + "".join(ch if ch.isalnum() else "_" for ch in f.lower())


def fuel_counts(listings: DataFrame) -> DataFrame:
    """G10, long form: a row (year, fuel, listings) for every year and fuel that
    occur, 0 where a fuel is absent in a year."""
    base = listings.where(F.col("production_year").isNotNull() & F.col("fuel_type").isNotNull())
    n = base.groupBy("production_year", "fuel_type").agg(F.count(F.lit(1)).alias("listings"))
    n = stored(n, "fuel-counts")
    years = stored(dense_index(n.select("production_year").distinct(), ["production_year"], out="__y", start=0), "years")
    fuels = stored(dense_index(n.select("fuel_type").distinct(), ["fuel_type"], out="__f", start=0), "fuels")
    # the cells of the result by number, each with its year and its fuel
    wide = fuels.count()
    cells = listings.sparkSession.range(years.count() * wide).select(F.expr(f"id div {max(wide, 1)}").alias("__y"), (F.col("id") % max(wide, 1)).alias("__f"))
    grid = cells.join(years, "__y").join(fuels, "__f").drop("__y", "__f")
    return grid.join(n, ["production_year", "fuel_type"], "left").select(
        "production_year", "fuel_type", F.coalesce("listings", F.lit(0)).cast("bigint").alias("listings"))


def fuel_counts_pivot(listings: DataFrame, fuels=None) -> DataFrame:
    """Listings per (year, fuel) pivoted to one column per fuel, 0 when
    absent. The columns are the fuels of the data (a distinct scan) unless
    ``fuels`` names them."""
    base = listings.where(F.col("production_year").isNotNull() & F.col("fuel_type").isNotNull())
    if fuels is None:
        fuels = sorted(r[0] for r in base.select("fuel_type").distinct().collect())   # a vocabulary
    p = base.groupBy("production_year").pivot("fuel_type", list(fuels)).count().na.fill(0)
    return p.select("production_year", *[F.col(f"`{f}`").cast("bigint").alias(fuel_column(f)) for f in fuels])


def fuel_share_by_year(listings: DataFrame, fuels=FUELS) -> DataFrame:
    """Share of each shown fuel per year; denominator is every fuel."""
    base = listings.where(F.col("production_year").isNotNull() & F.col("fuel_type").isNotNull())
    aggs = [F.count(F.lit(1)).alias("__total")] + [
        F.count_if(F.col("fuel_type") == f).alias(fuel_column(f)) for f in fuels]
    p = base.groupBy("production_year").agg(*aggs)
    return p.select("production_year", *[
        (F.col(fuel_column(f)) / F.col("__total")).alias("share_" + fuel_column(f)[2:])
        for f in fuels])


def top_models_vs_market(listings: DataFrame, year_from: int = 2010, year_to: int = 2020, k: int = 10) -> DataFrame:
    """Top-k make-models by listings with their medians, next to
    the market medians of the same year window."""
    window = listings.where(F.col("production_year").between(year_from, year_to))
    base = window.where(F.col("make").isNotNull() & F.col("model").isNotNull())
    agg = base.groupBy("make", "model").agg(F.count(F.lit(1)).alias("listings"))
    top = agg.orderBy(F.desc("listings"), "make", "model").limit(k)  # TakeOrderedAndProject
    # Medians only for the k winners: semi-join first, then rank the few groups.
    top_rows = base.join(F.broadcast(top.select("make", "model")), ["make", "model"], "left_semi")
    top = aggregate_with_medians(top_rows, ["make", "model"], [F.count(F.lit(1)).alias("listings")],
                       ["price", "mileage_km"])
    market = grouped_median(window.withColumn("__all", F.lit(1)), ["__all"], ["price", "mileage_km"])
    # One-row market aggregate (a global group): a proven size bound.
    market = market.select("__all", F.col("median_price").alias("market_median_price"),
                           F.col("median_mileage_km").alias("market_median_mileage_km"))
    out = top.withColumn("__all", F.lit(1)).join(F.broadcast(market), "__all", "left")
    return out.select("make", "model", "listings", _round("median_price"), _round("median_mileage_km"),
                      _round("market_median_price"), _round("market_median_mileage_km"))


def top_make_models(listings: DataFrame, k: int = 3, year_from: int = 2010, year_to: int = 2020) -> DataFrame:
    """H2: the k most listed (make, model) pairs of the year window."""
    base = listings.where(F.col("production_year").between(year_from, year_to) &
                          F.col("make").isNotNull() & F.col("model").isNotNull())
    return (base.groupBy("make", "model").agg(F.count(F.lit(1)).alias("listings"))
            .orderBy(F.desc("listings"), "make", "model").limit(k).select("make", "model"))


def top3_config_prices(listings: DataFrame, k: int = 3, year_from: int = 2010, year_to: int = 2020) -> DataFrame:
    """Configurations of the top-k make-models with count of
    priced listings and median price and mileage."""
    base = listings.where(F.col("production_year").between(year_from, year_to) &
                          F.col("make").isNotNull() & F.col("model").isNotNull())
    top = top_make_models(listings, k, year_from, year_to)
    # k rows from TakeOrderedAndProject: bounded broadcast for the semi join.
    sel = base.join(F.broadcast(top), ["make", "model"], "left_semi").withColumn(
        "config_short", C.short_config("engine_capacity_cm3", "fuel_type", "transmission"))
    keys = ["make", "model", "config_short"]
    out = aggregate_with_medians(sel, keys, [F.count("price").alias("listings")], ["price", "mileage_km"])
    return out.select(*keys, "listings", _round("median_price"), _round("median_mileage_km"))


SELECTED_MODELS = ("ECONOMY", "SMALL", "LARGE", "PROMO")


def depreciation_curve(listings: DataFrame, models=SELECTED_MODELS, year_from: int = 2010,
                       year_to: int = 2022) -> DataFrame:
    """Median price and count per (model, year), with the change against
    the previous year of the same model (window over the small aggregate)."""
    base = listings.where(F.col("production_year").between(year_from, year_to) &
                          F.col("model").isin(list(models)))
    keys = ["model", "production_year"]
    out = aggregate_with_medians(base, keys, [F.count(F.lit(1)).alias("listings")], ["price"])
    w = Window.partitionBy("model").orderBy("production_year")
    return out.select(*keys, "listings", _round("median_price"),
                      F.round(F.col("median_price") - F.lag("median_price").over(w), 4).alias("yoy_change"))


def gearbox_prices(listings: DataFrame, models=SELECTED_MODELS, year_from: int = 2015, year_to: int = 2023,
                   min_price: float = 5000) -> DataFrame:
    """Median price and count per (model, gearbox)."""
    base = listings.where(F.col("production_year").between(year_from, year_to) &
                          F.col("transmission").isin("Automatyczna", "Manualna") &
                          F.col("model").isin(list(models)) & (F.col("price") > min_price))
    keys = ["model", "transmission"]
    out = aggregate_with_medians(base, keys, [F.count(F.lit(1)).alias("listings")], ["price"])
    return out.select(*keys, "listings", _round("median_price"))


def gearbox_premium(listings: DataFrame, **kw) -> DataFrame:
    """Automatic minus manual median price per model (pivot of G16)."""
    g = gearbox_prices(listings, **kw)
    p = g.groupBy("model").pivot("transmission", ["Automatyczna", "Manualna"]).agg(F.first("median_price"))
    return p.select("model", F.col("Automatyczna").alias("median_automatic"),
                    F.col("Manualna").alias("median_manual"),
                    F.round(F.col("Automatyczna") - F.col("Manualna"), 4).alias("premium"))
