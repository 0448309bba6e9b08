"""Table loading and the listing view over the driver's tables.

The driver's data has no listings table; ``listings`` shapes
``lineitem ⨝ part`` like a listings table (make, model, year, price, ...),
with NULL years, prices and fuels, and natural duplicate keys. The same
view is written in SQL in ``carlot.plans.oracles.LISTINGS_CTE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data folder."""
    from carlot.session import ship_package
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fuel(p_size: Column) -> Column:
    m = p_size % 7
    return (F.when(m == 0, "Benzyna").when(m == 1, "Diesel").when(m == 2, "Benzyna+LPG")
            .when(m == 3, "Hybryda").when(m == 4, "Elektryczny").when(m == 5, "Hybryda Plug-in"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings view: one row per lineitem, joined to its part.

    ``part`` is joined by exchange, whatever its size: the slim rows spread over
    all tasks, so that what follows doesn't run in the few tasks that scan
    ``lineitem`` (a file of one row group is one task).
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_name").hint("merge")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("advert_id"),
        F.concat(F.lit("src"), (F.col("l_suppkey") % 3).cast("string")).alias("source"),
        F.col("p_brand").alias("make"),
        F.col("p_type").alias("model"),
        F.when(F.col("l_partkey") % 29 == 0, F.lit(None))
         .otherwise(2000 + F.col("l_partkey") % 26).cast("int").alias("production_year"),
        F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_extendedprice"))
         .cast("double").alias("price"),
        F.when(F.col("l_returnflag") == "R", "EUR").otherwise("PLN").alias("currency"),
        (F.col("l_quantity") * 5000).cast("int").alias("mileage_km"),
        _fuel(F.col("p_size")).alias("fuel_type"),
        F.when(F.col("l_linestatus") == "F", "Manualna").otherwise("Automatyczna").alias("transmission"),
        (900 + 50 * F.col("p_size")).cast("int").alias("engine_capacity_cm3"),
        F.col("l_shipdate").alias("advert_date"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
        "l_linestatus", "p_size", "p_name",
    )
