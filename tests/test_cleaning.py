"""Scalar cleaners: the reference's literal cases plus pinned edge cases."""
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from carlot.functions import clean as C
from carlot.functions import measures as MS
from carlot.operators.equipment import equipment_items


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_reference_literals(spark):
    assert one(spark, C.clean_price, "89 900 PLN") == Decimal("89900")
    assert one(spark, C.clean_mileage, "45 000 km") == 45000
    assert one(spark, C.clean_power_hp, "122 KM") == 122
    assert one(spark, C.clean_power_hp, "90 kW") == 122
    assert one(spark, C.clean_engine_capacity, "1 798 cm3") == 1798


def test_engine_capacity_edges(spark):
    assert one(spark, C.clean_engine_capacity, "abc 1798") == 1798
    assert one(spark, C.clean_engine_capacity, "ok silnik 1798") is None
    assert one(spark, C.clean_engine_capacity, "1,8 l") == 1
    assert one(spark, C.clean_engine_capacity, None) is None


def test_price_edges(spark):
    for v in (None, "", "brak"):
        assert one(spark, C.clean_price, v) is None
    assert one(spark, C.clean_price, "89 900,50") == Decimal("8990050")
    assert one(spark, lambda c: C.clean_price(c, mode="decimal"), "89 900,50") == Decimal("89900.50")
    assert one(spark, C.legacy_price, "89 900,50") == 89900.5


def test_polish_dates(spark):
    assert one(spark, C.polish_date, "12 maja 2026 14:20") == datetime(2026, 5, 12, 14, 20)
    assert one(spark, C.polish_date, "12 maja 2026") == datetime(2026, 5, 12, 0, 0)
    assert one(spark, C.polish_date, "3 października 2025") == datetime(2025, 10, 3)
    assert one(spark, C.polish_date, "5 foo 2020") is None
    assert one(spark, C.polish_date_rejected, "5 foo 2020") is False
    assert one(spark, C.polish_date, "32 maja 2026") is None
    assert one(spark, C.polish_date_rejected, "32 maja 2026") is True
    assert one(spark, C.month_replace_date, "12 maja 2026 14:20") == datetime(2026, 5, 12, 14, 20)
    assert one(spark, C.month_replace_date, "12 maja 2026") is None


def test_unit_cleaner(spark):
    bat = MS.SPEC_BY_TARGET["battery_capacity_kwh"]
    strict = lambda c: MS.measure(c, bat)
    parity = lambda c: MS.measure(c, bat, parity=True)
    r = one(spark, strict, "75 kWh")
    assert (r["value"], r["ok"]) == (75.0, True)
    assert one(spark, strict, "75")["ok"] is False
    r = one(spark, parity, "75")
    assert (r["unit"], r["ok"]) == ("5", False)
    assert one(spark, parity, "7,5 kWh")["value"] == 5.0
    assert one(spark, strict, "7,5 kWh")["ok"] is False
    r = one(spark, strict, None)
    assert (r["value"], r["ok"]) == (None, True)
    moc = MS.SPEC_BY_TARGET["power_hp"]
    assert abs(one(spark, lambda c: MS.measure(c, moc, parity=True), "100 kW")["value"] - 135.962) < 1e-9


def test_booleans_and_labels(spark):
    assert one(spark, C.tak_nie, " Tak ") is True
    assert one(spark, C.tak_nie, "nie") is False
    assert one(spark, C.tak_nie, "?") is None
    assert one(spark, C.unknown_if_blank, "") == "unknown"
    assert one(spark, C.unknown_if_blank, None) == "unknown"
    assert one(spark, lambda c: C.mileage_band(c), 123456, "int") == "100000-149999 km"
    assert one(spark, C.city, "Kraków (Małopolskie)") == "Kraków"
    assert one(spark, C.province, "Kraków (Małopolskie)") == "Małopolskie"
    assert one(spark, C.city, "Kraków") is None


def test_equipment_items(spark):
    assert one(spark, equipment_items, "ABS| abs |Bezpieczeństwo||X") == ["abs", "x"]
    assert one(spark, equipment_items, None) == []


def test_short_config(spark):
    df = spark.createDataFrame([(1798, "Diesel", "Manualna"), (None, None, None), (1850, "Benzyna", None)],
                               "c int, f string, g string")
    got = [r[0] for r in df.select(C.short_config("c", "f", "g")).collect()]
    assert got == ["1.8 | D | M", "? | ? | ?", "1.9 | B | ?"]


def test_usage_rate_zero_age(spark):
    df = spark.createDataFrame([(100000.0, 2025), (100000.0, 2015)], "m double, y int")
    got = [r[0] for r in df.select(C.usage_per_year("m", "y")).collect()]
    assert got == [None, 10000.0]


def test_cleaners_of_a_row_stay_compiled(spark, tmp_path):
    """Java never compiles a method of over 8000 bytes: the columns of clean_numeric_fields fit one."""
    from carlot.plans.queries import QUERIES
    spark.createDataFrame([(1, "large ring", "Brand#1", "LARGE", 7)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int") \
        .write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(5, 1, 2, 3, 4.0, 1234.56, 0.1, "N", "O")], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                          "l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string") \
        .selectExpr("*", "timestamp_ntz'1996-09-13 00:00:00' l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES["clean_numeric_fields"](spark, str(tmp_path))
        stages = df._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000, sizes
    r = df.first()
    assert (r["price_whole"], r["price_digits"], str(r["price_decimal"]), r["price_legacy"]) == (1234, 123456, "1234.56", 1234.56)
    assert (r["mileage_km"], r["power_hp"], r["engine_capacity_cm3"], r["mileage_first_number"]) == (20000, 7, 1250, 20000.0)


def test_blank_measures_are_not_searched(spark):
    """Blank and NULL texts are NULL before any pattern; a pattern that finds a measure in '' still reads it."""
    odd = MS.MeasureSpec("Stan", "state", ("",), r"(\d*)(x*)", integer=True)
    df = spark.createDataFrame([("75 kWh", "4"), ("", ""), (None, None), ("  ", "x"), ("brak", "5")], "`Pojemność baterii` string, Stan string")
    got = MS.clean_measures(df, (*MS.SPECS, odd), parity=True)
    assert [r["battery_capacity_kwh"] for r in got.collect()] == [75.0, None, None, None, None]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT (Pojemność baterii" in plan and "CASE WHEN NOT (Stan" not in plan
    direct = df.select(MS.measure("Stan", odd, parity=True)["value"].alias("state"))
    assert [r["state"] for r in got.collect()] == [r["state"] for r in direct.collect()]
