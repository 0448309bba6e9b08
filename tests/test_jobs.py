"""Composite jobs: crawl ingest replays the reference pipeline tests; the
batch cleaner handles duplicates, '' vs NULL, bad units, NULL equipment."""
from pyspark.sql import functions as F

from carlot.operators import catalogue as CT
from carlot.plans import jobs as J
from tests.test_extract import CAPTCHA, OFFER_LAYOUT1, OFFER_LAYOUT2, RESULT_PAGE

SEARCH = "https://shop.example/osobowe/search"
CFG = J.IngestConfig(max_pages=1, max_listings=1, base_url="https://shop.example", run_ts="2026-05-13 00:00:00")
VAN, PICKUP = "https://shop.example/osobowe/oferta/van-70315", "https://shop.example/osobowe/oferta/pickup-70299?x=1&y=2"


def _pages(spark, result_html=RESULT_PAGE, captures=1):
    rp = spark.createDataFrame([(1, 1, SEARCH + "?page=1", result_html, 200, None)],
                               "run long, page int, url string, html string, status_code int, retry_after string")
    dp = spark.createDataFrame([(VAN, OFFER_LAYOUT1, 200, None), (PICKUP, OFFER_LAYOUT2.replace("70299", "70300"), 200, None)]
                               * captures, "url string, html string, status_code int, retry_after string")
    return rp, dp


def test_ingest_two_runs(spark):
    for captures in (1, 2):                                  # a page captured twice counts once
        rp, dp = _pages(spark, captures=captures)
        t1, s1, _ = J.ingest(rp, dp, None, CFG)
        s1 = s1.collect()[0]
        assert (s1["saved_records"], s1["stopped_reason"], s1["pages_visited"], s1["listings_found"]) == \
            (1, "max_listings", 1, 2)
        t1 = spark.createDataFrame(t1.collect(), t1.schema)
        assert [r["advert_id"] for r in t1.collect()] == ["70315"]
        t2, s2, rej = J.ingest(rp, dp, t1, CFG)
        s2 = s2.collect()[0]
        assert (s2["saved_records"], s2["skipped_duplicates"], s2["stopped_reason"]) == (1, 1, None)
        rows = {r["advert_id"]: r for r in t2.collect()}
        assert set(rows) == {"70315", "70299"}               # keyed on the reference id
        assert rows["70299"]["make"] == "Mazda" and rows["70299"]["mileage_km"] == 311004
        assert [r["reason"] for r in rej.collect()] == ["page id 70300"]


def test_ingest_blocked_result_page(spark):
    rp, dp = _pages(spark, CAPTCHA)
    t, s, _ = J.ingest(rp, dp, None, CFG)
    s = s.collect()[0]
    assert (s["stopped_reason"], s["saved_records"]) == ("CaptchaDetected", 0)
    assert t.count() == 0


RAW_COLS = ["Marka pojazdu", "Model pojazdu", "Rok produkcji", "Przebieg", "Moc", "Pojemność skokowa",
            "Pojemność baterii", "Bezwypadkowy", "equipment", "price", "currency", "advert_date", "advert_id",
            "description"]


def test_clean_batch(spark):
    twin = ["Mazda", "6", "2012", "187 650 km", "110 kW", "2 191 cm3", "60 kWh", "Nie",
            "Hak|Komfort i dodatki| ESP ", "31 500", "EUR", "7 sierpnia 2023 08:15", "501", None]
    blank_desc = twin[:-1] + [""]
    bad_unit = ["Kia", "Ceed", "2016", "98 000 km", "100 KM", "1 396 cm3", "55 kW", "Tak", "Alarm", "44 900",
                "PLN", "28 lutego 2022 23:59", "502", "opis\nw dwóch liniach"]
    no_equipment = ["Kia", "Rio", "2009", "240 000 km", "97 KM", "1 399 cm3", None, None, None, "8 200", "PLN",
                    "2 stycznia 2021 00:00", "503", None]
    raw = spark.createDataFrame([twin, list(twin), blank_desc, bad_unit, no_equipment],
                                ", ".join(f"`{c}` string" for c in RAW_COLS))
    typed, missing = J.clean_batch(raw, parity=True)
    listings, options, bridge = J.star_tables(J.number_listings(typed))
    rows = {r["advert_id"]: r for r in listings.collect()}
    assert set(rows) == {501, 502, 503}
    a = rows[501]
    assert a["make"] == "Mazda" and a["mileage_km"] == 187650 and a["engine_capacity_cm3"] == 2191.0
    assert abs(a["power_hp"] - 149.5582) < 1e-3 and a["battery_capacity_kwh"] == 60.0
    assert a["accident_free"] is False and a["price"] == 31500.0 and a["production_year"] == 2012
    assert str(a["advert_date"]) == "2023-08-07 08:15:00"
    assert rows[502]["battery_capacity_kwh"] is None and rows[502]["accident_free"] is True
    assert sorted(r["local_id"] for r in rows.values()) == [1, 2, 3]
    assert [r["name"] for r in options.orderBy("id").collect()] == ["alarm", "esp", "hak"]
    ids = {r["local_id"]: r["advert_id"] for r in listings.collect()}
    got = sorted((ids[r["listing_id"]], r["equipment_id"]) for r in bridge.collect())
    assert got == [(501, 1), (501, 2), (502, 0)]
    gone = {r["column_name"] for r in missing.collect()}
    assert {"number_of_doors", "version", "first_owner", "first_registration_date", "price_level"} <= gone
    assert not gone & {"make", "accident_free", "advert_date", "currency"} and len(gone) == 41 - 12


def test_first_registration_formats(spark):
    from carlot.functions.clean import any_date
    texts = ["2020-05-12", "2020-05-12 10:00", "12.05.2020", "1/2/2019", "12 maja 2020", "31.02.2020", "", None, "soon"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [str(r[0]) for r in df.select(any_date("t")).collect()] == [
        "2020-05-12", "2020-05-12", "2020-05-12", "2019-02-01", "2020-05-12", "None", "None", "None", "None"]


def test_reports_run(spark):
    from carlot.sources.tables import listings
    from tests.conftest import SF0001
    lst = listings(spark, SF0001)
    rep = J.market_report(lst)
    assert rep["median_price_by_year"].count() > 0
    e = J.eda(lst)
    assert e["age_bands"].count() == 5
    assert abs(sum(e["fuel_shares"].first()[1:]) - 1.0) < 1e-9        # shares sum to 1


def test_clean_titles(spark):
    cols = "ID string, Title string, Link string, Description string, Mileage string, `Fuel Type` string, " \
           "Gearbox string, Year string, Location string, `Seller Type` string, Price string"
    a = spark.createDataFrame([
        ("1", "Skoda Octavia Combi RS 2.0", "l1", "Silnik 1 984cm3, 245 KM", "120 000 km", "Benzyna", "Manualna",
         "2019", "Kraków (Małopolskie)", "Dealer", "89 900 PLN"),
        ("2", "Ford Focus", "l2", None, "45 000 km", "Diesel", None, "2018", "Gdańsk (Pomorskie)", "Private",
         "40 000 PLN")], cols)
    b = spark.createDataFrame([("3", "ford ka+ 1.2", "l3", "moc 69km", "200 000 km", "Benzyna", "Manualna",
                                "abc", "Łódź", "Private", "9 500 PLN")],
                              "ID string, Title string, Link string, Description string, Mileage string, "
                              "`Fuel Type` string, Gearbox string, Year string, Location string, "
                              "`Seller Type` string, Price string")
    cat = spark.createDataFrame([("Skoda", "Octavia"), ("Skoda", "Octavia Combi"), ("Skoda", "RS"),
                                 ("Ford", "Focus"), ("Ford", "Ka"), ("Ford", "Ka+")], "brand string, model string")
    cat = CT.with_order(cat.withColumn("at", F.monotonically_increasing_id()), ["at"])
    df, report = J.clean_titles([a, b], cat, run_date="2026-02-01")
    rows = {r["ID"]: r for r in df.collect()}
    assert set(rows) == {1.0, 3.0}                              # row 2 dropped: no Gearbox
    r1 = rows[1.0]
    assert (r1["Make"], r1["Model"]) == ("Skoda", "RS")
    assert r1["Mileage in km"] == 120000.0 and r1["Price"] == 89900.0
    assert r1["Engine capacity"] == 1984.0 and r1["Power"] == 245.0
    assert (r1["City"], r1["Province"]) == ("Kraków", "Małopolskie")
    assert r1["Scraping Date"] == "2025-12-31"                  # run date - 32 days
    r3 = rows[3.0]
    assert r3["Model"] == "Ka"                                   # 'Ka+' cannot end a whole-word match
    assert r3["Make"] == "Ford" and r3["Power"] is None and r3["Year"] is None and r3["City"] is None
    bad = {r["column_name"]: r["invalid"] for r in report.collect()}
    assert bad["Year"] == 1


def test_star_tables_make_item_lists_once(spark):
    """items are stripped by the split (of any blanks), and made once for options and bridge."""
    from carlot.operators import equipment as EQ
    from carlot.plans import jobs as J
    raw = " ABS |\tabs || Bezpieczeństwo |\n|Hak  holowniczy |X "
    df = spark.createDataFrame([(1, raw, "q"), (2, None, "r"), (3, " | ", "s")], "local_id long, equipment string, make string")
    items = {r["local_id"]: r["e"] for r in df.select("local_id", EQ.equipment_items("equipment").alias("e")).collect()}
    assert items == {1: ["abs", "hak  holowniczy", "x"], 2: [], 3: []}
    assert [r[0] for r in df.limit(1).select(EQ.equipment_items(F.lit("a| |b"), keep_blank=True)).collect()] == [["a", "", "b"]]
    lst, options, bridge = J.star_tables(df)
    assert lst.columns == ["local_id", "make"] and lst.count() == 3
    assert [(r["id"], r["name"]) for r in options.orderBy("id").collect()] == [(0, "abs"), (1, "hak  holowniczy"), (2, "x")]
    assert sorted(map(tuple, bridge.collect())) == [(1, 0), (1, 1), (1, 2)]
    plan = bridge._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "split(" not in plan
