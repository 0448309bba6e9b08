"""Landed-page extraction: result pages, offer pages in both layouts, captcha,
fetch outcomes. Markup is written here to the structures the rules target."""
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from carlot.operators import extract as X
from carlot.operators.replay import fetch_outcome, retry_after_seconds

RESULT_PAGE = """<html><body><div><article data-id=" 70315 "><div><h2>Van, one owner</h2></div>
<p title=isn't><a href="https://shop.example/osobowe/oferta/van-70315">open</a></p></article>
<article><h2><a href="/osobowe/oferta/no-id">No id</a></h2></article>
<article data-id="70299"><h2><em><a href="/osobowe/oferta/pickup-70299?x=1&amp;y=2">Pickup</a></em></h2></article>
<article data-id="70315"><h2><a href="/osobowe/oferta/van-again">Seen before</a></h2></article>
<article data-id="70288"><h2>Nothing to follow</h2></article></div>
<ul><li>poprzednia</li><li>4</li><li>3</li></ul><a href="?page=7"> 7 </a><li>99</li><ul><li>481234567890123456789</li></ul>
</body></html>"""

OFFER_LAYOUT1 = """<!DOCTYPE html><html><body>
<div data-sentry-element="BottomWrapper"><div data-sentry-element="Area">
<p data-sentry-element="Text">3 lutego 2024</p></div><div data-sentry-element="Area"><p>Numer ID 70315</p></div></div>
<p data-sentry-element="Label" title=it's>Przebieg</p><span>x</span><p>8 210 <b>km</b></p>
<p data-sentry-element="Label">Rodzaj paliwa</p><p>Diesel</p>
<p data-sentry-element="Label">Marka pojazdu</p><p> Fiat </p>
<p data-sentry-element="Label">Rok produkcji</p><p>2017</p>
<p data-sentry-element="Label">Liczba drzwi</p><p>4</p>
<p data-sentry-element="Label">Model pojazdu</p><p>Ducato</p>
<p data-sentry-element="Label">Moc</p><p>131 KM</p>
<p data-sentry-element="Label">Wersja</p><p></p>
<p data-sentry-element="Label">Pojemność skokowa</p><p>2 287 cm3</p>
<div data-testid="content-equipments-section"><ul><li>Hak</li><li>Kamera</li></ul>
<div data-sentry-element="EquipmentBox"> Tempomat </div><li>Hak</li></div>
<strong class="big offer-price__number">63&nbsp;450</strong> <i class="offer-price__currency">EUR</i>
</body></html>"""

OFFER_LAYOUT2 = """<div data-testid="technical_specs"><p>Moc</p><p>1 KM</p></div>
<div data-testid="mileage"><div><p>Przebieg</p></div><p>311 004 km</p></div>
<div data-testid="gearbox"><p>Skrzynia biegów</p><p>Manualna</p><p>extra</p></div>
<div data-testid="brand"><p>Marka pojazdu</p><p>Mazda</p></div>
<div data-testid="lonely"><p>Model pojazdu</p></div>
<div data-testid="ad-price-container"><b>od</b><span>7 300</span><span>zł</span></div>
<time>30 września 2023 07:05</time> <p>Ogłoszenie, ID:70299"""

CAPTCHA = "<title>x</title><p>Are you <i>human</i>?</p>"


def test_result_page_rules():
    doc = X.parse_html(RESULT_PAGE)
    refs = X.listing_refs(doc, "https://shop.example")
    assert [(r["advert_id"], r["url"]) for r in refs] == [
        ("70315", "https://shop.example/osobowe/oferta/van-70315"),
        ("70299", "https://shop.example/osobowe/oferta/pickup-70299?x=1&y=2")]
    assert X.total_pages(doc) == 7                  # a 21-digit run is no page number
    assert not X.is_captcha(doc)
    legacy = X.listing_refs(doc, "https://shop.example", legacy=True)
    assert [r["url"] for r in legacy] == ["/osobowe/oferta/pickup-70299?x=1&y=2", "/osobowe/oferta/van-again"]
    assert X.total_pages(X.parse_html("<p>no pagination</p>")) == 1


def test_offer_layout1_rules():
    doc = X.parse_html(OFFER_LAYOUT1)
    assert X.label_fields(doc) == {
        "Przebieg": "8 210 km", "Rodzaj paliwa": "Diesel", "Marka pojazdu": "Fiat", "Rok produkcji": "2017",
        "Model pojazdu": "Ducato", "Moc": "131 KM", "Pojemność skokowa": "2 287 cm3"}
    assert X.price(doc) == ("63 450", "EUR")
    assert X.equipment(doc) == ["Hak", "Kamera", "Tempomat"]
    assert X.advert_date_text(doc) == "3 lutego 2024"
    assert X.page_advert_id(doc) == "70315"


def test_offer_layout2_and_missing_fields():
    doc = X.parse_html(OFFER_LAYOUT2)
    assert X.label_fields(doc) == {"Przebieg": "311 004 km", "Skrzynia biegów": "Manualna", "Marka pojazdu": "Mazda"}
    assert X.price(doc) == ("7 300", None)
    assert X.advert_date_text(doc) == "30 września 2023 07:05"
    assert X.page_advert_id(doc) == "70299" and X.equipment(doc) == []


def test_both_layouts_on_one_page():
    doc = X.parse_html(OFFER_LAYOUT1 + OFFER_LAYOUT2)
    both = X.label_fields(doc)
    assert both["Marka pojazdu"] == "Mazda" and both["Model pojazdu"] == "Ducato" and both["Przebieg"] == "311 004 km"
    assert X.label_fields(doc, policy="legacy")["Marka pojazdu"] == "Fiat"


def test_captcha():
    assert X.is_captcha(X.parse_html(CAPTCHA)) and not X.is_captcha(X.parse_html("<script>captcha</script>"))


def test_parse_and_normalize_job(spark):
    pages = spark.createDataFrame(
        [(1, "https://shop.example/oferta/1", OFFER_LAYOUT1),
         (2, "https://shop.example/oferta/2/", OFFER_LAYOUT2), (3, "https://shop.example/oferta/3/", None)],
        "k long, url string, html string")
    rec = X.normalize_listing(X.parse_pages(pages), url="url", scraped_at="2026-05-13 00:00:00")
    got = {r["k"]: r for r in rec.collect()}
    a = got[1]
    assert (a["advert_id"], a["make"], a["model"], a["version"], a["fuel_type"]) == ("70315", "Fiat", "Ducato", None, "Diesel")
    assert a["price"] == Decimal("63450") and a["currency"] == "EUR"
    assert (a["mileage_km"], a["power_hp"], a["engine_capacity_cm3"], a["production_year"]) == (8210, 131, 2287, 2017)
    assert a["advert_date"] == datetime(2024, 2, 3) and a["equipment"] == ["Hak", "Kamera", "Tempomat"]
    b = got[2]
    # the page id wins over the one in the URL
    assert (b["advert_id"], b["make"], b["mileage_km"], b["power_hp"]) == ("70299", "Mazda", 311004, None)
    assert b["price"] == Decimal("7300") and b["transmission"] == "Manualna"
    assert got[3]["advert_id"] == "3" and got[3]["price"] is None


def test_fetch_outcomes(spark):
    df = spark.createDataFrame([(403, None, False), (429, "30", False), (429, "Wed, 21 Oct 2026 07:28:00 GMT", False),
                                (503, None, False), (404, None, False), (200, None, True), (200, None, False)],
                               "s int, ra string, cap boolean")
    got = df.select(fetch_outcome(F.col("s"), F.col("ra"), F.col("cap")).alias("o"),
                    retry_after_seconds(F.col("s"), F.col("ra")).alias("r")).collect()
    assert [r["o"] for r in got] == ["AccessBlocked", "RateLimited", "RateLimited", "FetchFailed",
                                     "HTTPError", "CaptchaDetected", "ok"]
    assert [r["r"] for r in got][:3] == [None, 30, None]


def test_odd_markup_keeps_its_fields():
    for quote in ("title=don't", "title=it's", "data-x='a>b'", 'data-x="a>b"', "x=1/", "'"):
        doc = X.parse_html(f'<div {quote}><p data-sentry-element="Label" {quote}>Moc</p><p>9 KM</p></div>')
        assert X.label_fields(doc) == {"Moc": "9 KM"}, quote
    nested = X.parse_html('<p data-sentry-element="Label">Moc<p>5 KM</p><!-- <p>x</p> --><script>"</p>"</script>')
    assert nested.text("|").startswith("Moc")


def test_legacy_captcha_markers(spark):
    from carlot.schemas import CAPTCHA_MARKERS_LEGACY
    pages = spark.createDataFrame([(1, "<p>Too Many Requests</p>")], "k long, html string")
    assert X.parse_pages(pages).first()["captcha"] is False
    assert X.parse_pages(pages, captcha_markers=CAPTCHA_MARKERS_LEGACY).first()["captcha"] is True


def _built(page):
    b = X._Builder()
    b.feed(page)
    return b.finish()


def _lists(doc):
    return [(doc.tags[e][:3], doc.parents[e], doc.ends[e], doc.strings(e)) for e in range(len(doc.tags))], dict(doc.marks)


def test_ordinary_pages_read_each_distinct_tag_once():
    """Pages of ordinary tags are cut at them; the tree is that of html.parser, which reads each distinct tag once."""
    row = '<p data-sentry-element="Label">Moc</p> <p>9 &amp; 0&nbsp;KM</p></i><br><li a="1"><x/>q</li>'
    page = "<!doctype html><html><title>t</title><body><div><P class='z'>".replace("'", '"') + row * 50 + "</div> > <b>open"
    X._tags.clear()
    assert _lists(X.parse_html(page)) == _lists(_built(page))
    assert len(X._tags) == 17                              # the ends and the doctype among them
    for odd in ('<p>a<b</p>', '<!-- <p>x</p> --><p>y</p>', '<script>"<p>"</script>', '<a title="x>y">z</a>', "<p class=q>r</p>",
                "<title>a<b>c</b></title>", "<TITLE>x</TITLE>", "a < b", "<p a='<'>x</p>"):
        assert X._plain_doc(odd) is None, odd
        assert _lists(X.parse_html(odd)) == _lists(_built(odd))


def _rows_of(run, pages):
    import pyarrow as pa
    batch = pa.record_batch([pa.array(range(len(pages))), pa.array(pages, pa.string())], names=["k", "html"])
    return [tuple(r.values())[1:] for b in run(iter([batch])) for r in b.to_pylist()]


def _odd_pages():
    """Pages of the rules' elements with texts that split, repeat, miss or run over; every third has odd markup."""
    label, pair = '<p data-sentry-element="Label">%s</p><p>%s</p>', '<div data-testid="q"><p>%s</p><b>-</b><p>%s</p></div>'
    bottom = ('<div data-sentry-element="BottomWrapper">%s<div data-sentry-element="Area"><p data-sentry-element="Text">%s</p>'
              '</div><div data-sentry-element="Area"><p data-sentry-element="Text">%s</p></div></div>')
    box = '<div data-sentry-element="EquipmentBox"><p data-sentry-element="Text">%s</p></div>'
    price = '<span class="offer-price__number">%s</span><span class="offer-price__currency">%s</span>'
    about = '<div data-testid="content-description-section"><h2>%s</h2><div data-testid="textWrapper"><p> %s</p><p>b</p></div></div>'
    texts = ["Moc", " Moc ", "M<b>oc</b>", "Przebieg", "Opis", "", " ", "&nbsp;", "&#1;", "a &amp; b", "5 KM", "ID: 12345", "ID", ": 98765",
             "3 lutego 2024", "3 lutego", "2024 10:30", "10:30", "dodano 3 maja 2021 przez", "Are you", "<i>human</i>?", "too many",
             "requests", "a > b", "ID 1234x", "7", "0"]
    pages = []
    for i in range(len(texts)):
        t = [texts[(i + k * k) % len(texts)] for k in range(16)]
        page = (label % (t[0], t[1]) + label % ("Moc", t[2]) + (pair % (t[3], t[4]) + pair % ("Moc", t[5])) + price % (t[6], t[7])
                + '<div data-testid="content-equipments-section">' + "".join(box % x for x in t[8:12]) + "</div>"
                + bottom % (t[12], t[13], t[14]) + about % (t[15], t[0]) + about % ("Opis", t[1]) + f"<ul><li>{t[2]}</li></ul>")
        pages += [page, page.replace(' data-sentry-element="Label"', ""), page + ("<!-- x -->", "<p class=q>r", "<script>captcha</script>")[i % 3]]
    pages += ["", None, "ID: 4444", "<title>captcha</title>"]
    return pages[::-1] + pages                          # pages of one kind are read together


def test_pages_read_together_have_the_fields_of_each_by_itself():
    """Offer pages of a batch are read as columns, one tree for each sequence of tags; the rules over one page say what is in them."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    key, pages = [T.StructField("k", T.LongType())], _odd_pages()
    for policy in ("supported", "legacy"):
        run = X._make_parser("html", ["k"], "https://x", policy, False, to_arrow_schema(T.StructType(key + X.PARSED_FIELDS)))
        docs = [X.parse_html(p) for p in pages]
        assert _rows_of(run, pages) == [
            (X.is_captcha(d), X.total_pages(d), X.listing_refs(d, "https://x"), X.page_advert_id(d),
             list(X.label_fields(d, policy=policy).items()), X.equipment(d), *X.price(d), X.advert_date_text(d)) for d in docs]


def test_offer_pages_of_the_same_tags_are_one_tree(monkeypatch):
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    trees, tree = [], X._plain_tree
    monkeypatch.setattr(X, "_plain_tree", lambda tags: trees.append(tags) or tree(tags))
    run = X._make_parser("html", ["k"], "", "supported", False,
                         to_arrow_schema(T.StructType([T.StructField("k", T.LongType())] + X.PARSED_FIELDS)))
    rows = _rows_of(run, [f'<p data-sentry-element="Label">Moc</p><p>{i} KM</p>' + "<br>" * (i % 2) for i in range(500)])
    assert [r[4] for r in rows] == [[("Moc", f"{i} KM")] for i in range(500)] and len(trees) == 2


def test_batch_pages_read_together_have_the_columns_of_each_by_itself(spark, monkeypatch):
    """The 44 columns of a batch of pages; ``batch_record`` of one page says what is in them, and one tree does for equal tags."""
    pages = _odd_pages()
    frame = spark.createDataFrame(list(enumerate(pages)), "k long, html string").coalesce(1)
    for variant in ("v1", "threaded"):
        got = {r["k"]: r for r in X.parse_batch_pages(frame, variant=variant).collect()}
        for k, p in enumerate(pages):
            doc = X.parse_html(p)
            want = {c: X.batch_record(doc, variant).get(c, "") for c in X.BATCH_COLUMNS}
            assert {c: got[k][c] for c in X.BATCH_COLUMNS} == want, (variant, p)
            assert got[k]["captcha"] == X.is_captcha(doc, X.CAPTCHA_MARKERS_LEGACY)
    trees, tree = [], X._plain_tree
    monkeypatch.setattr(X, "_plain_tree", lambda tags: trees.append(tags) or tree(tags))
    plans = X.Plans(X._batch_plan)
    assert plans(["<p>", "</p>"], 1) is None and not trees       # a page by itself needs no plan
    assert plans(["<p>", "</p>"], 2) is plans(["<p>", "</p>"], 1) is not None and len(trees) == 1
