"""Catalogue tagging against a brute-force loop that walks the catalogue the
way the source notebook did, on a small fixture."""
import re

from carlot.operators import catalogue as CT
from carlot.operators import equipment as EQ

CATALOGUE = [("Skoda", "Octavia"), ("Skoda", "Octavia Combi"), ("Skoda", "RS"), ("Skoda", "Fabia"),
             ("Ford", "Focus"), ("Ford", "Ka"), ("Ford", "Ka+"), ("Land Rover", "Defender"),
             ("Alfa Romeo", "Giulia"), ("Lynk & Co", "01")]
TITLES = ["Skoda Octavia Combi RS 2.0", "skoda fabia", "Ford Focus ST", "Ford Ka+ 1.2", "LAND ROVER Defender 110",
          "Alfa Romeo Giulia Veloce", "Lynk & Co 01 hybrid", "Skodaa Octavia", "Ford Kab", "no make here"]


def brute_make(title):
    make = None
    for brand, _ in CATALOGUE:
        if re.search(r"\b" + re.escape(brand) + r"\b", title, re.I):
            make = brand
    return make


def brute_model(title, make):
    if make is None:
        return None
    models = [(m, i) for i, (b, m) in enumerate(CATALOGUE) if b == make]
    models.sort(key=lambda x: (-len(x[0]), x[1]))
    t, model = title, None
    for m, _ in models:
        pat = r"\b" + re.escape(m) + r"\b"
        if re.search(pat, t, re.I):
            model = m
            t = re.sub(pat, "", t).strip()
    return model


def test_make_and_model_tagging(spark):
    cat = spark.createDataFrame([(b, m, i + 1) for i, (b, m) in enumerate(CATALOGUE)],
                                "brand string, model string, ord long")
    titles = spark.createDataFrame(list(enumerate(TITLES)), "row_id long, title string")
    tagged = CT.tag_model(CT.tag_make(titles, cat), cat)
    got = {r["row_id"]: (r["make"], r["model"]) for r in tagged.collect()}
    for i, t in enumerate(TITLES):
        mk = brute_make(t)
        assert got[i] == (mk, brute_model(t, mk)), t
    assert got[0] == ("Skoda", "RS")            # shortest remaining match wins (parity)
    longest = {r["row_id"]: r["model"] for r in CT.tag_model(CT.tag_make(titles, cat), cat,
                                                              policy="longest").collect()}
    assert longest[0] == "Octavia Combi"


def test_labels_and_slugs(spark):
    labels = spark.createDataFrame([("Toyota (123)",), ("Wszystkie marki",), ("Lynk & Co (4)",)], "label string")
    assert [r["name"] for r in CT.clean_catalogue_labels(labels).collect()] == ["Toyota", "Lynk & Co"]
    df = spark.createDataFrame([("Lynk & Co",), ("Alfa Romeo",), ("Brand#2",)], "b string")
    got = [r[0] for r in df.select(CT.make_slug("b")).collect()]
    assert got == ["lynk-and-co", "alfa-romeo", "brand%232"]


def test_equipment_star(spark):
    lst = spark.createDataFrame([(1, "ABS|Klimatyzacja| abs "), (2, None), (3, "Bezpieczeństwo|ESP|ABS")],
                                "listing_id long, equipment string") \
        .withColumn("equipment_list", EQ.equipment_items("equipment"))
    opts = EQ.option_dimension(lst)
    assert [(r["id"], r["name"]) for r in opts.orderBy("id").collect()] == [(0, "abs"), (1, "esp"), (2, "klimatyzacja")]
    bridge = EQ.listing_equipment(lst, opts)
    view = {r["listing_id"]: r["equipment"] for r in EQ.equipment_view(lst, bridge, opts).collect()}
    assert view == {1: "abs, klimatyzacja", 2: None, 3: "abs, esp"}


def test_make_tagging_token_edges(spark):
    cat_rows = [("Mercedes-Benz", "C"), ("Alfa Romeo", "Giulia"), ("e.GO", "Life"), ("Land Rover", "Defender"),
                ("Rover", "75")]
    titles = ["Mercedes-Benz C 200", "Mercedes Benz C", "e.GO Life", "eXGO Life", "ALFA ROMEO Giulia",
              "Land Rover Defender", "Rover 75 Tourer", "Land-Rover Discovery"]
    cat = spark.createDataFrame([(b, m, i + 1) for i, (b, m) in enumerate(cat_rows)],
                                "brand string, model string, ord long")
    df = spark.createDataFrame(list(enumerate(titles)), "row_id long, title string")
    got = {r["row_id"]: r["make"] for r in CT.tag_make(df, cat).collect()}
    for i, t in enumerate(titles):
        want = None
        for b, _ in cat_rows:          # catalogue order, last match wins; make taken literally
            if re.search(r"\b" + re.escape(b) + r"\b", t, re.I):
                want = b
        assert got[i] == want, t
    assert got[1] is None and got[3] is None and got[6] == "Rover" and got[5] == "Rover"


def test_names_are_looked_up_in_the_row(spark):
    """titles are neither stored nor shuffled nor exploded for a catalogue of
    bounded size; a larger one goes by the join and gives the same rows."""
    cat = [(b, m, i + 1) for i, (b, m) in enumerate(CATALOGUE)] + [(None, "Focus", 90), ("Ford", None, 91), ("Ka", "Skoda", 92), ("!", "!", 93)]
    catalogue = spark.createDataFrame(cat, "brand string, model string, ord long")
    texts = [*TITLES, None, "", "Ford Ford Focus ford ka", "Skoda Ford RS Focus", "Focus only"] * 2
    titles = spark.createDataFrame([(i // 2 or None, t) for i, t in enumerate(texts)], "id long, title string")
    key = lambda r: str(tuple(r))
    got = {}
    for most in (0, 100):
        for policy in ("parity", "longest"):
            made = CT.tag_make(titles, catalogue, lookup=most)
            got[most, policy] = sorted(CT.tag_model(made, catalogue, policy=policy, lookup=most).collect(), key=key)
    assert got[0, "parity"] == got[100, "parity"] and got[0, "longest"] == got[100, "longest"]
    assert len(got[0, "parity"]) == len(texts) and {r["make"] for r in got[0, "parity"]} == {None, "Skoda", "Ford", "Land Rover", "Alfa Romeo", "Lynk & Co", "Ka"}
    none = CT.tag_make(titles, catalogue.where("false"))
    assert none.count() == len(texts) and none.where("make is not null").isEmpty()
    df = CT.tag_model(CT.tag_make(titles, catalogue), catalogue)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Generate|Join", plan)
    assert "from_json" not in plan and "__names" not in plan            # a constant, not made for each row
