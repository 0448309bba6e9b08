"""NULL keys: groups of a prefix sum, tagged titles."""
from pyspark.sql import functions as F

from carlot.operators import catalogue as CT
from carlot.operators import scans as SC


def test_median_with_two_nullable_keys(spark):
    rows = [(None, "x", v) for v in (1.0, 2.0, 3.0)] + [("x", None, v) for v in (10.0, 20.0, 30.0)] + [(None, None, 7.0), ("x", "x", 5.0)]
    df = spark.createDataFrame(rows, "a string, b string, v double")
    got = {(r.a, r.b): r.median_v for r in SC.grouped_median(df, ["a", "b"], ["v"]).collect()}
    assert got == {(None, "x"): 2.0, ("x", None): 20.0, (None, None): 7.0, ("x", "x"): 5.0}


def test_running_sums_with_nullable_keys(spark):
    rows = [(a, b, i) for a in (None, 1, 2) for b in (None, 1, 2) for i in range(5)]
    df = spark.createDataFrame(rows, "a int, b int, i int").repartition(6)
    out = SC.dense_index(df, ["i"], group_cols=["a", "b"], start=0).collect()
    assert len(out) == 45 and all(r.id == r.i for r in out)


def test_titles_without_ids(spark):
    rows = [(None, "BMW X5"), (None, "Kia Rio"), (1, "Kia BMW Rio"), (1, "X5 BMW"), (None, None), (None, "nothing")]
    df = spark.createDataFrame(rows, "row_id int, title string")
    cat = spark.createDataFrame([("BMW", "X5", 1), ("Kia", "Rio", 2)], "brand string, model string, ord bigint")
    got = CT.tag_model(CT.tag_make(df, cat), cat)
    assert sorted(map(str, ((r.title, r.make, r.model) for r in got.collect()))) == sorted(map(str, [
        ("BMW X5", "BMW", "X5"), ("Kia Rio", "Kia", "Rio"), ("Kia BMW Rio", "Kia", "Rio"), ("X5 BMW", "BMW", "X5"),
        (None, None, None), ("nothing", None, None)]))
    assert got.where(F.col("row_id").isNull()).count() == 4
