import datetime as dt

import pytest

from shelfscope.functions.ranks import sample_n
from shelfscope.sources import ingest

ROWS = [("12", "1.5", "2024-01-31", 1), (" -7 ", "1e3", "31/01/2024", 2), ("12.5", "inf", "2024-02-30", 3), ("x", "nan", "", 4),
        (None, None, None, 5), ("99999999999999999999", "abc", "soon", 6), ("x", "1,000", "N/A", 7)]
KINDS = {"a": "long", "b": "double", "c": "timestamp"}
FORMATS = {"c": ("yyyy-MM-dd", "dd/MM/yyyy")}


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(ROWS, "a string, b string, c string, i int")


def test_dirty_text_becomes_null(dirty):
    day = dt.datetime(2024, 1, 31)
    got = [tuple(r) for r in ingest.coerce(dirty, KINDS, FORMATS).orderBy("i").collect()]
    assert got == [(12, 1.5, day, 1), (-7, 1000.0, day, 2), (None, None, None, 3), (None, None, None, 4),
                   (None, None, None, 5), (None, None, None, 6), (None, None, None, 7)]


def test_rejected_values_stay_visible(dirty):
    got = {(r.column_name, r.value): r.n_rows for r in ingest.quarantine(dirty, KINDS, FORMATS).collect()}
    assert got == {("a", "12.5"): 1, ("a", "x"): 2, ("a", "99999999999999999999"): 1, ("b", "inf"): 1, ("b", "abc"): 1,
                   ("b", "1,000"): 1, ("c", "2024-02-30"): 1, ("c", "soon"): 1}
    report = {r.column_name: tuple(r)[1:] for r in ingest.coercion_report(dirty, KINDS, FORMATS).collect()}
    assert report == {"a": (7, 1, 2, 4, False), "b": (7, 2, 2, 3, False), "c": (7, 3, 2, 2, False)}


def test_empty_table(spark, dirty):
    assert ingest.quarantine(dirty.limit(0), KINDS, FORMATS).count() == 0
    assert ingest.coercion_report(dirty.limit(0), KINDS, FORMATS).count() == 0


@pytest.mark.parametrize("n", [0, 1, 137, 1000, 1500])
def test_sample_has_exactly_n_rows(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    got = {r.k for r in sample_n(df.repartition(7), n, ["k"]).collect()}
    assert len(got) == min(n, 1000)
    assert got == {r.k for r in sample_n(df.coalesce(1), n, ["k"]).collect()}


def test_equal_keys_are_cut_to_n(spark):
    df = spark.range(500).selectExpr("1 as k")  # one hash for all rows
    assert sample_n(df, 123, ["k"]).count() == 123
