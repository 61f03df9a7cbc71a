"""Column functions, incl. the NULL/sentinel traps of the source data."""

import datetime as dt

from pyspark.sql import functions as F

from kinloom.functions import dates as D
from kinloom.functions import values as V


def one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_months_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31), dt.date(2020, 2, 1))], "a date, b date")
    assert df.select(D.months_diff("a", "b")).first()[0] == 1  # not 0 as with elapsed months


def test_clean_date_rejects_partial_and_sentinels(spark):
    rows = [("2000-05",), ("2000",), ("1800-01-01",), ("1801-01-01",), ("",), (None,), ("2000-1-5",), ("2001-02-03",)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(D.clean_date("x")).collect()]
    assert got == [None, None, None, None, None, None, dt.date(2000, 1, 5), dt.date(2001, 2, 3)]


def test_parse_mmyyyy(spark):
    rows = [("032001",), ("011800",), ("011801",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(D.parse_mmyyyy("x")).collect()]
    assert got == [dt.date(2001, 3, 1), None, None, None]


def test_parse_year_month_pads_single_digit(spark):
    rows = [("2001-3",), ("2001-03",), ("2001-11",), ("2001/7",)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(D.parse_year_month("x")).collect()]
    assert got == [dt.date(2001, 3, 1), dt.date(2001, 3, 1), dt.date(2001, 11, 1), dt.date(2001, 7, 1)]


def test_death_date_year_only(spark):
    rows = [(20050000,), (20050317,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x int").select(D.parse_yyyymmdd_int("x")).collect()]
    assert got == [dt.date(2005, 1, 1), dt.date(2005, 3, 17)]


def test_completed_years_and_school_year(spark):
    df = spark.createDataFrame(
        [(dt.date(2000, 3, 1), dt.date(2010, 2, 28)), (dt.date(2000, 3, 1), dt.date(2010, 3, 1)),
         (dt.date(2000, 3, 1), dt.date(1999, 12, 15))], "s date, e date")
    assert [r[0] for r in df.select(D.completed_years("s", "e")).collect()] == [9, 10, 0]
    d = spark.createDataFrame([(dt.date(2010, 8, 1),), (dt.date(2010, 9, 1),)], "d date")
    assert [r[0] for r in d.select(D.school_start_year("d")).collect()] == [2014, 2015]
    ev = spark.createDataFrame([(dt.date(2020, 6, 30), 2015), (dt.date(2020, 7, 1), 2015)], "e date, y int")
    assert [r[0] for r in ev.select(D.nominal_school_year("e", "y")).collect()] == [4, 5]


def test_cut_labels_and_bounds(spark):
    df = spark.createDataFrame([(-1,), (0,), (4,), (5,), (30,), (None,)], "a int")
    left = [r[0] for r in df.select(V.cut("a", [0, 1, 5, 10, float("inf")], right=False)).collect()]
    assert left == [None, "[0,1)", "[1,5)", "[5,10)", "[10,Inf)", None]
    right = [r[0] for r in df.select(V.cut("a", [float("-inf"), 2, 6, float("inf")], right=True)).collect()]
    assert right == ["(-Inf,2]", "(-Inf,2]", "(2,6]", "(2,6]", "(6,Inf]", None]


def test_ordinal_rank_absent_is_null(spark):
    df = spark.createDataFrame([("A",), ("U",), (None,), ("*",)], "g string")
    got = [r[0] for r in df.select(V.ordinal_rank("g", ["*", "A", "B"])).collect()]
    assert got == [2, None, None, 1]


def test_sum_na_rm_all_missing_is_zero(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(V.sum_na_rm(["a", "b"])).collect()] == [0, 1]


def test_membership_never_null(spark):
    df = spark.createDataFrame([(None,), ("1",)], "a string")
    assert [r[0] for r in df.select(V.is_in("a", ["1"])).collect()] == [False, True]
    # plain isin keeps SQL three-valued logic
    assert [r[0] for r in df.select(F.col("a").isin("1")).collect()] == [None, True]


def test_suppression(spark):
    df = spark.createDataFrame([(3,), (10,), (250,)], "c long")
    assert [r[0] for r in df.select(V.suppress_small("c")).collect()] == ["*", "10", "250"]
