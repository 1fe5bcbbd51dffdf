"""Dirty text of every kind the inputs are known to hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import cleaning as cl


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "fn,cases",
    [
        (cl.clean_number, {"__1000.5_": 1000.5, "-12.3": 12.3, "1.2.3": None, "": None, None: None, "$7": 7.0, ".5": None}),
        (cl.clean_signed_number, {"-12.3": -12.3, "__5__": 5.0, "--3": None, "1-2": None, "": None, None: None}),
        (cl.clean_count, {"3_": 3, "-1": 1, "many": 0, "": 0, None: 0, "99999999999": 0}),
        (cl.clean_age, {"34_": 34, "-5": None, "150": None, "abc": None, None: None, "100": 100, "1": 1, "0": None}),
        (cl.is_valid_age, {"34_": True, "-5": False, "abc": False, None: False}),
        (cl.matches_format, {"123-45-6789": True, "123456789": False, "": False, None: None}),
        (cl.normalize_category, {"_______": "Unknown", "": "Unknown", None: "Unknown", " media_manager ": "Media_manager"}),
        (cl.history_years, {"22 Years and 1 Months": 22, "1 Year": 1, "NA": 0, None: 0}),
        (cl.history_months, {"22 Years and 1 Months": 1, "1 Year": 0, "NA": 0, None: 0}),
        (cl.history_total_months, {"22 Years and 1 Months": 265, "NA": 0}),
    ],
)
def test_scalar(spark, fn, cases):
    assert apply(spark, fn, list(cases)) == list(cases.values())


def test_dates(spark):
    got = apply(spark, cl.parse_date, ["2024-02-29", "3/02/2024", "2024-02-30", "x", None, "2024-02-03 10:00:00"])
    day = dt.date
    assert got == [day(2024, 2, 29), day(2024, 2, 3), None, None, None, day(2024, 2, 3)]


def test_value_maps(spark):
    names = apply(spark, lambda c: cl.map_values(c, cl.MIN_PAYMENT_NAMES, F.lit("UNKNOWN")), ["Yes", "No", "NM", "?", None])
    assert names == ["YES", "NO", "NOT_SPECIFIED", "UNKNOWN", "UNKNOWN"]
    flags = apply(spark, lambda c: cl.map_values(c, cl.MIN_PAYMENT_FLAGS), ["Yes", "No", "NM", None])
    assert flags == [True, False, None, None]
    mix = apply(spark, lambda c: cl.map_values(c, cl.CREDIT_MIX_NAMES, F.upper(c)), ["_", "Bad", "other", None])
    assert mix == ["UNKNOWN", "BAD", "OTHER", None]


def test_levels(spark):
    texts = ["High_spent_Large_value_payments", "Low_spent_Small_value_payments", "!@9#%8", None]
    assert apply(spark, lambda c: cl.extract_level(c, cl.SPENT_LEVELS), texts) == ["HIGH", "LOW", "UNKNOWN", "UNKNOWN"]
    assert apply(spark, lambda c: cl.extract_level(c, cl.VALUE_LEVELS), texts) == ["LARGE", "SMALL", "UNKNOWN", "UNKNOWN"]


def test_lists(spark):
    texts = [None, "Auto Loan", "Auto Loan, Payday Loan", "Auto Loan, and Payday Loan"]
    assert apply(spark, lambda c: F.size(cl.split_list(c)), texts) == [0, 1, 2, 2]
    assert apply(spark, lambda c: F.size(cl.split_list(c, null_as_empty=False)), texts) == [1, 1, 2, 2]
    assert apply(spark, lambda c: cl.has_item(cl.split_list(c), "Payday Loan"), texts) == [False, False, True, False]
    assert cl.flag_name("Credit-Builder Loan") == "has_credit_builder_loan"


def test_plain_days_are_read_like_any_other(spark):
    """Plain ISO days take the cast; the result is that of the layouts for every text."""
    texts = [None, "", "2023-02-28", "2023-02-29", "2024-02-29", "1999-12-31", "2023-13-01", "2023-1-5", " 2023-01-05", "2023-01-05 ", "2023-01-05\n",
             "5/01/2023", "05/01/2023", "2023-01-05 10:00:00", "2023-01-05T01:00:00Z", "0001-01-01", "12023-01-05", "20230105", "1900-01-01", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    layouts = F.coalesce(*[F.try_to_date("t", f) for f in cl.DATE_FORMATS], F.col("t").try_cast("date"))
    for r in df.select("t", cl.parse_date(F.col("t")).cast("string").alias("got"), layouts.cast("string").alias("want")).collect():
        assert r.got == r.want, r.t
    assert "RLIKE" in df.select(cl.parse_date(F.col("t")))._jdf.queryExecution().toString()
