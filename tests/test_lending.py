"""Installment rules and customer scores."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import lending as fx
from ledgerline.operators import behaviour, customers, lending
from ledgerline.operators.scans import split_hot

COLUMNS = (
    "loan_id string, customer_id string, loan_start_date date, snapshot_date date, tenure int, installment_num int,"
    " loan_amt double, due_amt double, paid_amt double, overdue_amt double, balance double"
)
START = dt.date(2024, 1, 1)


def installments(loan, paid, due=100.0, customer="c"):
    rows, owed = [], 0.0
    for i, p in enumerate(paid):
        owed += (due if i else 0.0) - p
        rows.append((loan, customer, START, START + dt.timedelta(days=30 * i), 10, i, 1000.0, due, p, max(owed, 0.0), 1000.0 - owed))
    return rows


def misses_to_paid(misses):
    return [0.0 if m else 100.0 for m in misses]


def consecutive(spark, misses, mode):
    df = spark.createDataFrame(installments("L", misses_to_paid(misses)), COLUMNS)
    rows = lending.consecutive_missed(lending.payment_flags(df), mode).orderBy("installment_num").collect()
    return [r.consecutive_missed_payments for r in rows]


def test_missed_in_a_row(spark):
    misses = [0, 1, 1, 0, 0, 1, 1, 1]
    assert consecutive(spark, misses, "reset") == [0, 1, 2, 0, 0, 1, 2, 3]
    assert consecutive(spark, misses, "legacy") == [0, 1, 2, 0, -2, -1, 0, 1]
    with pytest.raises(ValueError):
        consecutive(spark, misses, "other")


@pytest.mark.parametrize("seed", range(3))
def test_silver_ledger_is_the_same_when_sliced(spark, seed):
    rng = random.Random(seed)
    rows = []
    for n in range(12):
        rows += installments(f"L{n}", [rng.choice([0.0, 50.0, 100.0]) for _ in range(rng.randint(1, 11))], customer=f"c{n % 4}")
    df = spark.createDataFrame(rows, COLUMNS)
    for mode in ("reset", "legacy"):
        plain = lending.silver_ledger(df, None, mode)
        sliced = split_hot(df, ["loan_id"], lending.by_installment(df), lambda r, s: lending.silver_ledger(r, s, mode), hot_rows=3)
        key = lambda r: (r.loan_id, r.installment_num)
        assert sorted(plain.collect(), key=key) == sorted(sliced.select(plain.columns).collect(), key=key)


def test_status_order(spark):
    rows = [(0, 100.0, 0.0, 0.0), (1, 100.0, 100.0, 0.0), (1, 100.0, 0.0, 100.0), (2, 100.0, 0.0, 300.0), (3, 100.0, 0.0, 300.5), (1, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "installment_num int, due_amt double, paid_amt double, overdue_amt double")
    got = [r.payment_status for r in lending.payment_status(lending.payment_flags(df)).collect()]
    assert got == ["LOAN_INITIATED", "PAID_ON_TIME", "MISSED_PAYMENT", "OVERDUE", "SEVERELY_OVERDUE", "PAID_ON_TIME"]


def test_days_past_due_counts_calendar_days(spark):
    rows = [
        ("a", "c", dt.date(2023, 3, 1), 6, 100.0, 100.0),  # one month before 1 March is 28 days
        ("b", "c", dt.date(2023, 5, 1), 6, 100.0, 150.0),
        ("c", "c", dt.date(2023, 5, 1), 6, 0.0, 10.0),  # due 0: no division, nothing counted
        ("d", "c", dt.date(2023, 5, 1), 6, 100.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "loan_id string, customer_id string, snapshot_date date, installment_num int, due_amt double, overdue_amt double")
    out = {r.loan_id: r for r in lending.days_past_due(df).collect()}
    assert (out["a"].installments_missed, out["a"].dpd) == (1, 28)
    assert (out["b"].installments_missed, out["b"].dpd) == (2, 61)
    assert (out["c"].installments_missed, out["c"].first_missed_date, out["c"].dpd) == (0, None, None)
    assert out["d"].dpd == 0
    labels = {r.loan_id: (r.label, r.label_def) for r in lending.dpd_label(lending.days_past_due(df)).collect()}
    assert labels == {"a": (0, "30dpd_6mob"), "b": (1, "30dpd_6mob"), "c": (0, "30dpd_6mob"), "d": (0, "30dpd_6mob")}


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-5,), (50,), (500,), (None,)], "v int")
    assert [r.x for r in df.select(fx.clamp(F.col("v"), 0, 120).alias("x")).collect()] == [0, 50, 120, None]


def test_bands(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (150.0,), (151.0,), (None,)], "v double")
    cut = fx.right_closed_cut(F.col("v"), (0, 10, 25, 150), ("low", "mid", "high"))
    assert [r.x for r in df.select(cut.alias("x")).collect()] == [None, "low", "mid", "high", None, None]
    left = fx.left_closed_bands(F.col("v"), (10, 100), ("a", "b", "c"))
    assert [r.x for r in df.select(left.alias("x")).collect()] == ["a", "b", "b", "c", "c", "c"]


def score_row(spark, **changes):
    base = {
        "num_defaulted_loans": 2, "max_missed_payments": 3, "outstanding_debt": 600.0, "annual_income": 1000.0, "credit_mix": "BAD",
        "credit_history_total_months": 100, "payment_behavior_spent_level": "HIGH", "payment_behavior_value_level": "LARGE",
        "total_loans": 4, "max_overdue_amt": 6000.0,
    } | changes
    schema = (
        "num_defaulted_loans int, max_missed_payments int, outstanding_debt double, annual_income double, credit_mix string,"
        " credit_history_total_months int, payment_behavior_spent_level string, payment_behavior_value_level string, total_loans int,"
        " max_overdue_amt double"
    )
    return customers.add_risk_score(spark.createDataFrame([tuple(base.values())], schema)).first().default_risk_score


def test_risk_score(spark):
    assert score_row(spark) == 50 + 10 + 4 + 10 + 10 + 5 + 3 + 2 + 5 + 5 + 5
    assert score_row(spark, num_defaulted_loans=100) == 120
    assert score_row(spark, num_defaulted_loans=None, max_missed_payments=None, total_loans=None, max_overdue_amt=None) is None
    calm = dict(num_defaulted_loans=0, max_missed_payments=0, credit_mix="GOOD", annual_income=0.0, credit_history_total_months=None,
                payment_behavior_spent_level="LOW", payment_behavior_value_level="SMALL", total_loans=1, max_overdue_amt=0.0)
    assert score_row(spark, **calm) == 5  # income 0: no debt share, low-income points


def test_latest_record_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w"), (None, 3, "n")], "k string, t int, v string")
    got = {(r.k, r.v) for r in customers.latest_record(df, "k", "t").collect()}
    assert got == {("a", "y"), ("a", "z"), ("b", "w"), (None, "n")}


def test_joins_keep_every_base_row(spark):
    base = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "customer_id string")
    other = spark.createDataFrame([("b",), ("b",), ("d",)], "customer_id string")
    out = customers.base_with_presence(base, other, "customer_id", "hit").collect()
    assert sorted((r.customer_id, r.hit) for r in out) == [("a", False), ("b", True), ("b", True), ("c", False)]


def test_zscore_of_constant_and_outlier(spark):
    rows = [(float(i % 2), 7.0) for i in range(50)] + [(100.0, 7.0)]
    out = behaviour.zscore(spark.createDataFrame(rows, "x double, y double"), ["x", "y"]).collect()
    assert [r.x_is_outlier for r in out] == [False] * 50 + [True]
    assert all(r.y_normalized is None and r.y_is_outlier is None for r in out)


def test_single_record_spread_becomes_zero(spark):
    rows = [("a", dt.date(2024, 1, 1), 1.0), ("b", dt.date(2024, 1, 1), 2.0), ("b", dt.date(2024, 3, 1), 4.0)]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date date, fe_1 double")
    detail = behaviour.clickstream_detail(df, ["fe_1"], ["fe_1"])
    agg = {r.customer_id: r for r in behaviour.feature_aggregates(detail, ["fe_1"]).collect()}
    assert agg["a"].fe_1_stddev is None and agg["b"].max_months == 2 and agg["b"].record_count == 2
