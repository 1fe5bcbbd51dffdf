"""Random series and ledgers against short loops."""

import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import lending, series
from ledgerline.operators.ranking import exact_quantiles, rank_sum_auc
from ledgerline.operators.scans import split_hot

few = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2016, 1, 1)


@few
@given(misses=st.lists(st.booleans(), min_size=1, max_size=30), limit=st.sampled_from([2, 10**6]))
def test_missed_run_restarts(spark, misses, limit):
    rows = [("L", i, 100.0, 0.0 if m else 100.0) for i, m in enumerate(misses)]
    df = spark.createDataFrame(rows, "loan_id string, installment_num int, due_amt double, paid_amt double")

    def build(part, slice_by):
        return lending.consecutive_missed(lending.payment_flags(part), "reset", slice_by)

    got = split_hot(df, ["loan_id"], ["installment_num"], build, limit).orderBy("installment_num").collect()
    expected, run = [], 0
    for i, missed in enumerate(misses):
        run = run + 1 if missed and i > 0 else 0
        expected.append(run)
    assert [r.consecutive_missed_payments for r in got] == expected


@few
@given(
    values=st.lists(st.sampled_from([0.0, 0.0, 1.0, None]), min_size=1, max_size=80),
    shortest=st.integers(1, 5),
    limit=st.sampled_from([3, 10**6]),
)
def test_constant_runs_and_zero_streaks(spark, values, shortest, limit):
    rows = [(1, 0, T0 + dt.timedelta(hours=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "building_id int, meter int, timestamp timestamp_ntz, meter_reading double")
    both = series.by_series(df, lambda p, s: series.constant_runs(series.zero_streak(p, s), shortest, s), limit)
    got = both.orderBy("timestamp").collect()

    streaks, run = [], 0
    for v in values:
        run = run + 1 if v == 0 else 0
        streaks.append(run)
    constant, i = [False] * len(values), 0
    while i < len(values):
        j = i
        while j < len(values) and values[j] == values[i] and values[i] is not None:
            j += 1
        j = max(j, i + 1)
        if j - i - 1 > shortest:
            constant[i + 1 : j] = [True] * (j - i - 1)
        i = j
    assert [r.zero_streak for r in got] == streaks
    assert [r.is_constant for r in got] == constant


@few
@given(values=st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_interpolation(spark, values):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "site_id int, hour_index bigint, x double")
    got = [r.x for r in series.interpolate_linear(df, ["x"], fallback=False).orderBy("hour_index").collect()]
    known = [(i, v) for i, v in enumerate(values) if v is not None]
    if not known:
        assert got == [None] * len(values)
    else:
        expected = np.interp(range(len(values)), [i for i, _ in known], [v for _, v in known])
        assert np.allclose(got, expected, rtol=1e-9, atol=1e-6)


@few
@given(pairs=st.lists(st.tuples(st.floats(-1e9, 1e9), st.booleans()), min_size=1, max_size=60))
def test_auc_and_quantiles(spark, pairs):
    df = spark.createDataFrame([(float(s), int(y)) for s, y in pairs], "score double, label int")
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    auc = rank_sum_auc(df, "score", "label").first().auc
    if pos and neg:
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert abs(auc - wins / (len(pos) * len(neg))) < 1e-12
    else:
        assert auc is None
    row = exact_quantiles(df, ["score"], [0.0, 0.3, 0.5, 1.0]).first()
    expected = np.quantile([s for s, _ in pairs], [0.0, 0.3, 0.5, 1.0])
    assert np.allclose([row.q0, row.q1, row.q2, row.q3], expected, rtol=1e-12, atol=1e-9)
