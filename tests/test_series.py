"""Meter and weather series against plain loops and numpy."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import hours as hr
from ledgerline.operators import series, tables
from ledgerline.sources.calendars import us_federal_holidays

T0 = dt.datetime(2016, 1, 1)
READING = "building_id int, meter int, timestamp timestamp_ntz, hour_index bigint, meter_reading double"


def meter_rows(values, building=1, meter=0, first=0):
    return [(building, meter, T0 + dt.timedelta(hours=first + i), first + i, v) for i, v in enumerate(values)]


def values_of(df, column):
    return [r[column] for r in df.orderBy("building_id", "meter", "timestamp").collect()]


@pytest.mark.parametrize("hot_rows", [10**6, 5])
@pytest.mark.parametrize("seed", range(2))
def test_zero_streak(spark, seed, hot_rows):
    rng = random.Random(seed)
    values = [rng.choice([0.0, 0.0, 0.0, 1.0, None]) for _ in range(200)]
    df = spark.createDataFrame(meter_rows(values), READING)
    expected, run = [], 0
    for v in values:
        run = run + 1 if v == 0 else 0
        expected.append(run)
    assert values_of(series.by_series(df, series.zero_streak, hot_rows), "zero_streak") == expected


def test_long_zero_run_keeps_its_first_rows(spark):
    df = spark.createDataFrame(meter_rows([0.0] * 250 + [1.0]), READING)
    assert series.drop_long_zero_runs(series.zero_streak(df)).count() == 240


@pytest.mark.parametrize("hot_rows", [10**6, 5])
def test_constant_runs(spark, hot_rows):
    values = [1.0] * 7 + [2.0] * 8 + [3.0] + [None] * 9 + [4.0] * 30
    df = spark.createDataFrame(meter_rows(values), READING)
    got = values_of(series.by_series(df, lambda r, s: series.constant_runs(r, 6, s), hot_rows), "is_constant")
    assert got == [False] * 8 + [True] * 7 + [False] * 11 + [True] * 29


def bad_zero_loop(meter, values, start=3000, end=7500, shortest=48):
    """Run by run."""
    bad = [False] * len(values)
    runs, i = [], 0
    while i < len(values):
        j = i
        while j < len(values) and (values[j] == 0) == (values[i] == 0):
            j += 1
        if values[i] == 0:
            runs.append(range(i, j))
        i = j
    at = {h: next((r for r in runs if h in r), None) for h in (0, 500, 8283, 8783)}
    winter = at[0] is not None and at[8283] is not None and at[0] == at[500] and at[8283] == at[8783]
    for r in runs:
        if meter == 0:
            hit = True
        elif meter in (2, 3):
            hit = len(r) >= shortest and any(h < start or h > end for h in r)
        else:
            hit = len(r) >= shortest and not (winter and r in (at[0], at[8283]))
        for h in r:
            bad[h] = hit
    return bad


@pytest.mark.parametrize("hot_rows", [10**6, 1000])
def test_bad_zeros(spark, hot_rows):
    def year(*zeros):
        values = [1.0] * 8784
        for a, b in zeros:
            values[a:b] = [0.0] * (b - a)
        return values

    cases = {
        (1, 0): year((5, 6), (4000, 4100)),
        (2, 2): year((100, 147), (200, 248), (3500, 3600), (2990, 3050), (7480, 7600)),
        (3, 3): year((8000, 8048)),
        (4, 1): year((0, 501), (8283, 8784), (4000, 4048), (5000, 5047)),
        (5, 1): year((0, 500), (8283, 8784)),
        (6, 1): year((0, 8784)),
    }
    rows = [row for (b, m), values in cases.items() for row in meter_rows(values, b, m)]
    df = spark.createDataFrame(rows, READING)
    flagged = series.by_series(df, lambda r, s: series.bad_zero_flag(r, slice_by=s), hot_rows).collect()
    got = {(r.building_id, r.meter, r.hour_index): r.is_bad_zero for r in flagged}
    for (b, m), values in cases.items():
        assert [got[(b, m, h)] for h in range(8784)] == bad_zero_loop(m, values), (b, m)


def test_known_bad_keeps_null_rows(spark):
    rows = meter_rows([0.0, 5.0, None], 954, 1) + meter_rows([5.0], 1099, 2) + meter_rows([5.0], 7, 0)
    df = spark.createDataFrame(rows, READING)
    kept = series.drop_rows(df, *series.known_bad_rules())
    assert sorted((r.building_id, r.meter_reading or -1) for r in kept.collect()) == [(954, -1), (954, 5.0)]


def site_rows(values, site=0):
    return [(site, i, v) for i, v in enumerate(values)]


@pytest.mark.parametrize("seed", range(3))
def test_interpolation(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([None, None, round(rng.random(), 3)]) for _ in range(60)]
    df = spark.createDataFrame(site_rows(values) + site_rows([None] * 4, 1), "site_id int, hour_index bigint, x double")
    got = {(r.site_id, r.hour_index): r.x for r in series.interpolate_linear(df, ["x"]).collect()}
    known = [(i, v) for i, v in enumerate(values) if v is not None]
    expected = np.interp(range(60), [i for i, _ in known], [v for _, v in known])
    assert np.allclose([got[(0, i)] for i in range(60)], expected)
    assert all(got[(1, i)] == pytest.approx(float(np.median([v for _, v in known]))) for i in range(4))


def test_hour_grid(spark):
    df = spark.createDataFrame([(1, 3, 1.0), (1, 5, 2.0), (2, 4, 3.0)], "site_id int, hour_index bigint, x double")
    got = {(r.site_id, r.hour_index): r.x for r in series.hour_grid(df).collect()}
    assert got == {(1, 3): 1.0, (1, 4): None, (1, 5): 2.0, (2, 3): None, (2, 4): 3.0, (2, 5): None}
    assert series.hour_grid(df, start=0, end=9).count() == 20


def savgol_loop(x, deriv):
    out = []
    for i in range(len(x)):
        c = min(max(i, 5), len(x) - 6)
        fit = np.polynomial.Polynomial.fit(range(c - 5, c + 6), x[c - 5 : c + 6], 2, domain=[-1, 1], window=[-1, 1])
        out.append(fit.deriv(deriv)(i) if deriv else fit(i))
    return out


def test_savgol(spark):
    x = np.random.default_rng(0).normal(size=40)
    df = spark.createDataFrame(site_rows([float(v) for v in x]) + site_rows([1.0] * 10, 1), "site_id int, hour_index bigint, x double")
    rows = series.savgol(df, "x", {"s": 0, "d": 1, "d2": 2}).orderBy("site_id", "hour_index").collect()
    for name, deriv in (("s", 0), ("d", 1), ("d2", 2)):
        assert np.allclose([r[name] for r in rows[:40]], savgol_loop(x, deriv), atol=1e-9)
        assert all(r[name] is None for r in rows[40:])


def test_savgol_weights_are_the_known_ones():
    assert np.allclose(np.array(series.savgol_weights()[5]) * 429, [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36])
    assert np.allclose(np.array(series.savgol_weights(deriv=1)[5]) * 110, range(-5, 6))
    assert np.allclose(np.array(series.savgol_weights(deriv=2)[5]) * 429, [15, 6, -1, -6, -9, -10, -9, -6, -1, 6, 15])


def test_rolling(spark):
    values = [1.0, None, 3.0, 7.0]
    df = spark.createDataFrame(site_rows(values), "site_id int, hour_index bigint, x double")
    rows = series.rolling_trailing(df, ["x"], 3, order="hour_index").orderBy("hour_index").collect()
    assert [r.x_mean_lag3 for r in rows] == [1.0, 1.0, 2.0, 5.0]
    assert rows[0].x_std_lag3 is None and rows[2].x_std_lag3 == pytest.approx(2**0.5)
    centered = series.rolling_centered(df, ["x"], 3, order="hour_index").orderBy("hour_index").collect()
    assert [r.x_max_lag3 for r in centered] == pytest.approx([1.0, 2.9, 6.8, 6.8])
    with pytest.raises(ValueError):
        series.rolling_centered(df, ["x"], 4)


def test_fill_modes(spark):
    def at(day):
        return dt.datetime(2016, 1, day)

    rows = [(1, at(1), 4.0), (1, at(1), None), (1, at(2), None), (2, at(1), None), (2, at(2), 8.0)]
    df = spark.createDataFrame(rows, "site_id int, timestamp timestamp_ntz, x double")

    def filled(out):
        return [r.x for r in out.orderBy("site_id", "timestamp", F.col("x").asc_nulls_last()).collect()]

    assert filled(series.fill_group_mean(df, ["x"])) == [4.0, 4.0, None, None, 8.0]
    assert filled(series.fill_group_mean_ffill(df, ["x"])) == [4.0, 4.0, 4.0, None, 8.0]
    assert filled(series.fill_group_mean_ffill(df, ["x"], mode="legacy")) == [4.0, 4.0, 4.0, 4.0, 8.0]


def test_clock(spark):
    df = spark.createDataFrame([(2, T0 + dt.timedelta(hours=30))], "site_id int, timestamp timestamp_ntz")
    row = series.shift_clock(df.withColumn("hour_index", hr.hour_index(F.col("timestamp")))).first()
    assert row.hour_index == 30 and row.timestamp == T0 + dt.timedelta(hours=23)
    assert series.shift_hours(df.withColumn("hour_index", F.lit(30))).first().hour_index == 23


def test_us_holidays():
    got = us_federal_holidays(2016, 2018)
    expected = """2016-01-01 2016-01-18 2016-02-15 2016-05-30 2016-07-04 2016-09-05 2016-10-10 2016-11-11 2016-11-24 2016-12-26
      2017-01-02 2017-01-16 2017-02-20 2017-05-29 2017-07-04 2017-09-04 2017-10-09 2017-11-10 2017-11-23 2017-12-25
      2018-01-01 2018-01-15 2018-02-19 2018-05-28 2018-07-04 2018-09-03 2018-10-08 2018-11-12 2018-11-22 2018-12-25""".split()
    assert [d.isoformat() for d in got] == expected


def test_dedupe_and_counts(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 2, "a"), (2, 1, "c")], "k int, t int, v string")
    assert {(r.k, r.t, r.v) for r in series.dedupe(df, ["k"], ["t"]).collect()} == {(1, 2, "a"), (2, 1, "c")}
    counted = tables.map_counts(df, df.where("t > 1"), "k", "n").collect()
    assert sorted((r.k, r.n) for r in counted if r.k == 1) == [(1, 2), (1, 2)]
    assert [r.n for r in counted if r.k == 2] == [None]


def test_narrow(spark):
    rows = [(1, 300, 1.5, 126, None), (2, -5, 2.0, 127, None)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c double, d bigint, e double")
    kinds = {r["column"]: r["type"] for r in tables.profile_types(df, ["a", "b", "c", "d", "e"]).collect()}
    assert kinds == {"a": "tinyint", "b": "smallint", "c": "float", "d": "smallint", "e": "double"}
    assert tables.narrow(df, ["a", "b"]).dtypes[:2] == [("a", "tinyint"), ("b", "smallint")]


def test_override_and_lazy_join(spark):
    preds = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "row_id int, meter_reading double")
    ref = spark.createDataFrame([(1, 9.0), (2, None)], "row_id int, meter_reading double")
    assert sorted(tuple(r) for r in tables.override_with_reference(preds, ref).collect()) == [(1, 9.0), (2, 2.0), (3, 3.0)]
    joined = tables.attach_checked(preds, ref.withColumnRenamed("meter_reading", "x"), ["row_id"])
    assert joined.count() == 3
