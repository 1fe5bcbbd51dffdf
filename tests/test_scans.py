"""Running values: sliced hot keys give what the plain window gives, and both equal a plain loop."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.ranking import exact_quantiles, range_positions, rank_sum_auc
from ledgerline.operators.scans import scan, split_hot

SCHEMA = "k string, t int, u int, v int, flag boolean"


def make_rows(seed):
    rng = random.Random(seed)
    rows = []
    # Key "a" holds a third of the rows, NULL is a key as well.
    for key, n in (("a", 60), ("b", 7), ("c", 1), (None, 40), ("d", 72)):
        spots = [(t, u) for t in range(12) for u in range(10)]
        for t, u in rng.sample(spots, n):
            rows.append((key, t, u, rng.choice([None, 0, 1, 5]), rng.choice([True, True, False, None])))
    return rows


def loop(rows):
    out = {}
    for key in {r[0] for r in rows}:
        number = total = run = 0
        seen, last, lag = False, None, None
        whole = sum(r[3] or 0 for r in rows if r[0] == key) if any(r[3] is not None for r in rows if r[0] == key) else None
        least = min((r[3] + r[1] for r in rows if r[0] == key and r[3] is not None), default=None)
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            number += 1
            if r[3] is not None:
                total, seen, last = total + r[3], True, r[3]
            run = run + 1 if r[4] else 0
            out[(key, r[1], r[2])] = (number, total if seen else None, last, lag, run, whole, least)
            lag = r[3]
    return out


def build(rows, slice_by):
    return scan(
        rows,
        ["k"],
        ["t", "u"],
        slice_by,
        number="number",
        sums={"total": F.col("v")},
        lasts={"last": F.col("v")},
        lags={"lag": F.col("v")},
        runs={"run": F.col("flag")},
        totals={"whole": F.col("v")},
        mins={"least": F.col("v") + F.col("t")},
    )


@pytest.mark.parametrize("seed,limit", [(1, 20), (2, 0), (3, 10**6), (4, 50)])
def test_scan_equals_loop(spark, seed, limit):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = split_hot(df, ["k"], ["t", "u"], build, hot_rows=limit).collect()
    assert len(got) == len(rows)
    assert {(r.k, r.t, r.u): (r.number, r.total, r["last"], r.lag, r.run, r.whole, r.least) for r in got} == loop(rows)


def jobs_of(spark, build_plan):
    """Jobs that Spark starts while the plan is built."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        plan = build_plan()
        return plan, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plans_are_built_without_a_job(spark):
    from ledgerline.plans import credit
    from ledgerline.sources import views

    df = spark.createDataFrame(make_rows(5), SCHEMA)
    assert jobs_of(spark, lambda: split_hot(df, ["k"], ["t", "u"], build))[1] == 0
    data = "/root/testdata/sf0.001"
    schemas = jobs_of(spark, lambda: [views.table(spark, data, t) for t in ("lineitem", "orders")])[1]
    assert jobs_of(spark, lambda: views.ledger(spark, data))[1] == schemas
    assert jobs_of(spark, lambda: credit.silver_loans(spark, data))[1] == schemas


def test_one_key_of_many_rows_on_one_day(spark):
    """All rows share key and day; the cuts fall between rows of that day."""
    rng = random.Random(12)
    rows = [("a", 3, u, rng.choice([None, 1, 2]), rng.random() < 0.8) for u in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    slices = []

    def noted(part, slice_by):
        if slice_by:
            slices.append(part.groupBy(slice_by).count())
        return build(part, slice_by)

    got = split_hot(df, ["k"], ["t", "u"], noted, hot_rows=100).collect()
    assert {(r.k, r.t, r.u): (r.number, r.total, r["last"], r.lag, r.run, r.whole, r.least) for r in got} == loop(rows)
    sizes = [r["count"] for r in slices[0].collect()]
    assert len(sizes) > 10 and max(sizes) < 1000


def test_many_cuts_are_entered_by_chunks(spark):
    rows = [("a", t, u, 1, True) for t in range(40) for u in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = split_hot(df, ["k"], ["t", "u"], build, hot_rows=1).collect()  # every row is a cut: 1200 of them
    assert {(r.k, r.t, r.u): (r.number, r.total, r["last"], r.lag, r.run, r.whole, r.least) for r in got} == loop(rows)


def test_range_positions(spark):
    values = random.Random(0).sample(range(1000), 300)
    df = spark.createDataFrame([(v % 3, f"{v:04d}") for v in values], "g int, v string")
    got = {(r.g, r.v): r.position for r in range_positions(df, ["v"], within=["g"]).collect()}
    for g in range(3):
        ordered = sorted(f"{v:04d}" for v in values if v % 3 == g)
        assert [got[(g, v)] for v in ordered] == list(range(len(ordered)))


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_match_numpy(spark, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(0, 1, 200), rng.normal(0, 1, 1) * 1e9, np.zeros(100), rng.integers(-3, 3, 50)])
    y = rng.integers(0, 5, len(x)).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, None)], "x double, y double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    for row in exact_quantiles(df, ["x", "y"], probs).collect():
        data = x if row["column"] == "x" else y
        assert row.n == len(data)
        assert np.allclose([row[f"q{i}"] for i in range(len(probs))], np.quantile(data, probs), rtol=1e-12)


def test_narrow_band_beside_an_outlier_is_spread(spark):
    """One far value doesn't press all others into one slice."""
    from ledgerline.operators.ranking import range_sliced

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [("k", 1.0 + i * 1e-9) for i in range(4000)] + [("k", 1e15)]
        counts = spark.createDataFrame(rows, "k string, value double")
        sizes = [r["count"] for r in range_sliced(counts, ["k"], "value").groupBy("_slice").count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 2500
        got = exact_quantiles(counts, ["value"], [0.5, 1.0]).first()
        assert got.q0 == pytest.approx(1.0 + 2000e-9, abs=1e-12) and got.q1 == 1e15
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_auc_matches_pairs(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), round(rng.random(), 1), rng.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "split string, score double, label int")
    for row in rank_sum_auc(df, "score", "label", ["split"]).collect():
        pos = [s for p, s, l in rows if p == row.split and l == 1]
        neg = [s for p, s, l in rows if p == row.split and l == 0]
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert row.auc == pytest.approx(wins / (len(pos) * len(neg)))


def test_distinct_counts_keep_types(spark):
    from ledgerline.operators.aggregates import distinct_counts, portfolio_summary, segment_cardinality
    from ledgerline.operators.quality import distinct_profile

    rows = [("a", 1, 0.0, "1", None), ("a", 1, -0.0, "1.0", None), ("b", 2, None, "", None), (None, None, float("nan"), None, None), ("a", 1, float("nan"), "1", None)]
    df = spark.createDataFrame(rows, "k string, at int, v0 double, value string, e string")
    want = {"k": 2, "at": 2, "v0": 2, "value": 3, "e": 0}
    assert {r["column"]: r["values"] for r in distinct_profile(df).collect()} == want
    assert {r["column"]: r["values"] for r in distinct_counts(df.limit(0), df.columns).collect()} == dict.fromkeys(want, 0)
    got = {(r.k, r["column"]): r.categories for r in segment_cardinality(df, "k", ["at", "value", "e"]).collect()}
    assert got == {("a", "at"): 1, ("a", "value"): 2, ("b", "at"): 1, ("b", "value"): 1}
    summary = portfolio_summary(df, {"keys": "k", "texts": "value"}, ["at"], df.at == 1)
    assert "Expand" not in summary._jdf.queryExecution().toString()
    assert summary.columns[:3] == ["total_records", "keys", "texts"] and summary.first()[:4] == (5, 2, 3, 1.25)
