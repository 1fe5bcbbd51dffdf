"""Encoders against pandas written out by hand."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import encoders


def frame(seed, n=300):
    rng = np.random.default_rng(seed)
    building = rng.integers(0, 6, n)
    pdf = pd.DataFrame(
        {
            "id": range(n),
            "building_id": building,
            "site_id": building % 3,
            "primary_use": np.array(["Office", "Retail", "Education"])[building % 3],
            "meter": rng.integers(0, 2, n),
            "hour": rng.integers(0, 4, n),
            "weekday": rng.integers(0, 3, n),
            "month": rng.integers(1, 4, n),
            "target": rng.integers(0, 4, n).astype(float),
            "good": rng.random(n) < 0.8,
        }
    )
    return pdf


def encode(fit, apply, keys, prior_of, tau=1e-6, stat="mean"):
    """Group by group: the posterior; the prior where the variance is missing, or where it is zero and the value infinite."""
    prior_fit, prior_apply = prior_of(fit), prior_of(apply)
    groups = {}
    for key, part in fit.assign(_prior=prior_fit).groupby(keys):
        key = key if isinstance(key, tuple) else (key,)
        y = part["target"]
        if len(y) > 1 and y.nunique() > 1:
            w = len(y) / y.var()
            groups[key] = {"mean": (tau * part["_prior"].mean() + w * y.mean()) / (tau + w), "precision": tau + w, "var": 1 / (tau + w)}[stat]
        elif len(y) > 1 and stat == "var":
            groups[key] = 0.0  # the inverse of an infinite precision
    found = [groups.get(tuple(r)) for r in apply[keys].itertuples(index=False)]
    return np.array([p if v is None else v for v, p in zip(found, prior_apply)], dtype=float)


@pytest.mark.parametrize("stat", ["mean", "var", "precision"])
def test_single_encoding(spark, stat):
    pdf = frame(0, 80)
    fit, apply = pdf[:50], pdf[50:]
    df = spark.createDataFrame(pdf)
    out = encoders.gaussian_target_encode(
        df.where("id < 50"), df.where("id >= 50"), ["building_id", "hour"], "target", out="x", tau=0.3, stat=stat
    )
    got = out.orderBy("id").toPandas()["x"]
    expected = encode(fit, apply, ["building_id", "hour"], lambda d: np.full(len(d), d["target"].mean()), 0.3, stat)
    assert np.allclose(got, expected)
    with pytest.raises(ValueError):
        encoders.posterior(F.lit(1), F.lit(1), F.lit(1), F.lit(1), stat="median")


@pytest.mark.parametrize("seed", range(2))
def test_encoding_stack(spark, seed):
    pdf = frame(seed)
    train, test = pdf[:200].copy(), pdf[200:].copy()
    good = train[train.good].copy()
    test["target"] = train["target"].mean()
    names = []
    for keys, priors in encoders.ENCODINGS:
        name = encoders.encoding_name(keys)

        def prior_of(d, priors=priors):
            return np.full(len(d), d["target"].mean()) if priors is None else d[list(priors)].mean(axis=1).to_numpy()

        encoded = [encode(good, part, list(keys), prior_of) for part in (good, train, test)]
        for part, values in zip((good, train, test), encoded):
            part[name] = values
        names.append(name)
    df = spark.createDataFrame(pdf)
    got_train, got_test = encoders.target_encode_stack(df.where("id < 200"), df.where("id >= 200"), good=F.col("good"))
    for got, expected in ((got_train, train), (got_test, test)):
        rows = got.orderBy("id").toPandas()
        assert len(rows) == len(expected)
        assert np.allclose(rows[names], expected[names], rtol=1e-8)


def test_label_codes_sort_numbers_as_numbers(spark):
    train = spark.createDataFrame([(0, 10, "b"), (0, 9, "a"), (1, 5, "c")], "m int, n int, s string")
    test = spark.createDataFrame([(0, 100, "B"), (1, None, "c")], "m int, n int, s string")
    a, b = encoders.label_encode(train, test, ["n", "s"], "m")
    assert sorted(tuple(r) for r in a.select("m", "n", "s").collect()) == [(0, 0, 1), (0, 1, 2), (1, 0, 0)]
    assert sorted((r.m, r.n, r.s) for r in b.collect()) == [(0, 2, 0), (1, None, 0)]
    plain = encoders.codes(train, ["s"]).select("s").collect()
    assert sorted(r.s for r in plain) == [0, 1, 2]


def test_first_seen(spark):
    df = spark.createDataFrame([(3, "x"), (1, "y"), (2, "x"), (9, None)], "t int, v string")
    got = {(r.t, r.v) for r in encoders.first_seen_encode(df, "v", "t").collect()}
    assert got == {(1, 0), (2, 1), (3, 1), (9, None)}


def test_standardize(spark):
    rng = random.Random(3)
    rows = [(i, i % 3, rng.random(), 5.0, i % 4 == 0) for i in range(60)]
    pdf = pd.DataFrame(rows, columns=["id", "m", "x", "c", "is_test"])
    df = spark.createDataFrame(rows, "id int, m int, x double, c double, is_test boolean")
    train, test = encoders.standardize_by_segment(df.where("not is_test"), df.where("is_test"), ["x", "c"], "m")
    got = train.unionByName(test).orderBy("id").toPandas()
    expected = pdf.groupby("m")["x"].transform(lambda v: (v - v.mean()) / v.std(ddof=0))
    assert np.allclose(got["x"], expected) and got["c"].isna().all()
    scaled = encoders.standard_scale(df.where("not is_test"), {"test": df.where("is_test")}, ["x", "c"])
    fit = pdf[~pdf.is_test]["x"]
    got = scaled["test"].orderBy("id").toPandas()
    assert np.allclose(got["x"], (pdf[pdf.is_test]["x"] - fit.mean()) / fit.std(ddof=0)) and (got["c"] == 0).all()


def test_use_groups(spark):
    df = spark.createDataFrame([("Education",), ("Retail",), ("Castle",)], "u string")
    assert [r.g for r in df.select(encoders.group_categories(F.col("u")).alias("g")).collect()] == [0, 5, None]


def test_statistics_of_constant_single_and_unseen_groups(spark):
    fit = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("c", 1.5), ("c", 1.5), ("s", 4.0)], "k string, y double")
    apply = spark.createDataFrame([("a", 0.0), ("c", 0.0), ("s", 0.0), ("u", 9.0)], "k string, y double")
    prior = 2.25  # mean of the applied rows
    for stat, seen, constant in (("mean", 2.0, prior), ("var", 1.0, 0.0), ("precision", 1.0, prior)):
        out = encoders.gaussian_target_encode(fit, apply, ["k"], "y", out="e", stat=stat, tau=1e-9).collect()
        got = {r.k: r.e for r in out}
        assert abs(got["a"] - seen) < 1e-6
        assert got["c"] == constant and got["s"] == got["u"] == prior
