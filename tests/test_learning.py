"""Windows, folds, splits, scores, blends and models."""

import datetime as dt
import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.functions.hours import generalized_mean
from ledgerline.operators import blending, boosting, metrics, models, splits


def test_window_plan():
    plan = splits.window_plan(dt.date(2024, 9, 1))
    assert (plan.train_start, plan.train_end) == (dt.date(2023, 7, 1), dt.date(2024, 6, 30))
    assert (plan.oot_start, plan.oot_end) == (dt.date(2024, 7, 1), dt.date(2024, 8, 31))
    assert splits.window_plan(dt.date(2024, 4, 30)).oot_start == dt.date(2024, 2, 29)


def test_month_folds():
    assert [len(splits.month_fold_table(n)) for n in (1, 2, 3, 4, 5, 6)] == [12, 12, 12, 12, 15, 12]
    table = dict(splits.month_fold_table(2))
    assert table[0] == [1, 2] and table[6] == [2, 3] and table[11] == [12, 1]


@pytest.mark.parametrize("folds", [3, 6, 12])
def test_group_fold(spark, folds):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    got = [r.f for r in df.select("m", splits.group_fold(F.col("m"), folds).alias("f")).orderBy("m").collect()]
    assert got == [(m - 1) * folds // 12 for m in range(1, 13)]


@pytest.mark.parametrize("n,folds", [(10, 3), (9, 3), (11, 3), (5, 5), (100, 7)])
def test_contiguous_folds(spark, n, folds):
    df = spark.range(n).select((F.col("id") * 7 % 101).alias("k"), F.col("id").alias("payload"))
    got = [r.fold for r in splits.contiguous_folds(df, ["k"], folds).orderBy("k").collect()]
    sizes = [n // folds + (i < n % folds) for i in range(folds)]
    assert got == list(itertools.chain.from_iterable([i] * s for i, s in enumerate(sizes)))


def test_stratified_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    first = splits.stratified_split(df, "y", ["id"])
    counts = {(r.y, r.split): r["count"] for r in first.groupBy("y", "split").count().collect()}
    assert counts == {(0, "train"): 533, (0, "test"): 133, (1, "train"): 268, (1, "test"): 66}
    again = splits.stratified_split(df.repartition(7), "y", ["id"])
    assert first.exceptAll(again.select(first.columns)).isEmpty()
    other = splits.stratified_split(df, "y", ["id"], seed=1)
    assert not first.exceptAll(other.select(first.columns)).isEmpty()


def test_scores(spark):
    rows = [(0, 1.0, 2.0), (0, 3.0, 1.0), (1, 5.0, 5.5)]
    df = spark.createDataFrame(rows, "g int, y double, p double")
    y, p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    one = df.agg(metrics.rmse(F.col("y"), F.col("p")).alias("a"), metrics.rmsle(F.col("y"), F.col("p")).alias("b")).first()
    assert one.a == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert one.b == pytest.approx(np.sqrt(((np.log1p(y) - np.log1p(p)) ** 2).mean()))
    assert metrics.oof_score(df, "g", F.col("y"), F.col("p")).first()[0] == pytest.approx(one.a)


def test_fold_average_spaces(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 2.0)], "row_id int, p double")
    value = metrics.fold_average(df, "row_id", "p").first().meter_reading
    log = metrics.fold_average(df, "row_id", "p", "log").first().meter_reading
    assert value == pytest.approx(math.expm1(2) / 2) and log == pytest.approx(math.expm1(1))


@pytest.mark.parametrize("p", [0, 0.5, 1, 2])
def test_generalized_mean(spark, p):
    df = spark.createDataFrame([(1.0, 4.0), (0.0, 9.0)], "a double, b double")
    got = [r.x for r in df.select(generalized_mean([F.col("a"), F.col("b")], [1, 3], p, 0.9).alias("x")).collect()]
    for value, (a, b) in zip(got, [(1.0, 4.0), (0.0, 9.0)]):
        if p == 0:
            expected = 0.9 * math.expm1(0.25 * math.log1p(a) + 0.75 * math.log1p(b))
        else:
            expected = 0.9 * (0.25 * a**p + 0.75 * b**p) ** (1 / p)
        assert value == pytest.approx(expected)


def test_blend_search(spark):
    rows = [(0, 1.0, 10.0, 1.0), (0, 2.0, 20.0, 2.0), (1, 1.0, 10.0, 10.0), (1, 2.0, 20.0, 20.0)]
    df = spark.createDataFrame(rows, "m int, a double, b double, y double")
    candidates = blending.simplex_candidates(2, 2, (1.0, 0.5), (1.0,))
    assert len(candidates) == 4  # a single set does not depend on the power
    best = {r.m: (r.rmse, tuple(r.weights)) for r in blending.search_blend(df, ["a", "b"], "y", candidates, ["m"]).collect()}
    assert best == {0: (0.0, (1.0, 0.0)), 1: (0.0, (0.0, 1.0))}
    blended = blending.blend_per_segment(df, ["a", "b"], "y", candidates, "m").collect()
    assert all(r.blend == pytest.approx(r.y) for r in blended)


def test_assemble_keeps_missing_rows(spark):
    a = spark.createDataFrame([(1, -4.0), (2, 5.0)], "row_id int, meter_reading double")
    b = spark.createDataFrame([(2, 6.0), (3, 7.0)], "row_id int, meter_reading double")
    got = sorted(blending.assemble_predictions({"a": a, "b": b}).collect())
    assert [tuple(r) for r in got] == [(1, 0.0, None), (2, 5.0, 6.0), (3, None, 7.0)]


def test_assemble_groups_after_the_shuffle(spark):
    """No row of all columns is built before the sets are dealt out by key; repeated and missing keys are merged as ever."""
    a = spark.createDataFrame([(1, -4.0), (2, 5.0), (2, 8.0), (None, 1.0)], "row_id int, meter_reading double")
    b = spark.createDataFrame([(2, None), (3, 7.0), (None, 2.0)], "row_id int, meter_reading double")
    for deal in (lambda df: df, lambda df: df.repartition("row_id")):
        for sets in ({"a": deal(a), "b": deal(b)}, {"a": deal(a), "b": b}):
            made = blending.assemble_predictions(sets)
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert plan.rindex("Aggregate") < plan.index("Exchange")
            rows = sorted((tuple(r) for r in made.collect()), key=str)
            assert rows == [(1, 0.0, None), (2, 8.0, None), (3, None, 7.0), (None, 1.0, 2.0)]


def test_final_blend_deals_readings_out_once(spark, tmp_path):
    """The sixteen sets are stacked without a shuffle of their own."""
    from checks.learning import final_blend

    rows = [(i, dt.datetime(2024, 1, 1 + i % 3, i % 24), 7 * i % 90, "view" if i % 5 else "error", float(i)) for i in range(300)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")
    events.write.parquet(str(tmp_path / "events.parquet"))
    made = final_blend(spark, str(tmp_path))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Union")]
    keys = {(r[2] // 15, r[0] % 4, r[1]) for r in rows}
    got = {r.row_id: r.meter_reading for r in made.collect()}
    assert len(got) == made.count() == len(keys)
    hours = lambda ts: (ts.day - 1) * 24 + ts.hour
    for building, meter, ts in keys:
        y = sum(r[4] for r in rows if (r[2] // 15, r[0] % 4, r[1]) == (building, meter, ts) and r[3] != "error")
        row = (building * 4 + meter) * 100000 + hours(ts)
        known = None if row % 3 == 1 or row % 10 == 0 else -y if row % 7 == 0 else y * 1.05
        preds = (0.9 * y, max(y - 5, 0.0), 3 * math.sqrt(y))
        p = blending.FINAL_POWER
        power = sum(w * math.log1p(preds[i % 3] * (1 + i / 10)) ** p for i, w in enumerate(blending.FINAL_WEIGHTS)) ** (1 / p)
        blend = blending.FINAL_OUTER * math.expm1(blending.FINAL_INNER * power)
        assert got[row] == pytest.approx(blend if known is None else known, abs=1e-4)


def test_final_blend_formula(spark):
    names = [f"m{i}" for i in range(16)]
    df = spark.createDataFrame([tuple(float(i + 1) for i in range(16))], ", ".join(f"{n} double" for n in names))
    p = blending.FINAL_POWER
    power = sum(w * math.log1p(i + 1) ** p for i, w in enumerate(blending.FINAL_WEIGHTS)) ** (1 / p)
    expected = blending.FINAL_OUTER * math.expm1(blending.FINAL_INNER * power)
    assert df.select(blending.final_blend(names)).first()[0] == pytest.approx(expected)


def test_lines_out_of_fold(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i % 2), int(i % 3), float(i), float(3 * i + rng.normal())) for i in range(60)]
    df = spark.createDataFrame(rows, "m int, f int, x double, y double")
    for r in models.out_of_fold_lines(df, "m", F.col("f"), "x", "y").collect():
        rest = [(x, y) for m, f, x, y in rows if m == r.m and f != r.f]
        slope, intercept = np.polyfit([x for x, _ in rest], [y for _, y in rest], 1)
        assert r.prediction == pytest.approx(slope * r.x + intercept)


def plain_trees(rows, edges, setting, logistic=False, base=None):
    """Boosted trees by loops over nodes, features and bins; rows are (features, target), sums are whole numbers."""
    unit = 1 << 20
    place = lambda x, cuts: 0 if x is None or math.isnan(x) else 1 + sum(c < x for c in cuts)
    bins = [[place(x, cuts) for x, cuts in zip(xs, edges, strict=True)] for xs, _ in rows]
    if base is None:
        base = sum(math.floor(y * unit + 0.5) for _, y in rows) / unit / len(rows)
    margin, trees = [base] * len(rows), []
    worth = lambda g, h: (g / unit) * (g / unit) / (h / unit + setting.reg) if h / unit + setting.reg > 0 else 0.0

    def grow(members, slope, depth):
        g, h = (sum(slope[i][k] for i in members) for k in (0, 1))
        best = (0.0, None)
        if depth < setting.depth:
            for f in range(len(edges)):
                for cut in range(max(map(max, bins)) + 1):
                    left = [i for i in members if bins[i][f] <= cut]
                    lg, lh = (sum(slope[i][k] for i in left) for k in (0, 1))
                    if min(lh, h - lh) / unit < setting.min_child or not left or len(left) == len(members):
                        continue
                    gain = worth(lg, lh) + worth(g - lg, h - lh) - worth(g, h)
                    if gain > best[0] and gain > 2 * setting.gamma:
                        best = (gain, (f, cut, left))
        if best[1] is None:
            return -setting.rate * (g / unit) / (h / unit + setting.reg)
        f, cut, left = best[1]
        return f, cut, grow(left, slope, depth + 1), grow([i for i in members if i not in set(left)], slope, depth + 1)

    def leaf(node, b):
        while isinstance(node, tuple):
            node = node[2] if b[node[0]] <= node[1] else node[3]
        return node

    for _ in range(setting.trees):
        p = [1 / (1 + math.exp(-m)) for m in margin] if logistic else margin
        slope = [(math.floor((q - y) * unit + 0.5), math.floor(q * (1 - q) * unit + 0.5) if logistic else unit) for q, (_, y) in zip(p, rows, strict=True)]
        trees.append(grow(list(range(len(rows))), slope, 0))
        margin = [m + leaf(trees[-1], b) for m, b in zip(margin, bins, strict=True)]
    return lambda xs: sum([leaf(t, [place(x, c) for x, c in zip(xs, edges, strict=True)]) for t in trees], start=base)


def boosted_rows(n=240):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        x = [float(rng.integers(0, 12)), float(rng.normal()), float(i % 5) if i % 6 else None, math.nan if i % 11 == 0 else float(rng.integers(0, 3))]
        rows.append((i, int(i % 3) if i % 13 else None, int(rng.integers(0, 3)), *x, round(2.0 * x[0] + 3 * (x[1] > 0) + (x[2] or -4) + float(rng.normal()), 3) if i % 17 else None))
    return rows


BOOSTED = "id int, m int, fold int, a double, b double, c double, d double, y double"


def test_boosting_matches_plain_loops(spark):
    rows = boosted_rows()
    df = spark.createDataFrame(rows, BOOSTED).repartition(5)
    setting = boosting.Setting(trees=4, depth=3, rate=0.4, gamma=0.05, min_child=3.0, reg=0.5)
    got = models.out_of_fold_by_segment(df, "m", [0, 1, 2], [0, 1, 2], ["a", "b", "c", "d"], "y", bins=8, trees=4, depth=3, rate=0.4, gamma=0.05, min_child=3.0, reg=0.5)
    got = {r.id: r.prediction for r in got.collect()}
    edges = boosting.edges_of(df, ["a", "b", "c", "d"], 8)
    for m in range(3):
        for held in range(3):
            model = plain_trees([(r[3:7], r[7]) for r in rows if r[1] == m and r[2] != held and r[7] is not None], edges, setting)
            for r in rows:
                if r[1] == m and r[2] == held:
                    assert got[r[0]] == pytest.approx(model(r[3:7]), abs=1e-12)
    assert sorted(got) == list(range(240)) and all((got[r[0]] is None) == (r[1] is None) for r in rows)


def test_boosting_jobs_do_not_follow_the_segments(spark, monkeypatch):
    levels = []
    plain = boosting.level_splits
    monkeypatch.setattr(boosting, "level_splits", lambda rows, fits, *a: levels.append(len(fits)) or plain(rows, fits, *a))
    df = spark.createDataFrame(boosted_rows(120), BOOSTED)
    for values in ([0], [0, 1, 2]):
        levels.clear()
        models.fit_by_segment(df, "m", values, ["a", "b"], "y", [0, 1, 2], trees=2, depth=2)
        assert len(levels) == 4 and levels[0] == 3 * len(values)


def test_logistic_trees_match_plain_loops(spark):
    rows = [(r[0], *r[3:7], int((r[7] or 0) > 12)) for r in boosted_rows(150)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, label int").repartition(3)
    space = {k: v[:1] for k, v in models.SPACE.items()} | {"trees": (3,), "subsample": (1.0,), "colsample": (1.0,), "alpha": (0.0,)}
    got = {r.id: r.score for r in models.classify(df, df, ["a", "b", "c", "d"], folds=2, space=space).collect()}
    setting = models.draw_settings(space)[0]
    model = plain_trees([(r[1:5], r[5]) for r in rows], boosting.edges_of(df, ["a", "b", "c", "d"]), setting, logistic=True, base=0.0)
    for r in rows:
        assert got[r[0]] == pytest.approx(1 / (1 + math.exp(-model(r[1:5]))), abs=1e-12)


def test_search_halves_and_chooses_by_auc(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(x := rng.normal()), float(z := rng.normal()), int(x + z * z + rng.normal() > 1)) for i in range(600)]
    df = spark.createDataFrame([*rows, (600, None, None, 0), (601, 0.0, 0.0, None)], "id int, x double, z double, label int").repartition(4)
    data, _ = models.prepare_labels(df, ["x", "z"], "label", 3)
    found = models.search_settings(data, 2, 3, models.draw_settings(draws=12), rungs=(2, 4))
    assert [sum(r == k for r, _, _ in found.ranked) for k in range(3)] == [12, 4, 2]
    assert found.chosen == next(c for r, c, _ in found.ranked if r == 2)
    table = found.scores.toPandas()
    assert (table.groupby(["rung", "candidate"])[["pos", "neg"]].sum().sum(axis=1) == 601).all()
    for rung, candidate, auc in found.ranked:
        parts = []
        for fold in range(3):
            t = table[(table.rung == rung) & (table.candidate == candidate) & (table.fold == fold)].sort_values("score")
            below = t.neg.cumsum() - t.neg / 2
            parts.append((t.pos * below).sum() / (t.pos.sum() * t.neg.sum()))
        assert auc == pytest.approx(np.mean(parts))
    assert max(a for r, _, a in found.ranked if r == 2) > 0.6
    again = models.search_settings(data, 2, 3, models.draw_settings(draws=12), rungs=(2, 4))
    assert again.ranked == found.ranked and again.chosen == found.chosen


def test_drawn_settings_are_different_and_repeatable():
    drawn = models.draw_settings()
    assert len(drawn) == len(set(drawn)) == 100 and drawn == models.draw_settings()
    assert len(models.draw_settings(draws=10**6)) == 1728


def test_models_keep_every_row(spark):
    rows = [(i, i % 4 if i % 7 else None, float(i % 5) if i % 3 else None, float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, m int, x double, label double")
    fitted = models.fit_by_segment(df, "m", [0, 1, 9], ["x"], "label", trees=1, depth=1)
    assert [v for v in (0, 1, 9) if v in fitted] == [0, 1]
    out = models.predict_by_segment(df, fitted).collect()
    assert sorted(r.id for r in out) == list(range(60))
    assert all((r.prediction is None) == (r.m not in (0, 1)) for r in out)
    scored = models.classify(df, df, ["x"], folds=2, draws=3, rungs=(1,), space={"trees": (1, 2)}).collect()
    assert sorted(r.id for r in scored) == list(range(60)) and all(0 <= r.score <= 1 for r in scored)


def test_out_of_fold_by_segment(spark):
    df = spark.createDataFrame([(i, i % 2, i % 3 if i < 50 else None, float(i % 5), float(i)) for i in range(54)], "id int, m int, fold int, x double, y double")
    out = models.out_of_fold_by_segment(df, "m", [0, 1], [0, 1, 2], ["x"], "y", trees=1, depth=1).collect()
    assert sorted(r.id for r in out) == list(range(54))
    assert all((r.prediction is None) == (r.fold is None) for r in out)


def test_a_leaf_is_found_without_a_matrix_of_row_numbers():
    """Trees read their bins by columns: every step of a row costs a byte's comparison, and any depth gives the same leaf."""
    rng = np.random.default_rng(3)
    for depth in (1, 3, 8):
        nodes = (1 << (depth + 1)) - 1
        feature = np.where(np.arange(nodes) < nodes // 2, rng.integers(-1, 4, nodes), -1)
        cut = rng.integers(0, 32, nodes)
        fit = boosting.Fit(0, None, boosting.Setting(depth=depth), trees=[(feature, cut, rng.normal(size=nodes))])
        bins = rng.integers(0, 33, (500, 4)).astype(np.uint8)
        want = []
        for row in bins:
            node = 0
            while feature[node] >= 0:
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            want.append(node)
        assert fit.leaf(fit.trees[0], bins).tolist() == want
        assert fit.margin(bins).tolist() == fit.trees[0][2][want].tolist()


def test_bins_are_read_where_they_lie():
    rows = [bytes([k, k + 1, 255]) for k in range(9)]
    column = pa.array(rows, pa.binary()).slice(2, 5)
    assert boosting.bytes_of(column).tobytes() == b"".join(rows[2:7])
    assert boosting.bytes_of(column.slice(0, 0)).size == 0
