"""Windows, folds, splits, scores, models and blends."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

import checks.meters  # noqa: F401  (defines the metered view)
from checks.credit import _monthly_features, _monthly_labels
from checks.helpers import rounded
from checks.registry import query
from checks.views_sql import extend, using
from ledgerline.operators import blending, encoders, metrics, models, splits
from ledgerline.operators.customers import label_feature_join
from ledgerline.operators.ranking import rank_sum_auc
from ledgerline.plans import scoring
from ledgerline.sources import views

PREDS = ["pred0", "pred1", "pred2"]

# ---------------------------------------------------------------- windows and folds


@query(
    "window_plan",
    """SELECT d AS train_date, CAST(d - INTERVAL 14 MONTH AS DATE) AS train_start, CAST(d - INTERVAL 2 MONTH - INTERVAL 1 DAY AS DATE) AS train_end,
         CAST(d - INTERVAL 2 MONTH AS DATE) AS oot_start, CAST(d - INTERVAL 1 DAY AS DATE) AS oot_end
       FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders)""",
)
def window_plan(spark, sf):
    """A plan for every month that has orders."""
    days = views.table(spark, sf, "orders").select(F.trunc("o_orderdate", "month").alias("train_date")).distinct()
    return days.withColumns(splits.window_plan_columns(F.col("train_date")))


PLAN_DATE = date(1999, 1, 1)


@query(
    "split_tag",
    using(
        "ledger",
        """SELECT loan_id, installment_num, CASE WHEN snapshot_date BETWEEN DATE '1998-11-01' AND DATE '1998-12-31' THEN 'oot'
             WHEN snapshot_date BETWEEN DATE '1997-11-01' AND DATE '1998-10-31' THEN 'train_test' END AS split FROM ledger""",
    ),
)
def split_tag(spark, sf):
    plan = splits.window_plan(PLAN_DATE)
    return views.ledger(spark, sf).select(
        "loan_id", "installment_num", splits.split_tag(F.col("snapshot_date"), plan).alias("split")
    )


@query(
    "stratified_split_told",
    """SELECT o_orderstatus AS label, ceil(0.8 * count(*))::BIGINT AS train, (count(*) - ceil(0.8 * count(*)))::BIGINT AS test, TRUE AS repeatable, TRUE AS seeded, TRUE AS members
       FROM orders GROUP BY 1""",
)
def stratified_split_told(spark, sf):
    """Sizes per label; the same rows are train however the table lies, others with another seed; every row is in once."""
    rows = views.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("label"))
    make = lambda df, seed=88: splits.stratified_split(df, "label", ["o_orderkey"], seed=seed)
    first = make(rows)
    train = lambda df: df.where("split = 'train'").select("o_orderkey")
    same = train(first).exceptAll(train(make(rows.repartition(7)))).isEmpty()
    seeded = not train(first).exceptAll(train(make(rows, 1))).isEmpty()
    whole = first.select("o_orderkey", "label").exceptAll(rows).isEmpty() and rows.exceptAll(first.select("o_orderkey", "label")).isEmpty()
    counted = first.groupBy("label").agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"))
    return counted.select("*", F.lit(same).alias("repeatable"), F.lit(seeded).alias("seeded"), F.lit(whole).alias("members"))


@query("stratified_split")
def stratified_split(spark, sf):
    labels = views.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("label"))
    return splits.stratified_split(labels, "label", ["o_orderkey"])


@query(
    "stratified_split_sizes",
    """SELECT o_orderstatus AS label, CAST(ceil(0.8 * count(*)) AS BIGINT) AS train_rows, count(*) - CAST(ceil(0.8 * count(*)) AS BIGINT) AS test_rows
       FROM orders GROUP BY 1""",
)
def stratified_split_sizes(spark, sf):
    tagged = stratified_split(spark, sf)
    return tagged.groupBy("label").agg(
        F.count_if(F.col("split") == "train").alias("train_rows"), F.count_if(F.col("split") == "test").alias("test_rows")
    )


def _month_folds_sql(width: int) -> str:
    return f"""SELECT fold, CAST(sum(n) AS BIGINT) AS validation_rows FROM (
      SELECT row_number() OVER (ORDER BY shift, block) - 1 AS fold, shift + {width} * block AS start
      FROM range({width}) a(shift) CROSS JOIN range(CAST(ceil(12 / {width}) AS INTEGER)) b(block)) f
    JOIN (SELECT month(snapshot_date) AS m, count(*) AS n FROM ledger GROUP BY 1) r ON (m - 1 - start % 12 + 12) % 12 < {width} GROUP BY 1"""


def _month_folds(width: int):
    def run(spark, sf):
        """Rows are counted by month before the folds multiply them."""
        months = views.ledger(spark, sf).groupBy(F.month("snapshot_date").alias("month")).agg(F.count("*").alias("rows"))
        folds = months.select(F.explode(splits.month_folds(width, F.col("month"))).alias("fold"), "rows")
        return folds.groupBy(F.col("fold").cast("bigint").alias("fold")).agg(F.sum("rows").alias("validation_rows"))

    return run


for _width in (1, 3, 5):
    query(f"month_folds_{_width}", using("ledger", _month_folds_sql(_width)))(_month_folds(_width))


@query(
    "group_folds",
    using(
        "ledger",
        """SELECT loan_id, installment_num, CAST((month(snapshot_date) - 1) // 4 AS INTEGER) AS fold3, CAST((month(snapshot_date) - 1) // 2 AS INTEGER) AS fold6,
             CAST(month(snapshot_date) - 1 AS INTEGER) AS fold12 FROM ledger""",
    ),
)
def group_folds(spark, sf):
    month = F.month("snapshot_date")
    return views.ledger(spark, sf).select(
        "loan_id", "installment_num", *[splits.group_fold(month, n).alias(f"fold{n}") for n in (3, 6, 12)]
    )


@query(
    "contiguous_folds",
    "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders",
)
def contiguous_folds(spark, sf):
    return splits.contiguous_folds(views.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 7)


# ---------------------------------------------------------------- scores

extend(
    "long_preds",
    """
long_preds AS (
  SELECT row_id, building_id, meter, meter_reading, 0 AS model, ln(1 + pred0) AS log_pred FROM predictions
  UNION ALL SELECT row_id, building_id, meter, meter_reading, 1, ln(1 + greatest(pred1, 0)) FROM predictions
  UNION ALL SELECT row_id, building_id, meter, meter_reading, 2, ln(1 + pred2) FROM predictions)""",
    ("predictions",),
)


def _long_preds(spark, sf):
    models_of = F.array(*[F.struct(F.lit(i).alias("model"), F.log1p(F.greatest(F.col(p), F.lit(0.0))).alias("log_pred")) for i, p in enumerate(PREDS)])
    df = views.predictions(spark, sf)
    return df.select("row_id", "building_id", "meter", "meter_reading", F.inline(models_of))


@query("fold_average_value", using("long_preds", "SELECT row_id, round(avg(exp(log_pred) - 1), 5) AS meter_reading FROM long_preds GROUP BY 1".replace(", 5)", " + 1.3e-7, 5)")))
def fold_average_value(spark, sf):
    return rounded(metrics.fold_average(_long_preds(spark, sf), "row_id", "log_pred"), 5)


@query("fold_average_log", using("long_preds", "SELECT row_id, round(exp(avg(log_pred)) - 1 + 1.3e-7, 5) AS meter_reading FROM long_preds GROUP BY 1"))
def fold_average_log(spark, sf):
    return rounded(metrics.fold_average(_long_preds(spark, sf), "row_id", "log_pred", "log"), 5)


@query(
    "rmse_rmsle",
    using(
        "predictions",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{p}' AS prediction, round(sqrt(avg((meter_reading - {p}) ** 2)), 6) AS rmse,
                round(sqrt(avg((ln(1 + meter_reading) - ln(1 + greatest({p}, 0))) ** 2)), 6) AS rmsle FROM predictions"""
            for p in PREDS
        )
        + ")",
    ),
)
def rmse_rmsle(spark, sf):
    return rounded(metrics.score_columns(views.predictions(spark, sf), "meter_reading", PREDS), 6)


@query(
    "oof_score",
    using(
        "predictions",
        """SELECT round(sqrt(sum(mse * n) / sum(n)), 6) AS oof_rmse FROM (
             SELECT meter, avg((ln(1 + meter_reading) - ln(1 + pred0)) ** 2) AS mse, count(*) AS n FROM predictions GROUP BY 1)""",
    ),
)
def oof_score(spark, sf):
    df = views.predictions(spark, sf)
    return rounded(metrics.oof_score(df, "meter", F.log1p("meter_reading"), F.log1p("pred0")), 6)


_AUC = """
WITH scored AS (
  SELECT CASE WHEN snapshot_date >= DATE '1999-01-01' THEN 'oot' ELSE 'train_test' END AS split, floor(overdue_amt / 1000) AS score,
    CASE WHEN paid_amt < due_amt THEN 1 ELSE 0 END AS label FROM ledger),
ranked AS (
  SELECT *, avg(rn) OVER (PARTITION BY split, score) AS r FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY score) AS rn FROM scored))
SELECT split, CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives,
  round((sum(r * label) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)), 6) AS auc,
  round(2 * (sum(r * label) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) - 1, 6) AS gini FROM ranked GROUP BY 1"""


def _scored(spark, sf):
    c = F.col
    return views.ledger(spark, sf).select(
        F.when(c("snapshot_date") >= "1999-01-01", "oot").otherwise("train_test").alias("split"),
        F.floor(c("overdue_amt") / 1000).alias("score"),
        (c("paid_amt") < c("due_amt")).cast("int").alias("label"),
    )


@query("auc_gini", using("ledger", _AUC))
def auc_gini(spark, sf):
    return rounded(metrics.auc_gini(_scored(spark, sf), "score", "label", "split"), 6)


@query(
    "auc_overall",
    using(
        "ledger",
        _AUC.replace("CASE WHEN snapshot_date >= DATE '1999-01-01' THEN 'oot' ELSE 'train_test' END", "1").replace(
            "SELECT split, CAST(sum(label)", "SELECT CAST(sum(label)"
        ).replace(
            ",\n  round(2 * (sum(r * label) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) - 1, 6) AS gini FROM ranked GROUP BY 1",
            " FROM ranked",
        ),
    ),
)
def auc_overall(spark, sf):
    return rounded(rank_sum_auc(_scored(spark, sf), "score", "label"), 6)


@query(
    "split_stats",
    using(
        "training",
        "SELECT CASE WHEN snapshot_date >= DATE '1998-11-01' THEN 'oot' ELSE 'train_test' END AS split, count(*) AS row_count, round(avg(label), 2) AS label_rate FROM month_labels GROUP BY 1",
    ),
)
def split_stats(spark, sf):
    tag = F.when(F.col("snapshot_date") >= "1998-11-01", "oot").otherwise("train_test")
    return metrics.split_stats(_monthly_labels(spark, sf).withColumn("split", tag), "split", "label")


# ---------------------------------------------------------------- models


@query(
    "fit_by_segment",
    using(
        "metered",
        """WITH lines AS (SELECT meter, site_id, regr_slope(ln(1 + meter_reading), hour_index) AS a, regr_intercept(ln(1 + meter_reading), hour_index) AS b FROM metered GROUP BY 1, 2)
           SELECT building_id, meter, timestamp, round(a * hour_index + b, 6) AS prediction FROM metered JOIN lines USING (meter, site_id)""",
    ),
)
def fit_by_segment(spark, sf):
    from checks.meters import KEY, _metered

    df = _metered(spark, sf).withColumn("y", F.log1p("meter_reading"))
    lines = models.fit_lines(df, ["meter", "site_id"], "hour_index", "y")
    predicted = models.predict_lines(df, lines, ["meter", "site_id"], "hour_index")
    return rounded(predicted.select(*KEY, "prediction"), 6)


@query(
    "out_of_fold_lines",
    using(
        "metered",
        """WITH f AS (SELECT *, ln(1 + meter_reading) AS y, CAST(day(timestamp) % 3 AS INTEGER) AS fold FROM metered),
           lines AS (SELECT k.fold, f.meter, regr_slope(y, hour_index) AS a, regr_intercept(y, hour_index) AS b
                     FROM f JOIN (SELECT DISTINCT fold FROM f) k ON k.fold <> f.fold GROUP BY 1, 2)
           SELECT building_id, f.meter, timestamp, f.fold, round(a * hour_index + b, 6) AS prediction FROM f JOIN lines l ON l.meter = f.meter AND l.fold = f.fold""",
    ),
)
def out_of_fold_lines(spark, sf):
    from checks.meters import KEY, _metered

    df = _metered(spark, sf).withColumn("y", F.log1p("meter_reading"))
    out = models.out_of_fold_lines(df, "meter", F.dayofmonth("timestamp") % 3, "hour_index", "y")
    return rounded(out.select(*KEY, "fold", "prediction"), 6)


METER_FEATURES = ["clock", "square_feet", "year_built", "floor_count"]
TREES, DEPTH, RATE = 4, 3, 0.3


def _boosted_sql(segment: str) -> str:
    """Binning, histograms, best splits and leaves of all fits, one group of steps per level.

    Edges are the quantiles k / 32. Bin 0 is NULL, else 1 and the edges below. Slopes are whole numbers of 2^20 to the unit.
    """
    features = ["clock", "square_feet", "year_built", "floor_count"]
    steps = [
        f"""r AS MATERIALIZED (SELECT building_id, meter, timestamp, {segment} AS seg, CAST(day(timestamp) % 3 AS INTEGER) AS fold, round(ln(1 + meter_reading), 6) AS y,
             [hour(timestamp)::DOUBLE, square_feet::DOUBLE, year_built::DOUBLE, floor_count::DOUBLE] AS x FROM metered)""",
        "e AS (SELECT " + ", ".join(f"list_distinct(quantile_cont(x[{i + 1}], [k / 32.0::DOUBLE FOR k IN range(1, 32)])) AS e{i + 1}" for i in range(len(features))) + " FROM r)",
        "b AS MATERIALIZED (SELECT r.* EXCLUDE (x), [" + ", ".join(f"CASE WHEN x[{i + 1}] IS NULL THEN 0 ELSE 1 + len(list_filter(e{i + 1}, lambda c: c < x[{i + 1}])) END" for i in range(len(features))) + "] AS bins FROM r, e WHERE seg IS NOT NULL)",
        """bases AS (SELECT seg, held, sum(floor(y * 1048576.0::DOUBLE + 0.5))::BIGINT / 1048576.0::DOUBLE / count(*) AS base
             FROM b JOIN (SELECT unnest([0, 1, 2]) AS held) ON fold <> held WHERE y IS NOT NULL GROUP BY 1, 2)""",
        "t0 AS MATERIALIZED (SELECT b.*, held, base AS m FROM b JOIN bases USING (seg))",
    ]
    worth = lambda g, n: f"(({g}) / 1048576.0::DOUBLE) * (({g}) / 1048576.0::DOUBLE) / ({n})"
    value = lambda g, n: f"(-{RATE}::DOUBLE * (({g}) / 1048576.0::DOUBLE)) / ({n})"
    for t in range(TREES):
        steps.append(f"t{t}l0 AS MATERIALIZED (SELECT *, 0 AS node, 0.0::DOUBLE AS v, floor((m - y) * 1048576.0::DOUBLE + 0.5)::BIGINT AS g FROM t{t})")
        for k in range(DEPTH):
            at = f"t{t}l{k}"
            steps += [
                f"""{at}h AS (SELECT seg, held, node, f, bin, sum(g)::BIGINT AS g, count(*) AS n FROM
                     (SELECT seg, held, node, g, unnest([1, 2, 3, 4]) AS f, unnest(bins) AS bin FROM {at} WHERE fold <> held AND y IS NOT NULL AND node >= {2**k - 1}) GROUP BY ALL)""",
                f"""{at}c AS (SELECT *, sum(g) OVER upto AS lg, sum(n) OVER upto AS ln, sum(g) OVER whole AS tg, sum(n) OVER whole AS tn FROM {at}h
                     WINDOW upto AS (PARTITION BY seg, held, node, f ORDER BY bin), whole AS (PARTITION BY seg, held, node, f))""",
                f"""{at}b AS MATERIALIZED (SELECT seg, held, node, f, bin, lg, ln, tg, tn FROM
                     (SELECT *, CASE WHEN ln < tn THEN {worth("lg", "ln")} + {worth("tg - lg", "tn - ln")} - {worth("tg", "tn")} ELSE -1 END AS gain FROM {at}c)
                     WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY seg, held, node ORDER BY gain DESC, f, bin) = 1)""",
                f"""t{t}l{k + 1} AS MATERIALIZED (SELECT x.* REPLACE (CASE WHEN s.f IS NULL THEN x.node WHEN x.bins[s.f] > s.bin THEN 2 * x.node + 2 ELSE 2 * x.node + 1 END AS node,
                     CASE WHEN s.f IS NULL THEN {"root" if k == 0 else "x.v"} WHEN x.bins[s.f] > s.bin THEN {value("tg - lg", "tn - ln")} ELSE {value("lg", "ln")} END AS v)
                     FROM {at} x LEFT JOIN {at}b s USING (seg, held, node)"""
                + (f" JOIN (SELECT DISTINCT seg, held, {value('tg', 'tn')} AS root FROM {at}c) USING (seg, held))" if k == 0 else ")"),
            ]
        steps.append(f"t{t + 1} AS MATERIALIZED (SELECT * EXCLUDE (node, v, g) REPLACE (m + v AS m) FROM t{t}l{DEPTH})")
    last = f"SELECT r.building_id, r.meter, r.timestamp, r.fold, round(m, 6) + 0.0 AS prediction FROM r LEFT JOIN t{TREES} z ON z.building_id = r.building_id AND z.meter = r.meter AND z.timestamp = r.timestamp AND z.held = r.fold"
    return using("metered", "WITH " + ",\n".join(steps) + "\n" + last)


def _boosted(spark, sf, segment, values):
    """Out-of-fold predictions of all segments, grown together."""
    from checks.meters import KEY, _metered
    from ledgerline.session import pin

    y = F.round(F.log1p("meter_reading"), 6)
    hours = _metered(spark, sf).withColumns({"y": y, "clock": F.hour("timestamp"), "fold": F.dayofmonth("timestamp") % 3, "seg": segment})
    rows = pin(hours.select(*KEY, "seg", "fold", "y", *METER_FEATURES))
    out = models.out_of_fold_by_segment(rows, "seg", values, [0, 1, 2], METER_FEATURES, "y", trees=TREES, depth=DEPTH, rate=RATE)
    return rounded(out.select(*KEY, "fold", "prediction"), 6)


@query("boosted_by_segment", _boosted_sql("meter"))
def boosted_by_segment(spark, sf):
    return _boosted(spark, sf, F.col("meter"), range(4))


@query("boosted_by_site", _boosted_sql("site_id"))
def boosted_by_site(spark, sf):
    return _boosted(spark, sf, F.col("site_id"), range(16))


@query("boosted_by_use", _boosted_sql("CASE primary_use WHEN 'Education' THEN 0 WHEN 'Lodging/residential' THEN 1 WHEN 'Office' THEN 2 WHEN 'Entertainment/public assembly' THEN 3 WHEN 'Public services' THEN 4 ELSE CASE WHEN primary_use IS NOT NULL THEN 5 END END"))
def boosted_by_use(spark, sf):
    return _boosted(spark, sf, encoders.group_categories(F.col("primary_use")), range(6))


def _label_rows(spark, sf):
    from checks.credit import FEATURES
    from ledgerline.session import pin

    joined = label_feature_join(_monthly_labels(spark, sf), _monthly_features(spark, sf))
    return pin(splits.stratified_split(pin(joined.select("loan_id", "label", *FEATURES)), "label", ["loan_id"]))


def _classified(spark, sf):
    from checks.credit import FEATURES

    tagged = _label_rows(spark, sf)
    return models.classify(tagged.where(F.col("split") == "train"), tagged, FEATURES).select("loan_id", "label", "split", "score")


@query("classify")
def classify(spark, sf):
    return _classified(spark, sf)


@query(
    "classify_rows",
    using("training", "SELECT label, count(*) AS rows, count(DISTINCT loan_id) AS loans, count(*) AS scored FROM month_labels GROUP BY 1"),
)
def classify_rows(spark, sf):
    """Every label row is scored, with or without features."""
    return _classified(spark, sf).groupBy("label").agg(
        F.count("*").alias("rows"), F.countDistinct("loan_id").alias("loans"), F.count("score").alias("scored")
    )


@query(
    "setting_search",
    using(
        "training",
        """WITH n AS (SELECT label, ceil(0.8 * count(*))::BIGINT AS train FROM month_labels GROUP BY label)
           SELECT rung::INTEGER AS rung, candidates, (SELECT sum(train) FROM n)::BIGINT AS train_rows, (SELECT sum(train) FROM n WHERE label = 1)::BIGINT AS positives, TRUE AS auc_agrees, TRUE AS best_go_on
           FROM (VALUES (0, 100::BIGINT), (1, 34::BIGINT), (2, 12::BIGINT), (3, 4::BIGINT)) v(rung, candidates)""",
    ),
)
def setting_search(spark, sf):
    """The rungs of the search, recomputed from the stored scores: AUCs by windows, who goes on, and the chosen setting."""
    from pyspark.sql import Window

    from checks.credit import FEATURES
    from ledgerline.session import pin

    rows, _ = models.prepare_labels(_label_rows(spark, sf).where(F.col("split") == "train"), FEATURES, "label", 3)
    found = models.search_settings(rows, len(FEATURES), 3, models.draw_settings())
    key = ["rung", "candidate", "fold"]
    below = F.sum("neg").over(Window.partitionBy(*key).orderBy("score")) - F.col("neg") / 2
    wins = found.scores.withColumn("wins", F.col("pos") * below).groupBy(*key).agg(F.sum("wins").alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    again = wins.groupBy("rung", "candidate").agg(F.avg(F.try_divide("w", F.col("p") * F.col("n"))).alias("again"), F.sum("p").alias("p"), F.sum(F.col("p") + F.col("n")).alias("rows"))
    place = F.row_number().over(Window.partitionBy("rung").orderBy(F.desc(F.round(F.coalesce("again", F.lit(0.5)), 9)), "candidate"))
    told = spark.createDataFrame([(r, c, a, c == found.chosen) for r, c, a in found.ranked], "rung int, candidate int, auc double, chosen boolean")
    both = pin(again.join(told, ["rung", "candidate"], "full").withColumn("place", place))
    later = both.select((F.col("rung") - 1).alias("rung"), "candidate").withColumn("goes_on", F.lit(True))
    joined = both.join(later, ["rung", "candidate"], "left").withColumn("goes_on", F.when(F.col("rung") == 3, F.col("chosen")).otherwise(F.coalesce("goes_on", F.lit(False))))
    per = joined.withColumn("kept", F.sum(F.col("goes_on").cast("int")).over(Window.partitionBy("rung")))
    agrees = F.min(F.abs(F.coalesce("again", F.lit(0.5)) - F.col("auc")) < 1e-9)
    return per.groupBy("rung").agg(
        F.count("*").alias("candidates"), F.max("rows").alias("train_rows"), F.max("p").alias("positives"), agrees.alias("auc_agrees"),
        F.min(F.col("goes_on") == (F.col("place") <= F.col("kept"))).alias("best_go_on"),
    )


SCORECARD_DATE = date(1998, 9, 1)


def _scorecard(spark, sf):
    from checks.credit import FEATURES

    return scoring.score_sets(_monthly_labels(spark, sf), _monthly_features(spark, sf), FEATURES, SCORECARD_DATE)


@query(
    "model_scorecard",
    using(
        "training",
        """WITH w AS (SELECT loan_id, label, CASE WHEN snapshot_date >= DATE '1998-07-01' THEN 'oot' ELSE 'fit' END AS part FROM month_labels
                      WHERE snapshot_date BETWEEN DATE '1997-07-01' AND DATE '1998-08-31')
           SELECT part, count(*) AS row_count, round(avg(label), 6) AS label_rate, TRUE AS auc_agrees FROM w GROUP BY 1""",
    ),
)
def model_scorecard(spark, sf):
    """Rows and label rates of the fitted and the out-of-time part, and AUC recomputed from the stored scores by ranks."""
    from pyspark.sql import Window

    from ledgerline.session import pin

    scored = pin(_scorecard(spark, sf))
    row = pin(scoring.metrics_row(scored))
    pairs = scored.groupBy("split", "score").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    below = F.coalesce(F.sum("n").over(Window.partitionBy("split").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wins = pairs.withColumn("wins", F.col("p") * (below + F.col("n") / 2)).groupBy("split").agg(F.try_divide(F.sum("wins"), F.sum("p") * F.sum("n")).alias("again"))
    told = row.select(F.explode(F.create_map(*[x for s in ("train", "test", "oot") for x in (F.lit(s), F.col(f"{s}_auc"))])).alias("split", "auc"))
    agrees = wins.join(told, "split", "left").agg(F.min(F.coalesce(F.abs(F.col("auc") - F.col("again")) < 1e-9, F.col("again").isNull())).alias("auc_agrees"))
    part = F.when(F.col("split") == "oot", "oot").otherwise("fit").alias("part")
    rows = scored.groupBy(part).agg(F.count("*").alias("row_count"), F.round(F.avg("label"), 6).alias("label_rate"))
    return rows.withColumn("auc_agrees", agrees.scalar())


# ---------------------------------------------------------------- blends


def _sets(spark, sf, names=PREDS):
    df = views.predictions(spark, sf)
    return {p: df.select("row_id", F.col(p).alias("meter_reading")) for p in names}


@query(
    "assemble_predictions",
    using("predictions", "SELECT row_id, round(pred0, 4) AS pred0, round(CASE WHEN pred1 < 0 THEN 0 ELSE pred1 END, 4) AS pred1, round(pred2, 4) AS pred2 FROM predictions"),
)
def assemble_predictions(spark, sf):
    return rounded(blending.assemble_predictions(_sets(spark, sf)))


def _mean_sql(cols, weights, p, c):
    total = sum(weights)
    if p == 0:
        return f"{c}::DOUBLE * (exp({' + '.join(f'{w / total!r}::DOUBLE * ln(1 + {x})' for x, w in zip(cols, weights, strict=True))}) - 1)"
    inner = " + ".join(f"{w / total!r}::DOUBLE * pow({x}, {p}::DOUBLE)" for x, w in zip(cols, weights, strict=True))
    return f"{c}::DOUBLE * pow({inner}, {1 / p!r}::DOUBLE)"


SAFE = ["pred0", "greatest(pred1, 0)", "pred2"]


@query(
    "generalized_mean",
    using(
        "predictions",
        f"""SELECT row_id, round({_mean_sql(SAFE, (1, 2, 3), 0, 0.99)} + 1.3e-7, 5) AS p0, round({_mean_sql(SAFE, (1, 2, 3), 0.5, 1.01)} + 1.3e-7, 5) AS p_half,
              round({_mean_sql(SAFE, (1, 2, 3), 2, 1.0)} + 1.3e-7, 5) AS p2 FROM predictions""",
    ),
)
def generalized_mean(spark, sf):
    df = blending.assemble_predictions(_sets(spark, sf))
    cols = [F.col(p) for p in PREDS]
    from ledgerline.functions.hours import generalized_mean as mean

    made = {"p0": mean(cols, (1, 2, 3), 0, 0.99), "p_half": mean(cols, (1, 2, 3), 0.5, 1.01), "p2": mean(cols, (1, 2, 3), 2, 1.0)}
    return rounded(df.select("row_id", *[c.alias(n) for n, c in made.items()]), 5)


_SIXTEEN = [f"m{i}" for i in range(16)]
# The twin has the weights and factors of the final blend written out, not the library's.
_WEIGHTS = (0.01782498, 0.03520153, 0.03286305, 0.00718961, 0.01797213, 0.0004982, 0.14172883, 0.12587602, 0.08538773, 0.09482115, 0.09476288, 0.10101228, 0.15306998, 0.03358389, 0.00719679, 0.05101097)
_POWER, _INNER, _OUTER = 0.11375872112626925, 0.99817730007820798, 0.99576627605010293
_FINAL_INNER = " + ".join(f"{w}::DOUBLE * pow(ln(1 + {SAFE[i % 3]} * {1 + i / 10}::DOUBLE), {_POWER!r}::DOUBLE)" for i, w in enumerate(_WEIGHTS))


@query(
    "final_blend",
    using(
        "predictions",
        f"""WITH b AS (SELECT row_id, {_OUTER!r}::DOUBLE * (exp({_INNER!r}::DOUBLE * pow({_FINAL_INNER}, {1 / _POWER!r}::DOUBLE)) - 1) AS v FROM predictions)
            SELECT row_id, round(coalesce(r.meter_reading, CASE WHEN v < 0 THEN 0 ELSE v END) + 1.3e-7, 5) + 0.0 AS meter_reading FROM b
            LEFT JOIN (SELECT x.row_id, f.meter_reading FROM reference f JOIN keyed x USING (building_id, meter, timestamp)) r USING (row_id)""",
    ),
)
def final_blend(spark, sf):
    # Dealt out by row once: the sets of one prediction read the same shuffle, and stacking them takes no other.
    # With a fixed number of parts, as adaptive execution joins parts by the size of a set, not of the sixteen.
    df = views.predictions(spark, sf).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row_id")
    sets = {
        name: df.select("row_id", (F.greatest(F.col(PREDS[i % 3]), F.lit(0.0)) * (1 + i / 10)).alias("meter_reading"))
        for i, name in enumerate(_SIXTEEN)
    }
    blended = blending.assemble_predictions(sets).select("row_id", blending.final_blend(_SIXTEEN).alias("meter_reading"))
    return rounded(blending.finish(blended, views.row_ids(views.reference_readings(spark, sf))), 5)


CANDIDATES = blending.simplex_candidates(3, 3, (0.0, 0.5, 1.0), (0.98, 1.02))
_SCORES = " UNION ALL ".join(
    f"SELECT {i} AS candidate, {{by}}sqrt(avg((meter_reading - {_mean_sql(SAFE, k.weights, k.p, k.c)}) ** 2)) AS rmse, {k.p}::DOUBLE AS p, {k.c}::DOUBLE AS c FROM predictions{{group}}"
    for i, k in enumerate(CANDIDATES)
)


def _blend_rows(spark, sf):
    return views.predictions(spark, sf).withColumn("pred1", F.greatest("pred1", F.lit(0.0)))


@query(
    "search_blend",
    using("predictions", f"SELECT candidate, round(rmse, 6) AS rmse, p, c FROM ({_SCORES.format(by='', group='')}) x ORDER BY x.rmse, candidate LIMIT 1"),
)
def search_blend(spark, sf):
    best = blending.search_blend(_blend_rows(spark, sf), PREDS, "meter_reading", CANDIDATES)
    return rounded(best.drop("weights"), 6, ["rmse"])


extend(
    "best_blends",
    "\nblend_scores AS ("
    + _SCORES.format(by="meter, ", group=" GROUP BY meter")
    + "),\nbest_blends AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meter ORDER BY rmse, candidate) AS k FROM blend_scores) WHERE k = 1)",
    ("predictions",),
)


@query(
    "blend_per_segment",
    using(
        "best_blends",
        "SELECT row_id, round(CASE candidate "
        + " ".join(f"WHEN {i} THEN {_mean_sql(SAFE, k.weights, k.p, k.c)}" for i, k in enumerate(CANDIDATES))
        + " END + 1.3e-7, 5) AS blend FROM predictions JOIN best_blends USING (meter)",
    ),
)
def blend_per_segment(spark, sf):
    df = blending.blend_per_segment(_blend_rows(spark, sf), PREDS, "meter_reading", CANDIDATES, "meter")
    return rounded(df.select("row_id", "blend"), 5)


@query(
    "mean_blend",
    using(
        "predictions",
        "SELECT round(sqrt(avg((ln(1 + meter_reading) - ln(1 + (pred0 + greatest(pred1, 0) + pred2) / 3)) ** 2)), 6) AS rmsle FROM predictions",
    ),
)
def mean_blend(spark, sf):
    df = _blend_rows(spark, sf)
    return rounded(df.agg(metrics.rmsle(F.col("meter_reading"), blending.mean_blend(PREDS)).alias("rmsle")), 6)
