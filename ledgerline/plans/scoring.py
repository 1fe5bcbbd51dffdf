"""Train, test and out-of-time scoring as one job: windows, join, split, scaling fitted on train, classifier, metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import encoders, models, splits
from ledgerline.operators.ranking import rank_sum_auc
from ledgerline.plans.credit import training_set
from ledgerline.session import pin

SETS = ("train", "test", "oot")


def score_sets(labels: DataFrame, features: DataFrame, columns: Sequence[str], train_date: date, **search) -> DataFrame:
    """loan_id, label, split (train, test or oot) and score of every row of the training windows.

    The windows follow from ``train_date``. The scaler and the classifier see the train rows only.
    """
    windows = training_set(labels, features, train_date)
    dated = pin(windows.select("loan_id", "label", "split", *columns), "windows")
    fit = splits.stratified_split(dated.where("split <> 'oot'").drop("split"), "label", ["loan_id"])
    tagged = pin(fit.unionByName(dated.where("split = 'oot'")), "tagged")
    scaled = encoders.standard_scale(tagged.where("split = 'train'"), {"all": tagged}, columns)
    every = pin(scaled["all"], "scaled")
    return models.classify(every.where("split = 'train'"), every, columns, **search).select("loan_id", "label", "split", "score")


def metrics_row(scored: DataFrame) -> DataFrame:
    """One row: rows, label rate, AUC and gini of each set; NULL where a set has no rows or one label only."""
    aucs = rank_sum_auc(scored, "score", "label", ["split"])
    sizes = scored.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate"))
    both = sizes.join(aucs, "split", "left")
    one = []
    for name in SETS:
        own = lambda c, name=name: F.max(F.when(F.col("split") == name, F.col(c)))
        one += [own("n").alias(f"{name}_rows"), own("rate").alias(f"{name}_label_rate"), own("auc").alias(f"{name}_auc"), (own("auc") * 2 - 1).alias(f"{name}_gini")]
    return both.agg(*one)
