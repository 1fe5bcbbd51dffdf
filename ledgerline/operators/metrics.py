"""Scores of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ranking import rank_sum_auc


def rmse(actual: Column, predicted: Column) -> Column:
    """Aggregate: root of the mean squared difference."""
    gap = actual - predicted
    return F.sqrt(F.avg(gap * gap))


def rmsle(actual: Column, predicted: Column) -> Column:
    return rmse(F.log1p(actual), F.log1p(predicted))


def score_columns(df: DataFrame, actual: str, predictions: Sequence[str]) -> DataFrame:
    """RMSE and RMSLE of every prediction column in one pass, long form."""
    aggregates = []
    for p in predictions:
        # A negative prediction has no log; it is scored as 0.
        safe = F.greatest(F.col(p), F.lit(0.0))
        aggregates += [
            F.struct(rmse(F.col(actual), F.col(p)).alias("rmse"), rmsle(F.col(actual), safe).alias("rmsle")).alias(p)
        ]
    cells = [F.struct(F.lit(p).alias("prediction"), F.col(p)["rmse"].alias("rmse"), F.col(p)["rmsle"].alias("rmsle")) for p in predictions]
    return df.agg(*aggregates).select(F.inline(F.array(*cells)))


def fold_average(df: DataFrame, key: str, prediction: str, space: str = "value") -> DataFrame:
    """Mean over fold models, of ``expm1`` values (``value``) or in log space before ``expm1`` (``log``)."""
    if space == "value":
        mean = F.avg(F.expm1(prediction))
    elif space == "log":
        mean = F.expm1(F.avg(prediction))
    else:
        raise ValueError(f"unknown space {space!r}")
    return df.groupBy(key).agg(mean.alias("meter_reading"))


def segment_errors(df: DataFrame, segment: str, actual: Column, predicted: Column) -> DataFrame:
    gap = actual - predicted
    return df.groupBy(segment).agg(F.avg(gap * gap).alias("mse"), F.count(F.lit(1)).alias("row_count"))


def oof_score(df: DataFrame, segment: str, actual: Column, predicted: Column) -> DataFrame:
    """Root of the row-weighted mean of the segment errors."""
    parts = segment_errors(df, segment, actual, predicted)
    return parts.agg(F.sqrt(F.try_divide(F.sum(F.col("mse") * F.col("row_count")), F.sum("row_count"))).alias("oof_rmse"))


def auc_gini(df: DataFrame, score: str, label: str, split: str) -> DataFrame:
    """ROC AUC and gini of every split."""
    auc = rank_sum_auc(df, score, label, [split])
    return auc.withColumn("gini", F.col("auc") * 2 - 1)


def split_stats(df: DataFrame, split: str, label: str) -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("row_count"), F.round(F.avg(label), 2).alias("label_rate"))
