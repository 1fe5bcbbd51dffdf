"""Wide behaviour rows: table-wide z-scores, per-customer sequence and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.scans import HOT_ROWS, match_null_safe, scan, split_hot

OUTLIER_LIMIT = 3


def global_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of every column, in one pass and one row."""
    aggregates = []
    for name in columns:
        aggregates += [F.avg(name).alias(f"{name}_mean"), F.stddev_samp(name).alias(f"{name}_stddev")]
    return df.agg(*aggregates)


def zscore(df: DataFrame, columns: Sequence[str], limit: float = OUTLIER_LIMIT) -> DataFrame:
    """``<c>_normalized`` and ``<c>_is_outlier``; a constant column gives NULL.

    The one-row statistics enter as a scalar subquery, so the rows themselves are not shuffled.
    """
    stats = global_stats(df, columns)
    with_stats = df.withColumn("_stats", stats.select(F.struct(*stats.columns)).scalar())
    scores = {
        f"{name}_normalized": F.try_divide(
            F.col(name) - F.col("_stats")[f"{name}_mean"], F.col("_stats")[f"{name}_stddev"]
        )
        for name in columns
    }
    scored = with_stats.withColumns(scores).drop("_stats")
    return scored.withColumns({f"{n}_is_outlier": F.abs(f"{n}_normalized") > limit for n in columns})


def join_first_seen(df: DataFrame, key: str, day: str, out: str = "first_snapshot_date") -> DataFrame:
    """First date of each key, aggregated and joined back (no sort, safe for a hot key)."""
    return match_null_safe(df, df.groupBy(key).agg(F.min(day).alias(out)), [key], "left")


def months_between_first(day: str, first: str):
    return (
        (F.year(day) - F.year(first)) * 12 + F.month(day) - F.month(first)
    )


def sequence_in_key(df: DataFrame, key: str, day: str, tie: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Row number of each key by date (``tie`` makes the order total), its first date and the months since.

    The first date comes out of the same scan, so there is no join.
    """
    first = {"first_snapshot_date": F.col(day)}
    dated = split_hot(
        df,
        [key],
        [day, *tie],
        lambda rows, slice_by: scan(rows, [key], [day, *tie], slice_by, number="row_num_by_customer", mins=first),
        hot_rows,
    )
    return dated.withColumns(
        {
            "month": F.month(day),
            "quarter": F.quarter(day),
            "year": F.year(day),
            "months_since_first": months_between_first(day, "first_snapshot_date"),
        }
    )


def clickstream_detail(df: DataFrame, columns: Sequence[str], tie: Sequence[str]) -> DataFrame:
    return sequence_in_key(zscore(df, columns), "customer_id", "snapshot_date", tie)


def feature_aggregates(detail: DataFrame, columns: Sequence[str], key: str = "customer_id") -> DataFrame:
    """Mean, max, min, sample deviation and outlier count of every feature, plus record and date ranges."""
    aggregates = []
    for name in columns:
        aggregates += [
            F.avg(name).alias(f"{name}_mean"),
            F.max(name).alias(f"{name}_max"),
            F.min(name).alias(f"{name}_min"),
            F.stddev_samp(name).alias(f"{name}_stddev"),
            F.count_if(F.col(f"{name}_is_outlier")).alias(f"{name}_outlier_count"),
        ]
    return detail.groupBy(key).agg(
        *aggregates,
        F.max("snapshot_date").alias("latest_snapshot_date"),
        F.count(F.lit(1)).alias("record_count"),
        F.max("months_since_first").alias("max_months"),
        F.min("first_snapshot_date").alias("first_snapshot_date"),
    )
