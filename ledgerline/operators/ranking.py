"""Positions, quantiles and rank sums along a table-wide order, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.scans import match_null_safe, scan, slice_of
from ledgerline.session import pin


def range_sliced(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows of distinct (keys, value) with the range partition they fall into as their slice.

    The bounds come from a sample of the rows themselves, so slices are even wherever the values lie, a narrow band
    beside a far outlier included. The cut is pinned, since every reader has to see the same one.
    """
    ranged = counts.repartitionByRange(*[F.col(c) for c in (*keys, value)]).withColumn("_part", F.spark_partition_id())
    return pin(ranged, "ranges").withColumn("_slice", slice_of(keys, F.col("_part"))).drop("_part")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per column (and group), one column per probability.

    Works on value counts: equal values are merged before the shuffle, the running count is taken
    range by range, and the two neighbours of every position are picked by one aggregate. Returns
    ``by..., column, n, q0, q1, ...`` in the order of ``probs``; NULLs are ignored.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    keys = [*by, "column"]
    counts = (
        df.select(*by, F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    sliced = range_sliced(counts, keys, "value")
    placed = scan(sliced, keys, ["value"], "_slice", sums={"upto": F.col("rows")}, totals={"n": F.col("rows")})

    def value_at(position: Column) -> Column:
        inside = (F.col("upto") - F.col("rows") <= position) & (position < F.col("upto"))
        return F.max(F.when(inside, F.col("value")))

    picks = []
    for index, prob in enumerate(probs):
        exact = (F.col("n") - 1) * F.lit(float(prob))
        picks += [value_at(F.floor(exact)).alias(f"_a{index}"), value_at(F.ceil(exact)).alias(f"_b{index}")]
    picked = placed.groupBy(*keys, "n").agg(*picks)
    shares = []
    for index, prob in enumerate(probs):
        exact = (F.col("n") - 1) * F.lit(float(prob))
        share = exact - F.floor(exact)
        low, high = F.col(f"_a{index}"), F.col(f"_b{index}")
        shares.append((low + (high - low) * share).alias(f"q{index}"))
    return picked.select(*keys, "n", *shares)


def rank_sum_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., positives, negatives, auc``: the chance that a positive outranks a negative, ties half."""
    usable = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).withColumn("score", F.col(score).cast("double"))
    counts = usable.groupBy(*by, "score").agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return auc_of_counts(counts, by)


def auc_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from rows of distinct scores with their positives (``pos``) and negatives (``neg``)."""
    # One constant key when there is no grouping column, so the slices still split the scan.
    keys = list(by) or ["_all"]
    if not by:
        counts = counts.withColumn("_all", F.lit(0))
    ranked = scan(range_sliced(counts, keys, "score"), keys, ["score"], "_slice", sums={"below": F.col("neg")})
    wins = F.sum(F.col("pos") * (F.col("below") - F.col("neg") / 2))
    positives, negatives = F.sum("pos"), F.sum("neg")
    return (
        ranked.groupBy(*keys)
        .agg(
            positives.alias("positives"),
            negatives.alias("negatives"),
            F.try_divide(wins, positives * negatives).alias("auc"),
        )
        .drop("_all")
    )


def range_positions(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), out: str = "position") -> DataFrame:
    """Number the rows 0, 1, ... in ``order``, restarting for each ``within`` combination.

    The rows are range-partitioned, so the partition number is the slice. They are pinned first:
    the range bounds come from a sample, and every reader has to see the same cut.
    """
    ranged = pin(
        df.repartitionByRange(*[F.col(c) for c in (*within, *order)]).withColumn("_slice", F.spark_partition_id())
    )
    keys = [*within, "_slice"]
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    # At most one row per range partition and ``within`` group: small enough to be ordered in one task.
    sizes = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = match_null_safe(ranged.withColumn("_local", local), starts, keys, "left")
    return numbered.withColumn(out, (F.col("_local") + F.col("_start")).cast("bigint")).drop("_local", "_start", "_slice")
