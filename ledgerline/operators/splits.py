"""Dataset windows, folds and stratified splits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ranking import range_positions
from ledgerline.operators.scans import scan, slice_of


@dataclass(frozen=True)
class WindowPlan:
    """All bounds are inclusive."""

    train_start: date
    train_end: date
    oot_start: date
    oot_end: date


def _minus_months(day: date, months: int) -> date:
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    next_first = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last_day = (next_first - timedelta(days=1)).day
    return date(year, month + 1, min(day.day, last_day))


def window_plan(train_date: date, train_months: int = 12, oot_months: int = 2) -> WindowPlan:
    """Out-of-time window right before the training day, train/test window right before that."""
    one_day = timedelta(days=1)
    oot_start = _minus_months(train_date, oot_months)
    return WindowPlan(_minus_months(oot_start, train_months), oot_start - one_day, oot_start, train_date - one_day)


def window_plan_columns(train_date: Column, train_months: int = 12, oot_months: int = 2) -> dict[str, Column]:
    """The same plan as columns, one per row of training days."""
    oot_start = F.add_months(train_date, -oot_months)
    return {
        "train_start": F.add_months(oot_start, -train_months),
        "train_end": F.date_sub(oot_start, 1),
        "oot_start": oot_start,
        "oot_end": F.date_sub(train_date, 1),
    }


def split_tag(day: Column, plan: WindowPlan) -> Column:
    return F.when(day.between(F.lit(plan.oot_start), F.lit(plan.oot_end)), "oot").when(
        day.between(F.lit(plan.train_start), F.lit(plan.train_end)), "train_test"
    )


def stratified_split(df: DataFrame, label: str, key: list[str], share: float = 0.8, seed: int = 88) -> DataFrame:
    """Tag exactly ``ceil(share * n)`` rows of every label as train, the rest as test.

    Rows are ordered by a seeded hash of the key; the leading hash bits cut each label into 4,096
    even slices, so a label with half of the table is still ranked in many tasks.
    """
    mixed = F.xxhash64(*[F.col(c) for c in key], F.lit(seed))
    hashed = df.withColumn("_hash", mixed)
    hashed = hashed.withColumn("_slice", slice_of([label], F.shiftright("_hash", 52)))
    sized = scan(hashed, [label], ["_hash", *key], "_slice", number="_rank", totals={"_size": F.lit(1)})
    train = F.col("_rank") <= F.ceil(F.col("_size") * F.lit(share))
    return sized.withColumn("split", F.when(train, "train").otherwise("test")).drop("_hash", "_slice", "_rank", "_size")


def month_fold_table(width: int) -> list[tuple[int, list[int]]]:
    """(fold, months) of all cyclic month blocks: ``width`` shifts of ``ceil(12 / width)`` blocks."""
    starts = [shift + width * block for shift in range(width) for block in range(ceil(12 / width))]
    return [(fold, [(start + i) % 12 + 1 for i in range(width)]) for fold, start in enumerate(starts)]


def month_folds(width: int, month: Column) -> Column:
    """Ids of the folds that validate on this month."""
    folds_of = {m: [f for f, months in month_fold_table(width) if m in months] for m in range(1, 13)}
    listed = F.array(*[F.array(*[F.lit(f) for f in folds_of[m]]) for m in range(1, 13)])
    return F.get(listed, month - 1)


def group_fold(month: Column, folds: int) -> Column:
    """Calendar-month fold: 3, 6 or 12 equal blocks of the year."""
    if folds not in (3, 6, 12):
        raise ValueError("folds must be 3, 6 or 12")
    return F.floor((month - 1) / (12 // folds)).cast("int")


def contiguous_folds(df: DataFrame, order: list[str], folds: int) -> DataFrame:
    """Blocks of consecutive rows, the first ``n mod folds`` of them one row longer; ``order`` is unique per row.

    Only the order columns are ranked. The first key of each block, ``folds`` values in all, comes back
    as a subquery, and every row is placed by comparing its key with them: the table itself is neither
    sorted nor joined.
    """
    keys = range_positions(df.select(*order), order, out="_position")
    total = keys.agg(F.count(F.lit(1))).scalar()
    counted = keys.withColumn("_total", total)
    base, longer = F.floor(F.col("_total") / folds), F.col("_total") % folds
    starts = F.array(*[F.lit(i) * base + F.least(F.lit(i), longer) for i in range(1, folds)])
    firsts = counted.where(F.array_contains(starts, F.col("_position")))
    bounds = firsts.agg(F.collect_list(F.struct(*order)).alias("bounds")).scalar()
    placed = df.withColumn("_bounds", bounds)
    row = F.struct(*order)
    return placed.withColumn("fold", F.size(F.filter("_bounds", lambda first: first <= row))).drop("_bounds")
