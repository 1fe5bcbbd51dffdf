"""Grouped reports. Everything here is built from aggregates that combine on the map side."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ranking import exact_quantiles

QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)

# Report bands, left-closed unless noted.
PAYMENT_BANDS = ((25, 50, 75, 100), ("1-24%", "25-49%", "50-74%", "75-99%", "100%"))
AGE_BANDS = ((25, 35, 45, 55), ("18-24", "25-34", "35-44", "45-54", "55+"))
INCOME_BANDS = ((30000, 50000, 75000, 100000), ("< $30K", "$30K - $50K", "$50K - $75K", "$75K - $100K", "> $100K"))
RISK_CUT = ((0, 10, 25, 50, 75, 100, 150), ("0-10", "11-25", "26-50", "51-75", "76-100", "100+"))


def share_of(flag: Column) -> Column:
    """Percent of rows on which ``flag`` is true."""
    return F.try_divide(F.count_if(flag), F.count(F.lit(1))) * 100


def distinct_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, values``: distinct non-NULL values of every column (in every group), long form.

    One pass in two levels: the values of all columns are merged, each in its own type, before the shuffle, then counted.
    Without ``by`` a column of NULLs counts 0; a group without values has no row.
    """
    kinds = {c: df.select(F.col(c)).schema[0].dataType for c in columns}
    fields = {kind.simpleString(): f"v{i}" for i, kind in enumerate({k.simpleString(): k for k in kinds.values()}.values())}

    def cell(index: int, column: str) -> Column:
        own = kinds[column].simpleString()
        values = [(F.col(column) if kind == own else F.lit(None).cast(kind)).alias(name) for kind, name in fields.items()]
        return F.when(F.col(column).isNotNull(), F.struct(F.lit(index).alias("at"), *values))

    cells = F.filter(F.array(*[cell(i, c) for i, c in enumerate(columns)]), lambda x: x.isNotNull())
    merged = df.select(*by, F.inline(cells)).distinct()
    named = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("at") + 1).alias("column")
    if by:
        return merged.groupBy(*by, "at").agg(F.count(F.lit(1)).alias("values")).select(*by, named, "values")
    one_row = merged.agg(*[F.count_if(F.col("at") == i).alias(f"n{i}") for i in range(len(columns))])
    return one_row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("values")) for i, c in enumerate(columns)])))


def rate_by(
    df: DataFrame,
    keys: Mapping[str, Column],
    flag: Column,
    *,
    rate: str = "default_rate",
    rows: str = "row_count",
    means: Mapping[str, str] | None = None,
    distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """Row count, share of ``flag``, means and distinct counts per key; keys may be computed columns."""
    aggregates = [F.count(F.lit(1)).alias(rows), share_of(flag).alias(rate)]
    aggregates += [F.avg(column).alias(name) for name, column in (means or {}).items()]
    aggregates += [F.count_distinct(column).alias(name) for name, column in (distinct or {}).items()]
    return df.groupBy(*[column.alias(name) for name, column in keys.items()]).agg(*aggregates)


def portfolio_summary(
    df: DataFrame, distinct: Mapping[str, str], measures: Sequence[str], flag: Column, rate: str = "default_rate"
) -> DataFrame:
    """One row: records, distinct counts, mean and sample deviation of each measure, flag share."""
    aggregates = [F.count(F.lit(1)).alias("total_records")]
    for measure in measures:
        aggregates += [F.avg(measure).alias(f"avg_{measure}"), F.stddev_samp(measure).alias(f"stddev_{measure}")]
    one_row = df.agg(*aggregates, share_of(flag).alias(rate))
    if not distinct:
        return one_row
    wide = [F.max(F.when(F.col("column") == column, F.col("values"))).alias(name) for name, column in distinct.items()]
    counts = distinct_counts(df, list(dict.fromkeys(distinct.values()))).agg(*wide).select(F.struct("*")).scalar()
    found = {name: F.col("_distinct")[name] for name in distinct}
    ordered = ["total_records", *distinct, *[c for c in one_row.columns if c != "total_records"]]
    return one_row.withColumn("_distinct", counts).withColumns(found).select(*ordered)


def five_number(df: DataFrame, column: str) -> DataFrame:
    """Exact min, quartiles and max."""
    names = ("min", "q25", "q50", "q75", "max")
    quantiles = exact_quantiles(df, [column], QUARTILES)
    return quantiles.select("column", "n", *[F.col(f"q{i}").alias(name) for i, name in enumerate(names)])


def _by_column(df: DataFrame, columns: Sequence[str], stats: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """All statistics of all columns in one row, no row being copied per column, then one row per column."""
    kept = [known.cast("double").alias(f"_{i}") for i, known in enumerate(F.col(c) for c in columns)]
    one_row = df.select(*kept).agg(*[make(F.col(f"_{i}")).alias(f"_{i}_{name}") for i in range(len(columns)) for name, make in stats.items()])
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}_{name}").alias(name) for name in stats]) for i, c in enumerate(columns)]
    return one_row.select(F.inline(F.array(*cells)))


MOMENTS = {"min": F.min, "max": F.max, "mean": F.avg, "stddev": F.stddev_samp}


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, max, mean, sample deviation and exact median: one row per column."""
    medians = exact_quantiles(df, columns, [0.5]).select("column", F.col("q0").alias("median"))
    return _by_column(df, columns, MOMENTS).join(medians, "column", "left")


def approximate_profile(df: DataFrame, columns: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """Like :func:`column_profile` with a sketched median, in a single pass."""
    return _by_column(df, columns, MOMENTS | {"median": lambda c: F.percentile_approx(c, 0.5, accuracy)})


def records_per_key(df: DataFrame, key: str) -> DataFrame:
    """Spread of the number of rows per key; the median is exact."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("records"))
    spread = counts.agg(
        F.min("records").alias("min_records"), F.max("records").alias("max_records"), F.avg("records").alias("avg_records")
    )
    median = exact_quantiles(counts, ["records"], [0.5]).select(F.col("q0"))
    return spread.withColumn("median_records", median.scalar())


def date_coverage(df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_distinct(day).alias("days"))


def rows_by_month(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(F.count(F.lit(1)).alias("row_count"))


def frequency(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Value counts, most frequent first; ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    ordered = counts.orderBy(F.desc("row_count"), column)
    return ordered if limit is None else ordered.limit(limit)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson coefficients of all column pairs in one pass, long form, upper triangle without diagonal.

    The number of pairs depends on the column list only.
    """
    pairs = list(combinations(columns, 2))
    one_row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one_row.select(F.inline(F.array(*cells)))


def target_correlation(df: DataFrame, columns: Sequence[str], target: Column, limit: int | None = None) -> DataFrame:
    """Columns ranked by absolute correlation with the target."""
    target = target.cast("double")
    one_row = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), target)).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("strength")) for c in columns]
    ranked = one_row.select(F.inline(F.array(*cells))).orderBy(F.desc_nulls_last("strength"), "column")
    return ranked if limit is None else ranked.limit(limit)


def behaviour_pivot(df: DataFrame, row: str, column: str, values: Sequence[str], flag: Column) -> DataFrame:
    """Flag share by row and column value; the values are named, so no extra pass collects them."""
    return df.groupBy(row).agg(
        *[
            (F.try_divide(F.count_if((F.col(column) == v) & flag), F.count_if(F.col(column) == v)) * 100).alias(v.lower())
            for v in values
        ]
    )


def completed_only(df: DataFrame, cutoff: str) -> DataFrame:
    return df.where(F.col("loan_start_date") < F.lit(cutoff).cast("date"))


def bad_rate_by_mob(df: DataFrame, dpd: int = 30) -> DataFrame:
    """Share of rows at or above ``dpd`` days past due, by month on book."""
    bad = F.coalesce((F.col("dpd") >= dpd).cast("int"), F.lit(0))
    return df.groupBy("mob").agg(F.avg(bad).alias("bad_rate"), F.count(F.lit(1)).alias("row_count")).orderBy("mob")


def segment_cardinality(df: DataFrame, segment: str, columns: Sequence[str]) -> DataFrame:
    """Number of categories of every column in each segment, long form."""
    return distinct_counts(df, columns, [segment]).withColumnRenamed("values", "categories")


def condition_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Count and percent of each named condition, one pass, long form."""
    total = F.count(F.lit(1))
    one_row = df.agg(total.alias("_n"), *[F.count_if(c).alias(n) for n, c in conditions.items()])
    cells = [
        F.struct(
            F.lit(n).alias("condition"), F.col(n).alias("row_count"), (F.try_divide(F.col(n), F.col("_n")) * 100).alias("percent")
        )
        for n in conditions
    ]
    return one_row.select(F.inline(F.array(*cells)))
