"""Data-quality profiles, reconciliations and key comparisons, each in one pass over its tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.aggregates import distinct_counts, share_of


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percent of every column, long form."""
    one_row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).alias("nulls"),
            F.coalesce(F.try_divide(F.col(c), F.col("_n")) * 100, F.lit(0.0)).alias("null_percent"),
        )
        for c in df.columns
    ]
    return one_row.select(F.inline(F.array(*cells)))


def distinct_profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values of every column. Exact by default; ``approximate`` needs one pass and no shuffle of values."""
    columns = list(columns or df.columns)
    if approximate:
        one_row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return one_row.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("values")) for c in columns]))
        )
    return distinct_counts(df, columns)


def key_overlap(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Per table: distinct keys, keys common to all tables, keys of its own that some other table lacks.

    Every table's distinct keys are tagged with a bit and the bits are merged by key in one shuffle.
    """
    names = list(tables)
    tagged = [tables[n].select(key).distinct().withColumn("_bit", F.lit(1 << i)) for i, n in enumerate(names)]
    merged = reduce(DataFrame.unionByName, tagged).groupBy(key).agg(F.bit_or("_bit").alias("_bits"))
    everywhere = (1 << len(names)) - 1
    one_row = merged.where(F.col(key).isNotNull()).agg(
        F.count_if(F.col("_bits") == everywhere).alias("_all"),
        *[F.count_if(F.col("_bits").bitwiseAND(1 << i) != 0).alias(f"k{i}") for i in range(len(names))],
    )
    cells = [
        F.struct(
            F.lit(n).alias("table"),
            F.col(f"k{i}").alias("unique_keys"),
            F.col("_all").alias("in_all"),
            (F.col(f"k{i}") - F.col("_all")).alias("missing_elsewhere"),
        )
        for i, n in enumerate(names)
    ]
    return one_row.select(F.inline(F.array(*cells)))


def key_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Distinct keys before and after a step, and how many were lost or added."""
    marked = before.select(key).distinct().withColumn("_bit", F.lit(1)).unionByName(
        after.select(key).distinct().withColumn("_bit", F.lit(2))
    )
    bits = F.col("_bits")
    return (
        marked.groupBy(key)
        .agg(F.bit_or("_bit").alias("_bits"))
        .agg(
            F.count_if(bits.bitwiseAND(1) != 0).alias("keys_before"),
            F.count_if(bits.bitwiseAND(2) != 0).alias("keys_after"),
            F.count_if(bits == 1).alias("lost"),
            F.count_if(bits == 2).alias("added"),
        )
    )


def keep_listed(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed: a semi join instead of a collected list."""
    return df.join(wanted.select(key).distinct(), key, "left_semi")


def expected_balance() -> Column:
    return F.col("loan_amt") - (F.col("installment_num") * F.col("due_amt") - F.col("overdue_amt"))


def expected_overdue() -> Column:
    owed = F.col("installment_num") * F.col("due_amt") - F.col("paid_amt")
    return F.when(F.col("installment_num") > 0, owed).otherwise(F.lit(0.0))


def match_counts(df: DataFrame, expected: Column, actual: Column, by: Sequence[str] = (), tolerance: float = 0.005) -> DataFrame:
    """Rows on which the two sides agree within ``tolerance``, by group."""
    return df.groupBy(*by, (F.abs(expected - actual) <= tolerance).alias("matches")).agg(F.count(F.lit(1)).alias("row_count"))


def mismatches(df: DataFrame, expected: Column, actual: Column, order: Sequence[str], limit: int, tolerance: float = 0.005) -> DataFrame:
    """First ``limit`` disagreeing rows, in ``order``."""
    return df.withColumn("expected", expected).where(F.abs(F.col("expected") - actual) > tolerance).orderBy(*order).limit(limit)


def overdue_ratio(df: DataFrame) -> DataFrame:
    """Spread of actual over expected overdue amounts."""
    expected = expected_overdue()
    ratio = F.when(expected > 0, F.try_divide(F.col("overdue_amt"), expected)).otherwise(0.0)
    return df.select(ratio.alias("ratio")).agg(
        F.count("ratio").alias("row_count"),
        F.avg("ratio").alias("mean_ratio"),
        F.stddev_samp("ratio").alias("stddev_ratio"),
        F.min("ratio").alias("min_ratio"),
        F.max("ratio").alias("max_ratio"),
    )


def rule_check(df: DataFrame, rules: Mapping[str, tuple[Column, Column]], tolerance: float = 0.001) -> DataFrame:
    """Recompute derived columns: rows checked, rows that agree and the agreement percent of every rule.

    A rule is (actual, expected); numbers agree within ``tolerance``, other types when equal or both NULL.
    """
    types = {name: df.select(pair[0].alias("x")).schema[0].dataType.typeName() for name, pair in rules.items()}
    numeric = {"double", "float", "integer", "long", "short", "byte"}

    def agrees(name: str) -> Column:
        actual, expected = rules[name]
        if types[name] in numeric:
            return (F.abs(actual - expected) < tolerance) | (actual.isNull() & expected.isNull())
        return actual.eqNullSafe(expected)

    one_row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(agrees(n)).alias(n) for n in rules])
    cells = [
        F.struct(
            F.lit(n).alias("rule"),
            F.col("_n").alias("checked"),
            F.col(n).alias("agreeing"),
            (F.try_divide(F.col(n), F.col("_n")) * 100).alias("percent"),
        )
        for n in rules
    ]
    return one_row.select(F.inline(F.array(*cells)))


def pattern_violations(df: DataFrame, columns: Sequence[str], pattern: str = r"[^0-9.\-]") -> DataFrame:
    """Per column: values that contain a character outside the number alphabet, count, percent, smallest example."""
    bad = {c: F.col(c).cast("string").rlike(pattern) for c in columns}
    one_row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(bad[c]).alias(f"n_{c}") for c in columns],
        *[F.min(F.when(bad[c], F.col(c).cast("string"))).alias(f"e_{c}") for c in columns],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n_{c}").alias("violations"),
            (F.try_divide(F.col(f"n_{c}"), F.col("_n")) * 100).alias("percent"),
            F.col(f"e_{c}").alias("example"),
        )
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*cells)))


def violation_samples(df: DataFrame, column: str, limit: int, pattern: str = r"[^0-9.\-]") -> DataFrame:
    """The first ``limit`` distinct offending values."""
    text = F.col(column).cast("string")
    return df.where(text.rlike(pattern)).select(text.alias("value")).distinct().orderBy("value").limit(limit)


def _metrics(table: str, one_row: DataFrame) -> DataFrame:
    cells = [
        F.struct(F.lit(table).alias("table"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*cells)))


def layer_report(attributes: DataFrame, financials: DataFrame, loans: DataFrame, clicks: DataFrame) -> DataFrame:
    """Quality metrics of the silver tables as (table, metric, value)."""
    rows = F.count(F.lit(1))
    mix = financials.groupBy("credit_mix").agg(rows.alias("_k"))
    total = financials.agg(rows).scalar()
    mix_share = mix.select(
        F.lit("financials").alias("table"),
        F.concat(F.lit("credit_mix_percent:"), F.col("credit_mix")).alias("metric"),
        (F.try_divide(F.col("_k"), total) * 100).alias("value"),
    )
    balanced = F.abs(expected_balance() - F.col("balance")) <= 0.005
    parts = [
        _metrics(
            "attributes",
            attributes.agg(
                rows.alias("total_rows"),
                share_of(F.col("age").isNull()).alias("null_age_percent"),
                share_of(F.col("is_valid_ssn")).alias("valid_ssn_percent"),
            ),
        ),
        _metrics(
            "financials",
            financials.agg(rows.alias("total_rows"), share_of(F.col("annual_income").isNull()).alias("null_income_percent")),
        ),
        mix_share,
        _metrics("loans", loans.agg(rows.alias("total_rows"), share_of(balanced).alias("amount_check_valid_percent"))),
        _metrics(
            "clicks",
            clicks.agg(rows.alias("total_rows"), F.try_divide(rows, F.count_distinct("customer_id")).alias("rows_per_customer")),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def table_summary(source: str, df: DataFrame, expected_columns: Sequence[str]) -> DataFrame:
    """One row: row count, missing columns, NULL counts above zero (column -> count), time; one pass over the table."""
    missing = [F.lit(c) for c in expected_columns if c not in df.columns]
    one_row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)])
    nulls = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(c), F.col(f"_null_{i}"))])
    return one_row.select(
        F.lit(source).alias("source"),
        F.col("_n").alias("row_count"),
        F.array(*missing).cast("array<string>").alias("missing_columns"),
        F.map_filter(nulls, lambda _, n: n > 0).alias("null_counts"),
        F.current_timestamp().alias("validation_timestamp"),
    )


def run_summary(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], seconds: float = 0.0) -> DataFrame:
    """One row for a run over several tables (name -> table and the columns it should have): totals, and a list of table summaries."""
    parts = reduce(DataFrame.unionByName, [table_summary(name, df, expected) for name, (df, expected) in tables.items()])
    fields = ("source", "row_count", "missing_columns", "null_counts", "validation_timestamp")
    by_name = lambda a, b: F.when(a["source"] < b["source"], -1).otherwise(1)
    totals = F.struct(
        F.current_timestamp().alias("timestamp"), F.lit(float(seconds)).alias("runtime_seconds"), F.count(F.lit(1)).alias("tables_processed"), F.sum("row_count").alias("total_rows_processed")
    )
    return parts.agg(totals.alias("pipeline_run"), F.array_sort(F.collect_list(F.struct(*fields)), by_name).alias("table_summaries"))  # one entry per table


def write_run_summary(summary: DataFrame, path: str) -> None:
    """The run as one JSON document."""
    summary.coalesce(1).write.mode("overwrite").json(path)


SUMMARY = (
    "pipeline_run struct<timestamp: timestamp, runtime_seconds: double, tables_processed: bigint, total_rows_processed: bigint>, "
    "table_summaries array<struct<source: string, row_count: bigint, missing_columns: array<string>, null_counts: map<string, bigint>, validation_timestamp: timestamp>>"
)


def read_run_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY).json(path)


def non_null_compare(before: DataFrame, after: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Non-NULL values of column pairs before and after cleaning, and the share kept."""
    left = before.agg(*[F.count(c).alias(f"b{i}") for i, c in enumerate(columns)])
    right = after.agg(*[F.count(c).alias(f"a{i}") for i, c in enumerate(columns.values())])
    # Two one-row tables meet through a scalar subquery.
    both = left.withColumn("_after", right.select(F.struct(*right.columns)).scalar())
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"b{i}").alias("before"),
            F.col("_after")[f"a{i}"].alias("after"),
            (F.try_divide(F.col("_after")[f"a{i}"], F.col(f"b{i}")) * 100).alias("percent"),
        )
        for i, c in enumerate(columns)
    ]
    return both.select(F.inline(F.array(*cells)))


# ---------------------------------------------------------------- example loans

LIFECYCLE = [
    "installment_num", "due_amt", "paid_amt", "overdue_amt", "payment_status", "consecutive_missed_payments",
    "is_default", "percent_paid",
]


def status_path(df: DataFrame, loan_id) -> DataFrame:
    """Life cycle of one loan."""
    return df.where(F.col("loan_id") == loan_id).select("loan_id", *LIFECYCLE).orderBy("installment_num")


def example_conditions(last: int = 10) -> dict[str, Column]:
    c = F.col
    at_end = c("installment_num") == last
    return {
        "on_time": at_end & ~c("is_default") & (c("payment_status") == "PAID_ON_TIME"),
        "early_default": (c("installment_num") <= 5) & c("is_default"),
        "mixed": at_end & c("percent_paid").between(40, 60),
        "recovered": at_end & (c("consecutive_missed_payments") == 0) & (c("percent_paid") < 100) & (c("percent_paid") > 0),
    }


def example_loans(df: DataFrame, last: int = 10) -> DataFrame:
    """Smallest loan id of every example kind, in one pass."""
    kinds = example_conditions(last)
    one_row = df.agg(*[F.min(F.when(cond, F.col("loan_id"))).alias(name) for name, cond in kinds.items()])
    cells = [F.struct(F.lit(name).alias("kind"), F.col(name).alias("loan_id")) for name in kinds]
    return one_row.select(F.inline(F.array(*cells)))


def worst_loans(df: DataFrame, k: int = 3, last: int = 10) -> DataFrame:
    at_end = df.where(F.col("installment_num") == last)
    return (
        at_end.select("loan_id", "percent_paid", "consecutive_missed_payments").orderBy("percent_paid", "loan_id").limit(k)
    )
