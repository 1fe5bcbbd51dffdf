"""Loan jobs: silver tables, the gold feature table, the label store and the training set."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import behaviour, customers, lending
from ledgerline.operators.scans import HOT_ROWS
from ledgerline.operators.splits import split_tag, window_plan
from ledgerline.sources import views


def silver_loans(spark: SparkSession, sf_dir: str, mode: str = "reset", hot_rows: int = HOT_ROWS) -> DataFrame:
    return views.ledger(
        spark, sf_dir, lambda rows, slice_by: lending.silver_ledger(rows, slice_by, mode), hot_rows
    )


def silver_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.silver_attributes(views.attributes(spark, sf_dir))


def silver_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.silver_financials(views.financials(spark, sf_dir))


def click_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.clickstream_detail(views.clicks(spark, sf_dir), views.FEATURES, ["click_id"])


def click_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour.feature_aggregates(click_detail(spark, sf_dir), views.FEATURES)


def behaviour_for_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the features the gold table reads, so the other fifteen are never computed."""
    used = views.FEATURES[: customers.BEHAVIOUR_FEATURES]
    rows = views.clicks(spark, sf_dir).select("customer_id", *used)
    scored = behaviour.zscore(rows, used)
    aggregates = []
    for name in used:
        aggregates += [
            F.avg(name).alias(f"{name}_mean"),
            F.stddev_samp(name).alias(f"{name}_stddev"),
            F.count_if(F.col(f"{name}_is_outlier")).alias(f"{name}_outlier_count"),
        ]
    return scored.groupBy("customer_id").agg(*aggregates, F.count(F.lit(1)).alias("record_count"))


def gold_features(
    loans: DataFrame, attributes: DataFrame, financials: DataFrame, clicks: DataFrame, limits=customers.fx.SCORE_RANGE
) -> DataFrame:
    """One row per attribute row: presence flag, profile, behaviour, loan summary, label and score."""
    base = customers.base_with_presence(attributes.select("customer_id"), clicks, "customer_id", "has_clickstream_data")
    profile = customers.customer_profile(base, attributes, financials)
    with_clicks = customers.attach_behaviour(profile, clicks)
    with_loans = customers.attach_loans(with_clicks, customers.loan_summary(loans))
    return customers.add_risk_score(with_loans, limits)


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_features(
        silver_loans(spark, sf_dir),
        silver_attributes(spark, sf_dir),
        silver_financials(spark, sf_dir),
        behaviour_for_gold(spark, sf_dir),
    )


# Enforced types of the snapshot ledger.
LEDGER_TYPES = {
    "loan_id": "string",
    "customer_id": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}


def label_store(ledger: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Labels of every snapshot in one job."""
    return lending.dpd_label(lending.days_past_due(customers.enforce_types(ledger, LEDGER_TYPES)), dpd, mob)


def training_set(labels: DataFrame, features: DataFrame, train_date: date, train_months: int = 12, oot_months: int = 2) -> DataFrame:
    """Labels in the plan's window with same-day features and an ``oot`` / ``train_test`` tag."""
    plan = window_plan(train_date, train_months, oot_months)
    span = F.col("snapshot_date").between(F.lit(plan.train_start), F.lit(plan.oot_end))
    joined = customers.label_feature_join(labels.where(span), features.where(span))
    return joined.withColumn("split", split_tag(F.col("snapshot_date"), plan))
