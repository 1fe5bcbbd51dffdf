"""Customer tables: cleaning, joins and the loan summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import cleaning as cl
from ledgerline.functions import lending as fx
from ledgerline.operators.scans import match_null_safe

# Reporting day of the attribute table.
ATTRIBUTES_ASOF = "2025-05-01"

PROFILE_ATTRIBUTES = ["age", "occupation", "is_valid_age"]
PROFILE_FINANCIALS = [
    "annual_income",
    "monthly_inhand_salary",
    "num_bank_accounts",
    "num_credit_card",
    "interest_rate",
    "credit_utilization_ratio",
    "credit_history_total_months",
    "outstanding_debt",
    "num_delayed_payments",
    "credit_mix",
    "payment_behavior_spent_level",
    "payment_behavior_value_level",
]
BEHAVIOUR_FEATURES = 5


def enforce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns in one projection; unreadable values become NULL."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def silver_attributes(df: DataFrame, asof: str = ATTRIBUTES_ASOF) -> DataFrame:
    return df.select(
        "customer_id",
        "name",
        "snapshot_date",
        cl.clean_age(F.col("age")).alias("age"),
        cl.is_valid_age(F.col("age")).alias("is_valid_age"),
        "ssn",
        cl.matches_format(F.col("ssn")).alias("is_valid_ssn"),
        cl.normalize_category(F.col("occupation")).alias("occupation"),
        cl.data_age_months(F.lit(asof).cast("date"), F.col("snapshot_date")).alias("data_age_months"),
    )


def silver_financials(df: DataFrame, null_as_empty: bool = True) -> DataFrame:
    c = F.col
    kinds = cl.split_list(c("type_of_loan"), null_as_empty)
    made: dict[str, Column] = {
        "customer_id": c("customer_id"),
        "snapshot_date": c("snapshot_date"),
        "annual_income": cl.clean_number(c("annual_income")),
        "monthly_inhand_salary": c("monthly_inhand_salary"),
        "num_bank_accounts": c("num_bank_accounts"),
        "num_credit_card": c("num_credit_card"),
        "interest_rate": c("interest_rate"),
        "num_of_loans": cl.clean_count(c("num_of_loan")),
        "loan_types_count": F.size(kinds),
        **cl.membership_flags(kinds),
        "delay_from_due_date": c("delay_from_due_date"),
        "num_delayed_payments": cl.clean_count(c("num_of_delayed_payment")),
        "changed_credit_limit": cl.clean_signed_number(c("changed_credit_limit")),
        "num_credit_inquiries": c("num_credit_inquiries"),
        "credit_mix": cl.map_values(c("credit_mix"), cl.CREDIT_MIX_NAMES, F.upper(c("credit_mix"))),
        "outstanding_debt": cl.clean_number(c("outstanding_debt")),
        "credit_utilization_ratio": c("credit_utilization_ratio"),
        "credit_history_years": cl.history_years(c("credit_history_age")),
        "credit_history_months": cl.history_months(c("credit_history_age")),
        "credit_history_total_months": cl.history_total_months(c("credit_history_age")),
        "is_min_payment_made": cl.map_values(c("payment_of_min_amount"), cl.MIN_PAYMENT_FLAGS),
        "total_emi_per_month": c("total_emi_per_month"),
        "amount_invested_monthly": cl.clean_number(c("amount_invested_monthly")),
        "payment_behavior_spent_level": cl.extract_level(c("payment_behaviour"), cl.SPENT_LEVELS),
        "payment_behavior_value_level": cl.extract_level(c("payment_behaviour"), cl.VALUE_LEVELS),
        "monthly_balance": cl.clean_signed_number(c("monthly_balance")),
    }
    return df.select(*[column.alias(name) for name, column in made.items()])


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct list items of a comma list."""
    item = F.explode(cl.split_list(F.col(column)))
    return df.select(item.alias("item")).select(F.trim("item").alias("item")).distinct()


def base_with_presence(base: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    """Keep all base rows and flag the keys found in ``other``."""
    hits = other.select(key).distinct().withColumn("_hit", F.lit(True))
    return base.join(hits, key, "left").withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_hit")


def customer_profile(base: DataFrame, attributes: DataFrame, financials: DataFrame, key: str = "customer_id") -> DataFrame:
    """Base rows with selected attributes and finances. Repeated keys on the right multiply rows."""
    return base.join(attributes.select(key, *PROFILE_ATTRIBUTES), key, "left").join(
        financials.select(key, *PROFILE_FINANCIALS), key, "left"
    )


def behaviour_columns(features: int = BEHAVIOUR_FEATURES) -> list[str]:
    return [f"fe_{i}_{kind}" for kind in ("mean", "stddev", "outlier_count") for i in range(1, features + 1)] + [
        "record_count"
    ]


def attach_behaviour(profile: DataFrame, behaviour: DataFrame, key: str = "customer_id") -> DataFrame:
    """Add behaviour aggregates; missing ones, a single record's spread included, become 0."""
    added = behaviour_columns()
    joined = profile.join(behaviour.select(key, *added), key, "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in added else F.col(c) for c in joined.columns],
        (~F.col("has_clickstream_data")).alias("clickstream_features_imputed"),
    )


def loan_summary(silver_loans: DataFrame, key: str = "customer_id") -> DataFrame:
    """Per customer. ``num_defaulted_loans`` counts installment rows in default, as the label does.

    Loans are reduced to one row each before customers are grouped, so no distinct count has to
    multiply the ledger rows.
    """
    loans = silver_loans.groupBy(key, "loan_id").agg(
        F.count_if("is_default").alias("_bad_rows"),
        F.sum("consecutive_missed_payments").alias("_missed"),
        F.count("consecutive_missed_payments").alias("_missed_rows"),
        F.max("consecutive_missed_payments").alias("_max_missed"),
        F.sum("percent_paid").alias("_paid"),
        F.count("percent_paid").alias("_paid_rows"),
        F.max("overdue_amt").alias("_max_overdue"),
        F.min("balance").alias("_min_balance"),
    )
    return loans.groupBy(key).agg(
        F.count("loan_id").alias("total_loans"),
        F.sum("_bad_rows").alias("num_defaulted_loans"),
        F.count_if((F.col("_bad_rows") > 0) & F.col("loan_id").isNotNull()).alias("num_distinct_defaulted_loans"),
        F.try_divide(F.sum("_missed"), F.sum("_missed_rows")).alias("avg_missed_payments"),
        F.max("_max_missed").alias("max_missed_payments"),
        F.try_divide(F.sum("_paid"), F.sum("_paid_rows")).alias("avg_percent_paid"),
        F.max("_max_overdue").alias("max_overdue_amt"),
        F.min("_min_balance").alias("min_balance"),
    )


def attach_loans(profile: DataFrame, summary: DataFrame, key: str = "customer_id") -> DataFrame:
    """``has_defaulted`` stays NULL for customers without loans."""
    return profile.join(summary, key, "left").withColumn("has_defaulted", F.col("num_defaulted_loans") > 0)


def add_risk_score(df: DataFrame, limits: tuple[int, int] = fx.SCORE_RANGE) -> DataFrame:
    c = F.col
    score = fx.risk_score(
        defaults=c("num_defaulted_loans"),
        max_missed=c("max_missed_payments"),
        debt=c("outstanding_debt"),
        income=c("annual_income"),
        credit_mix=c("credit_mix"),
        history_months=c("credit_history_total_months"),
        spent_level=c("payment_behavior_spent_level"),
        value_level=c("payment_behavior_value_level"),
        loans=c("total_loans"),
        max_overdue=c("max_overdue_amt"),
    )
    return df.withColumn("default_risk_score", fx.clamp(score, *limits))


def latest_record(df: DataFrame, key: str, when: str) -> DataFrame:
    """Rows at the latest ``when`` of their key; ties are kept.

    The maximum is pre-aggregated on the map side and joined back, so a hot key is never sorted in
    one task and the join can be split by adaptive execution.
    """
    latest = df.groupBy(key).agg(F.max(when).alias("_latest"))
    joined = match_null_safe(df, latest, [key], "inner")
    return joined.where(F.col(when) == F.col("_latest")).drop("_latest")


def raw_feature_label(
    loans: DataFrame, attributes: DataFrame, financials: DataFrame, behaviour: DataFrame, key: str = "customer_id"
) -> DataFrame:
    """Label columns of the latest ledger rows with all customer features, metadata dropped."""
    label = latest_record(loans, key, "snapshot_date").select(
        key, "is_default", "payment_status", "consecutive_missed_payments", "snapshot_date"
    )
    return (
        label.join(attributes.drop("snapshot_date"), key, "left")
        .join(financials.drop("snapshot_date"), key, "left")
        .join(behaviour, key, "left")
        .withColumn("has_clickstream_data", F.col("fe_1_mean").isNotNull())
    )


def label_table(gold: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return gold.select("customer_id", "has_defaulted", "default_risk_score", "has_clickstream_data", *extra)


def label_feature_join(labels: DataFrame, features: DataFrame) -> DataFrame:
    return labels.join(features, ["customer_id", "snapshot_date"], "left")
