"""Grouped reports, profiles, reconciliations and samples over the loan tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import checks.credit  # noqa: F401  (defines the gold and label views)
from checks.helpers import rounded
from checks.registry import query
from checks.views_sql import using
from ledgerline.functions import lending as fx
from ledgerline.operators import aggregates as ag
from ledgerline.operators import customers, quality, sampling
from ledgerline.operators import lending as ops
from ledgerline.plans import credit, layers
from ledgerline.sources import views

RATE = "round(sum(CASE WHEN {f} THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4) AS default_rate"
LOAN_RATE = RATE.format(f="is_default")
GOLD_RATE = RATE.format(f="has_defaulted")


# ---------------------------------------------------------------- rates


@query(
    "rate_by_month",
    using(
        "silver",
        f"""SELECT strftime(snapshot_date, '%Y-%m') AS year_month, count(*) AS total_records, count(DISTINCT customer_id) AS active_customers,
              round(avg(consecutive_missed_payments), 4) AS avg_missed_payments, round(avg(percent_paid), 4) AS avg_percent_paid,
              round(avg(overdue_amt), 4) AS avg_overdue_amt, {LOAN_RATE}
            FROM silver GROUP BY 1""",
    ),
)
def rate_by_month(spark, sf):
    df = ag.rate_by(
        credit.silver_loans(spark, sf),
        {"year_month": F.date_format("snapshot_date", "yyyy-MM")},
        F.col("is_default"),
        rows="total_records",
        means={
            "avg_missed_payments": "consecutive_missed_payments",
            "avg_percent_paid": "percent_paid",
            "avg_overdue_amt": "overdue_amt",
        },
        distinct={"active_customers": "customer_id"},
    )
    return rounded(df)


@query(
    "default_distribution",
    using(
        "silver",
        "SELECT is_default, count(*) AS record_count, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT loan_id) AS unique_loans FROM silver GROUP BY 1",
    ),
)
def default_distribution(spark, sf):
    return (
        credit.silver_loans(spark, sf)
        .groupBy("is_default")
        .agg(
            F.count("*").alias("record_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("loan_id").alias("unique_loans"),
        )
    )


@query(
    "default_rate_levels",
    using(
        "silver",
        """SELECT round(count(DISTINCT CASE WHEN is_default THEN customer_id END) * 100.0::DOUBLE / count(DISTINCT customer_id), 4) AS customer_rate,
                  round(count(DISTINCT CASE WHEN is_default THEN loan_id END) * 100.0::DOUBLE / count(DISTINCT loan_id), 4) AS loan_rate FROM silver""",
    ),
)
def default_rate_levels(spark, sf):
    """Two-level: flag per loan and customer first, so no distinct over all rows is needed."""
    loans = credit.silver_loans(spark, sf).groupBy("customer_id", "loan_id").agg(F.bool_or("is_default").alias("bad"))
    people = loans.groupBy("customer_id").agg(
        F.bool_or("bad").alias("bad"), F.count("*").alias("loans"), F.count_if("bad").alias("bad_loans")
    )
    return people.agg(
        F.round(F.count_if("bad") * 100.0 / F.count("*"), 4).alias("customer_rate"),
        F.round(F.sum("bad_loans") * 100.0 / F.sum("loans"), 4).alias("loan_rate"),
    )


@query(
    "missed_payment_distribution",
    using(
        "silver",
        "SELECT consecutive_missed_payments, count(*) AS record_count, count(DISTINCT customer_id) AS unique_customers FROM silver GROUP BY 1",
    ),
)
def missed_payment_distribution(spark, sf):
    return (
        credit.silver_loans(spark, sf)
        .groupBy("consecutive_missed_payments")
        .agg(F.count("*").alias("record_count"), F.count_distinct("customer_id").alias("unique_customers"))
    )


_BUCKET = """CASE WHEN percent_paid = 0 THEN '0%' WHEN percent_paid < 25 THEN '1-24%' WHEN percent_paid < 50 THEN '25-49%'
  WHEN percent_paid < 75 THEN '50-74%' WHEN percent_paid < 100 THEN '75-99%' ELSE '100%' END"""


@query(
    "rate_by_payment_band",
    using("silver", f"SELECT {_BUCKET} AS payment_bucket, count(*) AS record_count, {LOAN_RATE} FROM silver GROUP BY 1"),
)
def rate_by_payment_band(spark, sf):
    paid = F.col("percent_paid")
    band = F.when(paid == 0, "0%").otherwise(fx.left_closed_bands(paid, *ag.PAYMENT_BANDS))
    return rounded(
        ag.rate_by(credit.silver_loans(spark, sf), {"payment_bucket": band}, F.col("is_default"), rows="record_count")
    )


@query(
    "paid_by_status",
    using("silver", "SELECT payment_status, round(avg(percent_paid), 4) AS avg_percent_paid, count(*) AS record_count FROM silver GROUP BY 1"),
)
def paid_by_status(spark, sf):
    df = credit.silver_loans(spark, sf).groupBy("payment_status").agg(
        F.avg("percent_paid").alias("avg_percent_paid"), F.count("*").alias("record_count")
    )
    return rounded(df)


def _gold_rate(spark, sf, keys, means):
    df = ag.rate_by(credit.gold_table(spark, sf), keys, F.col("has_defaulted"), rows="customer_count", means=means)
    return rounded(df)


@query(
    "rate_by_age_band",
    using(
        "gold",
        f"""SELECT CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54'
              ELSE '55+' END AS age_group, count(*) AS customer_count, round(avg(annual_income), 4) AS avg_income, {GOLD_RATE},
              round(avg(default_risk_score), 4) AS avg_risk_score FROM gold GROUP BY 1""",
    ),
)
def rate_by_age_band(spark, sf):
    return _gold_rate(
        spark,
        sf,
        {"age_group": fx.left_closed_bands(F.col("age"), *ag.AGE_BANDS)},
        {"avg_income": "annual_income", "avg_risk_score": "default_risk_score"},
    )


@query(
    "top_occupations",
    using(
        "gold",
        f"""SELECT occupation, count(*) AS customer_count, round(avg(annual_income), 4) AS avg_income, {GOLD_RATE},
              round(avg(default_risk_score), 4) AS avg_risk_score FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
)
def top_occupations(spark, sf):
    df = _gold_rate(
        spark,
        sf,
        {"occupation": F.col("occupation")},
        {"avg_income": "annual_income", "avg_risk_score": "default_risk_score"},
    )
    return sampling.top_k(df, [F.desc("customer_count")], 10, ["occupation"])


@query(
    "rate_by_income_band",
    using(
        "gold",
        f"""SELECT CASE WHEN annual_income < 30000 THEN '< $30K' WHEN annual_income < 50000 THEN '$30K - $50K'
              WHEN annual_income < 75000 THEN '$50K - $75K' WHEN annual_income < 100000 THEN '$75K - $100K' ELSE '> $100K' END AS income_bucket,
              count(*) AS customer_count, round(avg(credit_utilization_ratio), 4) AS avg_credit_util,
              round(avg(outstanding_debt), 4) AS avg_debt, {GOLD_RATE} FROM gold GROUP BY 1""",
    ),
)
def rate_by_income_band(spark, sf):
    return _gold_rate(
        spark,
        sf,
        {"income_bucket": fx.left_closed_bands(F.col("annual_income"), *ag.INCOME_BANDS)},
        {"avg_credit_util": "credit_utilization_ratio", "avg_debt": "outstanding_debt"},
    )


@query(
    "rate_by_credit_mix",
    using(
        "gold",
        f"""SELECT credit_mix, count(*) AS customer_count, round(avg(annual_income), 4) AS avg_income,
              round(avg(credit_utilization_ratio), 4) AS avg_credit_util, {GOLD_RATE} FROM gold GROUP BY 1""",
    ),
)
def rate_by_credit_mix(spark, sf):
    return _gold_rate(
        spark,
        sf,
        {"credit_mix": F.col("credit_mix")},
        {"avg_income": "annual_income", "avg_credit_util": "credit_utilization_ratio"},
    )


@query(
    "rate_by_loan_count",
    using(
        "gold",
        f"""SELECT total_loans, count(*) AS customer_count, round(avg(num_defaulted_loans), 4) AS avg_defaulted_loans,
              round(avg(max_missed_payments), 4) AS avg_max_missed_payments, {GOLD_RATE} FROM gold GROUP BY 1""",
    ),
)
def rate_by_loan_count(spark, sf):
    return _gold_rate(
        spark,
        sf,
        {"total_loans": F.col("total_loans")},
        {"avg_defaulted_loans": "num_defaulted_loans", "avg_max_missed_payments": "max_missed_payments"},
    )


@query(
    "rate_by_clickstream",
    using(
        "gold",
        f"SELECT has_clickstream_data, count(*) AS customer_count, {GOLD_RATE}, round(avg(default_risk_score), 4) AS avg_risk_score FROM gold GROUP BY 1",
    ),
)
def rate_by_clickstream(spark, sf):
    return _gold_rate(
        spark, sf, {"has_clickstream_data": F.col("has_clickstream_data")}, {"avg_risk_score": "default_risk_score"}
    )


@query(
    "rate_by_behaviour",
    using(
        "gold",
        f"""SELECT payment_behavior_spent_level AS spent_level, payment_behavior_value_level AS value_level, count(*) AS customer_count,
              {GOLD_RATE}, round(avg(default_risk_score), 4) AS avg_risk_score FROM gold GROUP BY 1, 2""",
    ),
)
def rate_by_behaviour(spark, sf):
    return _gold_rate(
        spark,
        sf,
        {"spent_level": F.col("payment_behavior_spent_level"), "value_level": F.col("payment_behavior_value_level")},
        {"avg_risk_score": "default_risk_score"},
    )


_PIVOT = ", ".join(
    f"""round(sum(CASE WHEN payment_behavior_value_level = '{v}' AND has_defaulted THEN 1 ELSE 0 END) * 100.0::DOUBLE
        / nullif(sum(CASE WHEN payment_behavior_value_level = '{v}' THEN 1 ELSE 0 END), 0), 4) AS {v.lower()}"""
    for v in ("LARGE", "MEDIUM", "SMALL", "UNKNOWN")
)


@query("behaviour_pivot", using("gold", f"SELECT payment_behavior_spent_level AS spent_level, {_PIVOT} FROM gold GROUP BY 1"))
def behaviour_pivot(spark, sf):
    gold = credit.gold_table(spark, sf).withColumnRenamed("payment_behavior_spent_level", "spent_level")
    df = ag.behaviour_pivot(
        gold, "spent_level", "payment_behavior_value_level", ["LARGE", "MEDIUM", "SMALL", "UNKNOWN"], F.col("has_defaulted")
    )
    return rounded(df)


@query(
    "risk_score_bands",
    using(
        "gold",
        """SELECT CASE WHEN default_risk_score > 0 AND default_risk_score <= 10 THEN '0-10' WHEN default_risk_score > 10 AND default_risk_score <= 25 THEN '11-25'
             WHEN default_risk_score > 25 AND default_risk_score <= 50 THEN '26-50' WHEN default_risk_score > 50 AND default_risk_score <= 75 THEN '51-75'
             WHEN default_risk_score > 75 AND default_risk_score <= 100 THEN '76-100' WHEN default_risk_score > 100 AND default_risk_score <= 150 THEN '100+' END AS risk_bucket,
             count(*) AS row_count FROM gold GROUP BY 1""",
    ),
)
def risk_score_bands(spark, sf):
    band = fx.right_closed_cut(F.col("default_risk_score"), *ag.RISK_CUT)
    return credit.gold_table(spark, sf).groupBy(band.alias("risk_bucket")).agg(F.count("*").alias("row_count"))


# ---------------------------------------------------------------- summaries and profiles

_MEASURES = ["consecutive_missed_payments", "percent_paid", "overdue_amt", "balance"]


@query(
    "portfolio_summary",
    using(
        "silver",
        "SELECT count(*) AS total_records, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT loan_id) AS unique_loans, "
        + ", ".join(f"round(avg({m}), 4) AS avg_{m}, round(stddev_samp({m}), 4) AS stddev_{m}" for m in _MEASURES)
        + f", {LOAN_RATE} FROM silver",
    ),
)
def portfolio_summary(spark, sf):
    df = ag.portfolio_summary(
        credit.silver_loans(spark, sf),
        {"unique_customers": "customer_id", "unique_loans": "loan_id"},
        _MEASURES,
        F.col("is_default"),
    )
    return rounded(df)


@query(
    "business_metrics",
    using(
        "gold",
        f"""SELECT count(*) AS total_customers, round(avg(annual_income), 4) AS avg_income, round(avg(credit_utilization_ratio), 4) AS avg_credit_util,
              round(avg(credit_history_total_months), 4) AS avg_credit_history, {GOLD_RATE}, round(avg(default_risk_score), 4) AS avg_risk_score,
              count(CASE WHEN has_clickstream_data THEN 1 END) AS customers_with_clickstream, round(avg(num_defaulted_loans), 4) AS avg_defaulted_loans
            FROM gold""",
    ),
)
def business_metrics(spark, sf):
    df = credit.gold_table(spark, sf).agg(
        F.count("*").alias("total_customers"),
        F.avg("annual_income").alias("avg_income"),
        F.avg("credit_utilization_ratio").alias("avg_credit_util"),
        F.avg("credit_history_total_months").alias("avg_credit_history"),
        ag.share_of(F.col("has_defaulted")).alias("default_rate"),
        F.avg("default_risk_score").alias("avg_risk_score"),
        F.count_if("has_clickstream_data").alias("customers_with_clickstream"),
        F.avg("num_defaulted_loans").alias("avg_defaulted_loans"),
    )
    return rounded(df)


def _five(column, source, label=None):
    return (
        f"SELECT '{label or column}' AS \"column\", count({column}) AS n, round(CAST(min({column}) AS DOUBLE), 4) AS min, "
        + ", ".join(
            f"round(CAST(quantile_cont(CAST({column} AS DOUBLE), {q}) AS DOUBLE), 4) AS {n}"
            for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        )
        + f", round(CAST(max({column}) AS DOUBLE), 4) AS max FROM {source}"
    )


@query("five_number_score", using("gold", _five("default_risk_score", "gold")))
def five_number_score(spark, sf):
    return rounded(ag.five_number(credit.gold_table(spark, sf), "default_risk_score"))


@query("five_number_balance", using("silver", _five("balance", "silver")))
def five_number_balance(spark, sf):
    return rounded(ag.five_number(views.ledger(spark, sf), "balance"))


_CLICK_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, round(quantile_cont({c}, 0.5), 6) AS median FROM clicks"""
    for c in views.FEATURES
)


@query("column_profile", using("clicks", f"SELECT * FROM ({_CLICK_PROFILE})"))
def column_profile(spark, sf):
    return rounded(ag.column_profile(views.clicks(spark, sf), views.FEATURES), 6)


@query("approximate_profile")
def approximate_profile(spark, sf):
    return ag.approximate_profile(views.clicks(spark, sf), views.FEATURES)


@query(
    "records_per_key",
    using(
        "silver",
        """SELECT min(n) AS min_records, max(n) AS max_records, round(avg(n), 4) AS avg_records, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median_records
           FROM (SELECT customer_id, count(*) AS n FROM ledger GROUP BY 1)""",
    ),
)
def records_per_key(spark, sf):
    return rounded(ag.records_per_key(views.ledger(spark, sf), "customer_id"))


@query(
    "date_coverage",
    using("ledger", "SELECT min(snapshot_date) AS first_day, max(snapshot_date) AS last_day, count(DISTINCT snapshot_date) AS days FROM ledger"),
)
def date_coverage(spark, sf):
    return ag.date_coverage(views.ledger(spark, sf), "snapshot_date")


@query(
    "rows_by_month",
    using("ledger", "SELECT CAST(year(snapshot_date) AS INTEGER) AS year, CAST(month(snapshot_date) AS INTEGER) AS month, count(*) AS row_count FROM ledger GROUP BY 1, 2"),
)
def rows_by_month(spark, sf):
    return ag.rows_by_month(views.ledger(spark, sf), "snapshot_date")


@query(
    "frequency",
    using("silver_attributes", "SELECT age, count(*) AS row_count FROM silver_attributes WHERE age IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def frequency(spark, sf):
    return ag.frequency(credit.silver_attributes(spark, sf).where(F.col("age").isNotNull()), "age", 10)


_CORR = ["consecutive_missed_payments", "percent_paid", "overdue_amt", "balance"]
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation FROM silver"
    for i, a in enumerate(_CORR)
    for b in _CORR[i + 1 :]
)


@query("correlation_matrix", using("silver", f"SELECT * FROM ({_CORR_SQL})"))
def correlation_matrix(spark, sf):
    return rounded(ag.correlation_matrix(credit.silver_loans(spark, sf), _CORR), 6)


_KEY_FEATURES = [
    "age", "annual_income", "monthly_inhand_salary", "num_bank_accounts", "num_credit_card", "interest_rate",
    "credit_utilization_ratio", "credit_history_total_months", "outstanding_debt", "num_delayed_payments", "total_loans",
    "num_defaulted_loans", "max_missed_payments", "default_risk_score",
]
_TARGET_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(abs(corr(CAST({c} AS DOUBLE), CAST(CAST(has_defaulted AS INTEGER) AS DOUBLE))), 6) AS strength FROM gold"""
    for c in _KEY_FEATURES
)


@query("target_correlation", using("gold", _TARGET_SQL))
def target_correlation(spark, sf):
    target = F.col("has_defaulted").cast("int")
    return rounded(ag.target_correlation(credit.gold_table(spark, sf), _KEY_FEATURES, target), 6)


@query(
    "bad_rate_by_mob",
    using(
        "labels_store",
        """SELECT mob, round(avg(CASE WHEN dpd >= 30 THEN 1.0 ELSE 0.0 END), 6) AS bad_rate, count(*) AS row_count FROM (
             SELECT d.*, l.loan_start_date FROM dpds d JOIN (SELECT DISTINCT CAST(loan_id AS VARCHAR) AS loan_id, loan_start_date FROM ledger) l USING (loan_id))
           WHERE loan_start_date < DATE '2000-01-01' GROUP BY 1""",
    ),
)
def bad_rate_by_mob(spark, sf):
    rows = ops.days_past_due(ag.completed_only(views.ledger(spark, sf), "2000-01-01"))
    return rounded(ag.bad_rate_by_mob(rows), 6)


@query(
    "completed_only",
    using("ledger", "SELECT loan_id, installment_num, balance FROM (SELECT loan_id, installment_num, loan_start_date, round(balance, 4) AS balance FROM ledger) WHERE loan_start_date < DATE '2000-01-01' AND installment_num = 10"),
)
def completed_only(spark, sf):
    df = ag.completed_only(views.ledger(spark, sf), "2000-01-01").where(F.col("installment_num") == 10)
    return rounded(df.select("loan_id", "installment_num", "balance"))


@query(
    "condition_counts",
    using(
        "gold",
        """SELECT * FROM (
             SELECT 'high_risk' AS condition, count(CASE WHEN default_risk_score > 100 THEN 1 END) AS row_count,
               round(count(CASE WHEN default_risk_score > 100 THEN 1 END) * 100.0::DOUBLE / count(*), 4) AS percent FROM gold
             UNION ALL SELECT 'missing_age', count(CASE WHEN age IS NULL THEN 1 END), round(count(CASE WHEN age IS NULL THEN 1 END) * 100.0::DOUBLE / count(*), 4) FROM gold
             UNION ALL SELECT 'imputed_clickstream', count(CASE WHEN clickstream_features_imputed THEN 1 END),
               round(count(CASE WHEN clickstream_features_imputed THEN 1 END) * 100.0::DOUBLE / count(*), 4) FROM gold)""",
    ),
)
def condition_counts(spark, sf):
    df = ag.condition_counts(
        credit.gold_table(spark, sf),
        {
            "high_risk": F.col("default_risk_score") > 100,
            "missing_age": F.col("age").isNull(),
            "imputed_clickstream": F.col("clickstream_features_imputed"),
        },
    )
    return rounded(df)


# ---------------------------------------------------------------- quality

_FIN_COLUMNS = [c.split()[0] for c in layers.SCHEMAS["financials"].split(", ")]


@query(
    "null_profile",
    using(
        "financials",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS null_percent FROM financials"""
            for c in _FIN_COLUMNS
        )
        + ")",
    ),
)
def null_profile(spark, sf):
    return rounded(quality.null_profile(views.financials(spark, sf).select(*_FIN_COLUMNS)))


_LEDGER_COLUMNS = [c.split()[0] for c in layers.SCHEMAS["loan_daily"].split(", ")]


@query(
    "distinct_profile",
    using(
        "ledger",
        "SELECT * FROM ("
        + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "values" FROM ledger""" for c in _LEDGER_COLUMNS)
        + ")",
    ),
)
def distinct_profile(spark, sf):
    return quality.distinct_profile(views.ledger(spark, sf), _LEDGER_COLUMNS)


@query(
    "key_overlap",
    using(
        "ledger attributes clicks",
        """SELECT t AS "table", n AS unique_keys, a AS in_all, n - a AS missing_elsewhere FROM (
             SELECT 'loans' AS t, count(DISTINCT customer_id) AS n FROM ledger
             UNION ALL SELECT 'attributes', count(DISTINCT customer_id) FROM attributes
             UNION ALL SELECT 'clicks', count(DISTINCT customer_id) FROM clicks),
           (SELECT count(*) AS a FROM (SELECT customer_id FROM ledger INTERSECT SELECT customer_id FROM attributes INTERSECT SELECT customer_id FROM clicks))""",
    ),
)
def key_overlap(spark, sf):
    return quality.key_overlap(
        {"loans": views.loan_heads(spark, sf).join(views.loan_lines(spark, sf).select("loan_id").distinct(), "loan_id"),
         "attributes": views.attributes(spark, sf), "clicks": views.clicks(spark, sf)},
        "customer_id",
    )


@query(
    "key_changes",
    using(
        "attributes clicks",
        """SELECT (SELECT count(DISTINCT customer_id) FROM attributes) AS keys_before, (SELECT count(DISTINCT customer_id) FROM clicks) AS keys_after,
             (SELECT count(*) FROM (SELECT customer_id FROM attributes EXCEPT SELECT customer_id FROM clicks)) AS lost,
             (SELECT count(*) FROM (SELECT customer_id FROM clicks EXCEPT SELECT customer_id FROM attributes)) AS added""",
    ),
)
def key_changes(spark, sf):
    return quality.key_changes(views.attributes(spark, sf), views.clicks(spark, sf), "customer_id")


@query(
    "keep_listed",
    using("ledger clicks", "SELECT loan_id, installment_num, customer_id FROM ledger WHERE customer_id IN (SELECT customer_id FROM clicks)"),
)
def keep_listed(spark, sf):
    df = quality.keep_listed(views.ledger(spark, sf), views.clicks(spark, sf), "customer_id")
    return df.select("loan_id", "installment_num", "customer_id")


_EXPECTED_BALANCE = "loan_amt - (installment_num * due_amt - overdue_amt)"
_EXPECTED_OVERDUE = "CASE WHEN installment_num > 0 THEN installment_num * due_amt - paid_amt ELSE 0 END"


@query(
    "balance_check",
    using("ledger", f"SELECT abs({_EXPECTED_BALANCE} - balance) <= 0.0055 AS matches, count(*) AS row_count FROM ledger GROUP BY 1"),
)
def balance_check(spark, sf):
    return quality.match_counts(views.ledger(spark, sf), quality.expected_balance(), F.col("balance"), tolerance=0.0055)


@query(
    "balance_mismatches",
    using(
        "ledger",
        f"""SELECT loan_id, installment_num, round(expected, 4) AS expected, round(balance, 4) AS balance
            FROM (SELECT *, {_EXPECTED_BALANCE} AS expected FROM ledger) WHERE abs(expected - balance) > 0.0055 ORDER BY loan_id, installment_num LIMIT 5""",
    ),
)
def balance_mismatches(spark, sf):
    df = quality.mismatches(
        views.ledger(spark, sf), quality.expected_balance(), F.col("balance"), ["loan_id", "installment_num"], 5, 0.0055
    )
    return rounded(df.select("loan_id", "installment_num", "expected", "balance"))


@query(
    "overdue_check",
    using("ledger", f"SELECT installment_num, abs({_EXPECTED_OVERDUE} - overdue_amt) <= 0.0055 AS matches, count(*) AS row_count FROM ledger GROUP BY 1, 2"),
)
def overdue_check(spark, sf):
    return quality.match_counts(
        views.ledger(spark, sf), quality.expected_overdue(), F.col("overdue_amt"), ["installment_num"], 0.0055
    )


@query(
    "overdue_ratio",
    using(
        "ledger",
        f"""SELECT count(*) AS row_count, round(avg(r), 6) AS mean_ratio, round(stddev_samp(r), 6) AS stddev_ratio, round(min(r), 6) AS min_ratio, round(max(r), 6) AS max_ratio
            FROM (SELECT CASE WHEN e > 0 THEN overdue_amt / e ELSE 0 END AS r FROM (SELECT *, {_EXPECTED_OVERDUE} AS e FROM ledger))""",
    ),
)
def overdue_ratio(spark, sf):
    return rounded(quality.overdue_ratio(views.ledger(spark, sf)), 6)


@query(
    "rule_check",
    using(
        "silver",
        """SELECT rule, n AS checked, k AS agreeing, 100.0::DOUBLE * k / n AS percent FROM (
             SELECT 'payment_status' AS rule, count(*) AS n, count(*) AS k FROM silver UNION ALL SELECT 'is_default', count(*), count(*) FROM silver
             UNION ALL SELECT 'percent_paid', count(*), count(*) FROM silver UNION ALL SELECT 'loan_age_months', count(*), count(*) FROM silver
             UNION ALL SELECT 'legacy_reset', count(*), (SELECT count(*) FROM (SELECT misses - base AS a, misses - sum(CASE WHEN monthly_overdue_flag = 0
                 AND installment_num > 0 THEN misses ELSE 0 END) OVER (PARTITION BY loan_id ORDER BY installment_num ROWS UNBOUNDED PRECEDING) AS b FROM based)
                 WHERE a = b) FROM silver)""",
    ),
)
def rule_check(spark, sf):
    """The legacy run formula is one of the rules, so one of the percentages is below 100."""

    def with_legacy(rows, slice_by):
        silver = ops.silver_ledger(rows, slice_by)
        kept = silver.withColumnRenamed("consecutive_missed_payments", "reset_run")
        return ops.consecutive_missed(kept, "legacy", slice_by)

    c = F.col
    status = fx.payment_status(c("installment_num"), c("monthly_overdue_flag"), c("overdue_amt"), c("due_amt"))
    paid = fx.percent_paid(c("total_paid_amount"), c("installment_num") * c("due_amt"))
    return quality.rule_check(
        views.ledger(spark, sf, with_legacy),
        {
            "payment_status": (c("payment_status"), status),
            "is_default": (c("is_default"), c("reset_run") >= 3),
            "percent_paid": (c("percent_paid"), paid),
            "loan_age_months": (c("loan_age_months"), F.datediff("snapshot_date", "loan_start_date") / 30),
            "legacy_reset": (c("reset_run"), c("consecutive_missed_payments")),
        },
    )


_DIRTY = ["annual_income", "outstanding_debt", "amount_invested_monthly", "changed_credit_limit", "monthly_balance", "num_of_loan", "num_of_delayed_payment"]


@query(
    "pattern_violations",
    using(
        "financials",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(CASE WHEN regexp_matches({c}, '[^0-9.-]') THEN 1 END) AS violations,
                round(count(CASE WHEN regexp_matches({c}, '[^0-9.-]') THEN 1 END) * 100.0::DOUBLE / count(*), 4) AS percent,
                min(CASE WHEN regexp_matches({c}, '[^0-9.-]') THEN {c} END) AS example FROM financials"""
            for c in _DIRTY
        )
        + ")",
    ),
)
def pattern_violations(spark, sf):
    return rounded(quality.pattern_violations(views.financials(spark, sf), _DIRTY))


@query(
    "violation_samples",
    using("financials", "SELECT DISTINCT outstanding_debt AS value FROM financials WHERE regexp_matches(outstanding_debt, '[^0-9.-]') ORDER BY 1 LIMIT 5"),
)
def violation_samples(spark, sf):
    return quality.violation_samples(views.financials(spark, sf), "outstanding_debt", 5)


@query(
    "layer_report",
    using(
        "silver_attributes silver_financials ledger clicks",
        f"""SELECT "table", metric, round(CAST(value AS DOUBLE), 4) AS value FROM (
             SELECT 'attributes' AS "table", 'total_rows' AS metric, count(*)::DOUBLE AS value FROM silver_attributes
             UNION ALL SELECT 'attributes', 'null_age_percent', count(CASE WHEN age IS NULL THEN 1 END) * 100.0::DOUBLE / count(*) FROM silver_attributes
             UNION ALL SELECT 'attributes', 'valid_ssn_percent', count(CASE WHEN is_valid_ssn THEN 1 END) * 100.0::DOUBLE / count(*) FROM silver_attributes
             UNION ALL SELECT 'financials', 'total_rows', count(*) FROM silver_financials
             UNION ALL SELECT 'financials', 'null_income_percent', count(CASE WHEN annual_income IS NULL THEN 1 END) * 100.0::DOUBLE / count(*) FROM silver_financials
             UNION ALL SELECT 'financials', 'credit_mix_percent:' || credit_mix, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM silver_financials) FROM silver_financials GROUP BY credit_mix
             UNION ALL SELECT 'loans', 'total_rows', count(*) FROM ledger
             UNION ALL SELECT 'loans', 'amount_check_valid_percent', count(CASE WHEN abs({_EXPECTED_BALANCE} - balance) <= 0.005 THEN 1 END) * 100.0::DOUBLE / count(*) FROM ledger
             UNION ALL SELECT 'clicks', 'total_rows', count(*) FROM clicks
             UNION ALL SELECT 'clicks', 'rows_per_customer', count(*)::DOUBLE / count(DISTINCT customer_id) FROM clicks)""",
    ),
)
def layer_report(spark, sf):
    df = quality.layer_report(
        credit.silver_attributes(spark, sf),
        credit.silver_financials(spark, sf),
        views.ledger(spark, sf),
        views.clicks(spark, sf),
    )
    return rounded(df)


_BRONZE = {
    "ledger": "loan_id, customer_id, loan_start_date, snapshot_date, tenure, installment_num, loan_amt, due_amt, paid_amt, overdue_amt, balance",
    "financials": "customer_id, annual_income, outstanding_debt, amount_invested_monthly, changed_credit_limit, monthly_balance, num_of_loan, num_of_delayed_payment, "
    "credit_history_age, payment_of_min_amount, credit_mix, payment_behaviour, type_of_loan, monthly_inhand_salary, num_bank_accounts, num_credit_card, interest_rate, "
    "delay_from_due_date, num_credit_inquiries, credit_utilization_ratio, total_emi_per_month, snapshot_date",
    "attributes": "customer_id, name, age, ssn, occupation, snapshot_date",
    "clicks": "click_id, customer_id, snapshot_date, " + ", ".join(f"fe_{i}" for i in range(1, 21)),
}
_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS source, '{c}' AS \"column\", count(*) AS row_count, count(*) - count({c}) AS nulls FROM {t}" for t, cols in _BRONZE.items() for c in cols.split(", ")
)


@query(
    "run_summary",
    using(
        "ledger financials attributes clicks",
        f"""WITH counted AS ({_COUNTS}), sizes AS (SELECT source, max(row_count) AS row_count FROM counted GROUP BY 1), bad AS (SELECT source, "column", nulls FROM counted WHERE nulls > 0)
            SELECT sizes.source, sizes.row_count, CASE source WHEN 'financials' THEN 'branch' ELSE '' END AS missing, "column", nulls,
              (SELECT count(*) FROM sizes) AS tables_processed, (SELECT sum(row_count)::BIGINT FROM sizes) AS total_rows_processed, TRUE AS timed
            FROM sizes LEFT JOIN bad USING (source)""",
    ),
)
def run_summary(spark, sf):
    """The four bronze tables, written as one JSON document and read back; one row per column with NULLs."""
    from ledgerline.session import stage_path

    made = {"ledger": views.ledger, "financials": views.financials, "attributes": views.attributes, "clicks": views.clicks}
    tables = {n: view(spark, sf) for n, view in made.items()}
    path = stage_path(spark, "run-summary")
    quality.write_run_summary(quality.run_summary({n: (df, [*df.columns, "branch"] if n == "financials" else df.columns) for n, df in tables.items()}, 1.5), path)
    rows = quality.read_run_summary(spark, path).select("pipeline_run", F.explode("table_summaries").alias("t"))
    timed = F.col("t.validation_timestamp").isNotNull() & F.col("pipeline_run.timestamp").isNotNull() & (F.col("pipeline_run.runtime_seconds") == 1.5)
    return rows.select(
        "t.source", "t.row_count", F.array_join("t.missing_columns", ",").alias("missing"), F.explode_outer("t.null_counts").alias("column", "nulls"),
        "pipeline_run.tables_processed", "pipeline_run.total_rows_processed", timed.alias("timed"),
    )


@query(
    "non_null_compare",
    using(
        "silver_attributes",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", (SELECT count({c}) FROM attributes) AS before, (SELECT count({c}) FROM silver_attributes) AS after,
                round((SELECT count({c}) FROM silver_attributes) * 100.0::DOUBLE / (SELECT count({c}) FROM attributes), 4) AS percent"""
            for c in ("customer_id", "name", "age", "ssn", "occupation", "snapshot_date")
        )
        + ")",
    ),
)
def non_null_compare(spark, sf):
    pairs = {c: c for c in ("customer_id", "name", "age", "ssn", "occupation", "snapshot_date")}
    return rounded(quality.non_null_compare(views.attributes(spark, sf), credit.silver_attributes(spark, sf), pairs))


@query(
    "status_path",
    using(
        "silver",
        """SELECT loan_id, installment_num, due_amt, paid_amt, overdue_amt, payment_status, consecutive_missed_payments, is_default, round(percent_paid, 4) AS percent_paid
           FROM silver WHERE loan_id = (SELECT min(loan_id) FROM silver WHERE installment_num <= 5 AND is_default)""",
    ),
)
def status_path(spark, sf):
    silver = credit.silver_loans(spark, sf)
    picked = quality.example_loans(silver).where(F.col("kind") == "early_default").select("loan_id").scalar()
    return rounded(quality.status_path(silver, picked), 4, ["percent_paid"])


@query(
    "example_loans",
    using(
        "silver",
        """SELECT kind, loan_id FROM (
             SELECT 'on_time' AS kind, min(CASE WHEN installment_num = 7 AND NOT is_default AND payment_status = 'PAID_ON_TIME' THEN loan_id END) AS loan_id FROM silver
             UNION ALL SELECT 'early_default', min(CASE WHEN installment_num <= 5 AND is_default THEN loan_id END) FROM silver
             UNION ALL SELECT 'mixed', min(CASE WHEN installment_num = 7 AND percent_paid BETWEEN 40 AND 60 THEN loan_id END) FROM silver
             UNION ALL SELECT 'recovered', min(CASE WHEN installment_num = 7 AND consecutive_missed_payments = 0 AND percent_paid < 100 AND percent_paid > 0 THEN loan_id END) FROM silver)""",
    ),
)
def example_loans(spark, sf):
    return quality.example_loans(credit.silver_loans(spark, sf), last=7)


@query(
    "worst_loans",
    using(
        "silver",
        "SELECT loan_id, round(percent_paid, 4) AS percent_paid, consecutive_missed_payments FROM silver WHERE installment_num = 7 ORDER BY silver.percent_paid, loan_id LIMIT 3",
    ),
)
def worst_loans(spark, sf):
    return rounded(quality.worst_loans(credit.silver_loans(spark, sf), last=7))


# ---------------------------------------------------------------- samples and order


@query("pick_one")
def pick_one(spark, sf):
    bad = credit.silver_loans(spark, sf).where(F.col("is_default") & (F.col("installment_num") == 7))
    return sampling.pick_one(bad.select("loan_id"), ["loan_id"], seed=1)


@query("sample_rows")
def sample_rows(spark, sf):
    rows = credit.silver_loans(spark, sf).select("loan_id", "installment_num", "percent_paid", "overdue_amt", "is_default")
    return sampling.sample_n(rows, 5000, ["loan_id", "installment_num"])


def _told(sample, again, other, of, size):
    """Size, whether all sampled rows are rows of the table, no row twice, the same again, and others with another seed."""
    missing = sample.exceptAll(of).isEmpty()
    same = sample.exceptAll(again).isEmpty() and again.exceptAll(sample).isEmpty()
    return of.agg(
        F.lit(sample.count()).cast("bigint").alias("sampled"), F.lit(missing and sample.distinct().count() == size).alias("members"),
        F.lit(same).alias("repeatable"), F.lit(not sample.exceptAll(other).isEmpty()).alias("seeded"), F.count("*").alias("of_rows"),
    )


@query("pick_one_told", "SELECT 1::BIGINT AS sampled, TRUE AS members, TRUE AS repeatable, TRUE AS seeded, count(*) AS of_rows FROM orders")
def pick_one_told(spark, sf):
    rows = views.table(spark, sf, "orders").select("o_orderkey")
    one = sampling.pick_one(rows, ["o_orderkey"], seed=1)
    return _told(one, sampling.pick_one(rows.repartition(5), ["o_orderkey"], seed=1), sampling.pick_one(rows, ["o_orderkey"], seed=2), rows, 1)


@query("sample_rows_told", "SELECT least(500, count(*)) AS sampled, TRUE AS members, TRUE AS repeatable, TRUE AS seeded, count(*) AS of_rows FROM lineitem")
def sample_rows_told(spark, sf):
    key = ["l_orderkey", "l_linenumber"]
    rows = views.table(spark, sf, "lineitem").select(*key, "l_quantity", "l_partkey", "l_suppkey")
    of = [*key, "l_partkey", "l_suppkey"]
    some = sampling.sample_n(rows, 500, of)
    return _told(some, sampling.sample_n(rows.repartition(5), 500, of), sampling.sample_n(rows, 500, of, seed=3), rows, 500)


@query("ordered_groups", using("silver", "SELECT payment_status, count(*) AS row_count FROM silver GROUP BY 1 ORDER BY 1"))
def ordered_groups(spark, sf):
    counts = credit.silver_loans(spark, sf).groupBy("payment_status").agg(F.count("*").alias("row_count"))
    return sampling.ordered(counts, ["payment_status"])
