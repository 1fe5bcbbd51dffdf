"""Loan ledger, customer tables, gold table and label store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.helpers import each, rnd, rounded
from checks.registry import query
from checks.views_sql import FEATURES, LOAN_KINDS, extend, using
from ledgerline.functions import cleaning as cl
from ledgerline.functions import lending as fx
from ledgerline.operators import behaviour, customers, lending
from ledgerline.operators.scans import scan
from ledgerline.plans import credit
from ledgerline.sources import views

LOAN_KEYS = ["loan_id", "installment_num"]


# ---------------------------------------------------------------- ledger rows and windows


@query("loan_ledger", using("ledger", f"SELECT * REPLACE ({rnd('overdue_amt', 'balance')}) FROM ledger"))
def loan_ledger(spark, sf):
    return rounded(views.ledger(spark, sf), 4, ["overdue_amt", "balance"])


@query(
    "payment_flags",
    using("silver", "SELECT loan_id, installment_num, payment_made_flag, monthly_overdue_flag, round(payment_ratio, 4) AS payment_ratio FROM flags"),
)
def payment_flags(spark, sf):
    df = lending.payment_flags(views.ledger(spark, sf))
    return rounded(df.select(*LOAN_KEYS, "payment_made_flag", "monthly_overdue_flag", "payment_ratio"))


@query("payment_status", using("silver", "SELECT loan_id, installment_num, payment_status FROM silver"))
def payment_status(spark, sf):
    df = lending.payment_status(lending.payment_flags(views.ledger(spark, sf)))
    return df.select(*LOAN_KEYS, "payment_status")


@query(
    "loan_dates",
    using(
        "silver",
        "SELECT loan_id, installment_num, round(CAST(loan_age_months AS DOUBLE), 4) AS loan_age_months, remaining_tenure,"
        " expected_end_date, is_active_loan FROM silver",
    ),
)
def loan_dates(spark, sf):
    df = lending.loan_dates(views.ledger(spark, sf))
    return rounded(df.select(*LOAN_KEYS, "loan_age_months", "remaining_tenure", "expected_end_date", "is_active_loan"))


@query("running_total", using("silver", "SELECT loan_id, installment_num, round(total_paid_amount, 4) AS total_paid_amount FROM flags"))
def running_total(spark, sf):
    df = views.ledger(spark, sf, lending.running_total)
    return df.select(*LOAN_KEYS, F.round("total_paid_amount", 4).alias("total_paid_amount"))


@query(
    "percent_paid",
    using("silver", "SELECT loan_id, installment_num, round(total_due_amount, 2) AS total_due_amount, round(percent_paid, 4) AS percent_paid FROM silver"),
)
def percent_paid(spark, sf):
    df = lending.percent_paid(views.ledger(spark, sf, lending.running_total))
    return df.select(
        *LOAN_KEYS,
        F.round("total_due_amount", 2).alias("total_due_amount"),
        F.round("percent_paid", 4).alias("percent_paid"),
    )


def _missed(mode):
    def build(rows, slice_by):
        return lending.consecutive_missed(lending.payment_flags(rows), mode, slice_by)

    return build


@query("consecutive_missed", using("silver", "SELECT loan_id, installment_num, consecutive_missed_payments FROM silver"))
def consecutive_missed(spark, sf):
    df = views.ledger(spark, sf, _missed("reset"))
    return df.select(*LOAN_KEYS, "consecutive_missed_payments")


@query(
    "consecutive_missed_legacy",
    using(
        "silver",
        """SELECT loan_id, installment_num,
             CAST(misses - sum(CASE WHEN monthly_overdue_flag = 0 AND installment_num > 0 THEN misses ELSE 0 END)
               OVER (PARTITION BY loan_id ORDER BY installment_num ROWS UNBOUNDED PRECEDING) AS BIGINT) AS consecutive_missed_payments
           FROM counted""",
    ),
)
def consecutive_missed_legacy(spark, sf):
    df = views.ledger(spark, sf, _missed("legacy"))
    return df.select(*LOAN_KEYS, "consecutive_missed_payments")


@query(
    "default_flag",
    using("silver", "SELECT is_default, payment_status, count(*) AS rows FROM silver GROUP BY 1, 2"),
)
def default_flag(spark, sf):
    return credit.silver_loans(spark, sf).groupBy("is_default", "payment_status").agg(F.count("*").alias("rows"))


@query(
    "previous_status",
    using(
        "silver",
        "SELECT loan_id, installment_num, lag(payment_made_flag) OVER (PARTITION BY loan_id ORDER BY installment_num) AS previous_made_flag FROM flags",
    ),
)
def previous_status(spark, sf):
    df = views.ledger(spark, sf, lambda rows, s: lending.previous_status(lending.payment_flags(rows), s))
    return df.select(*LOAN_KEYS, "previous_made_flag")


@query(
    "silver_loan_table",
    using(
        "silver",
        "SELECT * REPLACE ("
        + rnd("overdue_amt", "balance", "payment_ratio", "loan_age_months", "percent_paid", "loan_amt", "due_amt", "paid_amt")
        + ", round(total_due_amount, 4) AS total_due_amount, round(total_paid_amount, 4) AS total_paid_amount) FROM silver",
    ),
)
def silver_loan_table(spark, sf):
    return rounded(credit.silver_loans(spark, sf))


# ---------------------------------------------------------------- cleaning

_FIN = "financials"


@query("clean_numbers", using("silver_financials", "SELECT customer_id, annual_income, outstanding_debt, amount_invested_monthly FROM silver_financials"))
def clean_numbers(spark, sf):
    names = ["annual_income", "outstanding_debt", "amount_invested_monthly"]
    return views.financials(spark, sf).select("customer_id", *[cl.clean_number(F.col(n)).alias(n) for n in names])


@query("clean_signed_numbers", using("silver_financials", "SELECT customer_id, changed_credit_limit, monthly_balance FROM silver_financials"))
def clean_signed_numbers(spark, sf):
    names = ["changed_credit_limit", "monthly_balance"]
    return views.financials(spark, sf).select("customer_id", *[cl.clean_signed_number(F.col(n)).alias(n) for n in names])


@query("clean_counts", using("silver_financials", "SELECT customer_id, num_of_loans, num_delayed_payments FROM silver_financials"))
def clean_counts(spark, sf):
    return views.financials(spark, sf).select(
        "customer_id",
        cl.clean_count(F.col("num_of_loan")).alias("num_of_loans"),
        cl.clean_count(F.col("num_of_delayed_payment")).alias("num_delayed_payments"),
    )


@query("clean_age", using("silver_attributes", "SELECT customer_id, age, is_valid_age FROM silver_attributes"))
def clean_age(spark, sf):
    return views.attributes(spark, sf).select(
        "customer_id", cl.clean_age(F.col("age")).alias("age"), cl.is_valid_age(F.col("age")).alias("is_valid_age")
    )


@query("matches_format", using("silver_attributes", "SELECT customer_id, ssn, is_valid_ssn FROM silver_attributes"))
def matches_format(spark, sf):
    return views.attributes(spark, sf).select("customer_id", "ssn", cl.matches_format(F.col("ssn")).alias("is_valid_ssn"))


@query("normalize_category", using("silver_attributes", "SELECT customer_id, occupation FROM silver_attributes"))
def normalize_category(spark, sf):
    return views.attributes(spark, sf).select("customer_id", cl.normalize_category(F.col("occupation")).alias("occupation"))


_MONTHS = """
CASE WHEN day({d}) = 1
  THEN CAST((2025 - year({d})) * 12 + 5 - month({d}) AS DOUBLE)
  ELSE (2025 - year({d})) * 12 + 5 - month({d}) + (1 - day({d})) / 31.0 END"""


@query(
    "data_age_months",
    using("attributes", f"SELECT customer_id, round(CAST({_MONTHS.format(d='snapshot_date')} AS DOUBLE), 6) AS data_age_months FROM attributes"),
)
def data_age_months(spark, sf):
    asof = F.lit(customers.ATTRIBUTES_ASOF).cast("date")
    return views.attributes(spark, sf).select(
        "customer_id", F.round(cl.data_age_months(asof, F.col("snapshot_date")), 6).alias("data_age_months")
    )


@query(
    "parse_years_months",
    using("silver_financials", "SELECT customer_id, credit_history_years, credit_history_months, credit_history_total_months FROM silver_financials"),
)
def parse_years_months(spark, sf):
    text = F.col("credit_history_age")
    return views.financials(spark, sf).select(
        "customer_id",
        cl.history_years(text).alias("credit_history_years"),
        cl.history_months(text).alias("credit_history_months"),
        cl.history_total_months(text).alias("credit_history_total_months"),
    )


@query(
    "map_values",
    using(
        "financials",
        """SELECT customer_id,
             CASE payment_of_min_amount WHEN 'Yes' THEN 'YES' WHEN 'No' THEN 'NO' WHEN 'NM' THEN 'NOT_SPECIFIED' ELSE 'UNKNOWN' END AS min_payment,
             CASE payment_of_min_amount WHEN 'Yes' THEN TRUE WHEN 'No' THEN FALSE END AS is_min_payment_made,
             CASE credit_mix WHEN '_' THEN 'UNKNOWN' ELSE upper(credit_mix) END AS credit_mix
           FROM financials""",
    ),
)
def map_values(spark, sf):
    paid = F.col("payment_of_min_amount")
    return views.financials(spark, sf).select(
        "customer_id",
        cl.map_values(paid, cl.MIN_PAYMENT_NAMES, F.lit("UNKNOWN")).alias("min_payment"),
        cl.map_values(paid, cl.MIN_PAYMENT_FLAGS).alias("is_min_payment_made"),
        cl.map_values(F.col("credit_mix"), cl.CREDIT_MIX_NAMES, F.upper("credit_mix")).alias("credit_mix"),
    )


@query(
    "extract_level",
    using("silver_financials", "SELECT customer_id, payment_behavior_spent_level AS spent_level, payment_behavior_value_level AS value_level FROM silver_financials"),
)
def extract_level(spark, sf):
    text = F.col("payment_behaviour")
    return views.financials(spark, sf).select(
        "customer_id",
        cl.extract_level(text, cl.SPENT_LEVELS).alias("spent_level"),
        cl.extract_level(text, cl.VALUE_LEVELS).alias("value_level"),
    )


@query(
    "split_list",
    using(
        "financials",
        """SELECT customer_id,
             CASE WHEN type_of_loan IS NULL THEN 0 ELSE CAST(len(string_split(type_of_loan, ',')) AS INTEGER) END AS items,
             CASE WHEN type_of_loan IS NULL THEN 1 ELSE CAST(len(string_split(type_of_loan, ',')) AS INTEGER) END AS items_legacy
           FROM financials""",
    ),
)
def split_list(spark, sf):
    text = F.col("type_of_loan")
    return views.financials(spark, sf).select(
        "customer_id",
        F.size(cl.split_list(text)).alias("items"),
        F.size(cl.split_list(text, null_as_empty=False)).alias("items_legacy"),
    )


_FLAGS = [cl.flag_name(k) for k in LOAN_KINDS]


@query("membership_flags", using("silver_financials", f"SELECT customer_id, {', '.join(_FLAGS)} FROM silver_financials"))
def membership_flags(spark, sf):
    flags = cl.membership_flags(cl.split_list(F.col("type_of_loan")))
    return views.financials(spark, sf).select("customer_id", *[c.alias(n) for n, c in flags.items()])


@query(
    "explode_vocabulary",
    using("financials", "SELECT DISTINCT trim(item) AS item FROM (SELECT unnest(string_split(type_of_loan, ',')) AS item FROM financials)"),
)
def explode_vocabulary(spark, sf):
    return customers.vocabulary(views.financials(spark, sf), "type_of_loan")


@query(
    "parse_dates",
    """WITH texts AS (
         SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
           CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%-d/%m/%Y')
             WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d 07:30:00') ELSE 'n/a' END AS txt
         FROM orders)
       SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN d END AS parsed FROM texts""",
)
def parse_dates(spark, sf):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderkey") % 4 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 4 == 1, F.date_format(day, "d/MM/yyyy"))
        .when(F.col("o_orderkey") % 4 == 2, F.date_format(day, "yyyy-MM-dd 07:30:00"))
        .otherwise("n/a")
    )
    return views.table(spark, sf, "orders").select("o_orderkey", cl.parse_date(text).alias("parsed"))


@query(
    "default_date",
    using("financials", "SELECT customer_id, coalesce(snapshot_date, DATE '2023-01-01') AS snapshot_date FROM financials"),
)
def default_date(spark, sf):
    return views.financials(spark, sf).select(
        "customer_id", cl.default_date(F.col("snapshot_date"), "2023-01-01").alias("snapshot_date")
    )


@query(
    "enforce_types",
    using(
        "financials",
        """SELECT CAST(customer_id AS VARCHAR) AS customer_id, TRY_CAST(annual_income AS DOUBLE) AS annual_income,
             TRY_CAST(monthly_balance AS DOUBLE) AS monthly_balance, TRY_CAST(credit_mix AS INTEGER) AS credit_mix,
             TRY_CAST(interest_rate AS BIGINT) AS interest_rate
           FROM financials""",
    ),
)
def enforce_types(spark, sf):
    types = {
        "customer_id": "string",
        "annual_income": "double",
        "monthly_balance": "double",
        "credit_mix": "int",
        "interest_rate": "bigint",
    }
    return customers.enforce_types(views.financials(spark, sf).select(*types), types)


@query(
    "silver_attributes_table",
    using(
        "silver_attributes",
        f"SELECT *, round(CAST({_MONTHS.format(d='snapshot_date')} AS DOUBLE), 6) AS data_age_months FROM silver_attributes",
    ),
)
def silver_attributes_table(spark, sf):
    return rounded(credit.silver_attributes(spark, sf), 6)


@query(
    "silver_financials_table",
    using("silver_financials", f"SELECT * REPLACE ({rnd('monthly_inhand_salary', 'total_emi_per_month', 'credit_utilization_ratio', digits=6)}) FROM silver_financials"),
)
def silver_financials_table(spark, sf):
    return rounded(
        credit.silver_financials(spark, sf), 6, ["monthly_inhand_salary", "total_emi_per_month", "credit_utilization_ratio"]
    )


# ---------------------------------------------------------------- behaviour rows


@query(
    "global_stats",
    using("clicks", "SELECT " + each("round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_stddev", FEATURES) + " FROM clicks"),
)
def global_stats(spark, sf):
    return rounded(behaviour.global_stats(views.clicks(spark, sf), views.FEATURES), 6)


@query(
    "zscore",
    using(
        "click_detail",
        "SELECT click_id, " + each("round({c}_normalized, 6) AS {c}_normalized, {c}_is_outlier", FEATURES) + " FROM click_detail",
    ),
)
def zscore(spark, sf):
    df = behaviour.zscore(views.clicks(spark, sf), views.FEATURES)
    made = [f"{f}_{kind}" for f in views.FEATURES for kind in ("normalized", "is_outlier")]
    return rounded(df.select("click_id", *made), 6)


_SEQUENCE = "row_num_by_customer, month, quarter, year, first_snapshot_date, months_since_first"


@query("sequence_in_key", using("click_detail", f"SELECT click_id, {_SEQUENCE} FROM click_detail"))
def sequence_in_key(spark, sf):
    df = behaviour.sequence_in_key(views.clicks(spark, sf), "customer_id", "snapshot_date", ["click_id"])
    return df.select("click_id", *_SEQUENCE.split(", "))


@query(
    "join_first_seen",
    using("click_detail", "SELECT c.click_id, c.customer_id, f.first_snapshot_date FROM clicks c JOIN first_seen f USING (customer_id)"),
)
def join_first_seen(spark, sf):
    df = behaviour.join_first_seen(views.clicks(spark, sf), "customer_id", "snapshot_date")
    return df.select("click_id", "customer_id", "first_snapshot_date")


@query(
    "clickstream_detail_table",
    using(
        "click_detail",
        f"SELECT click_id, customer_id, snapshot_date, {_SEQUENCE}, "
        + each("round({c}, 6) AS {c}, round({c}_normalized, 6) AS {c}_normalized, {c}_is_outlier", FEATURES)
        + " FROM click_detail",
    ),
)
def clickstream_detail_table(spark, sf):
    return rounded(credit.click_detail(spark, sf), 6)


_AGG_ROUND = [f"{f}_{k}" for f in FEATURES for k in ("mean", "max", "min", "stddev")]


@query("feature_aggregates", using("click_detail", f"SELECT * REPLACE ({rnd(*_AGG_ROUND, digits=6)}) FROM click_agg"))
def feature_aggregates(spark, sf):
    return rounded(credit.click_aggregates(spark, sf), 6)


# ---------------------------------------------------------------- joins and gold table

extend(
    "summary",
    """
summary AS (
  SELECT customer_id, count(DISTINCT loan_id) AS total_loans,
         CAST(sum(CASE WHEN is_default THEN 1 ELSE 0 END) AS BIGINT) AS num_defaulted_loans,
         count(DISTINCT CASE WHEN is_default THEN loan_id END) AS num_distinct_defaulted_loans,
         avg(consecutive_missed_payments) AS avg_missed_payments, max(consecutive_missed_payments) AS max_missed_payments,
         avg(percent_paid) AS avg_percent_paid, max(overdue_amt) AS max_overdue_amt, min(balance) AS min_balance
  FROM silver GROUP BY customer_id)""",
    ("silver",),
)

_BEHAVIOUR = customers.behaviour_columns()

extend(
    "gold",
    """
profile AS (
  SELECT a.customer_id, k.customer_id IS NOT NULL AS has_clickstream_data, a.age, a.occupation, a.is_valid_age, f.annual_income,
         f.monthly_inhand_salary, f.num_bank_accounts, f.num_credit_card, f.interest_rate, f.credit_utilization_ratio,
         f.credit_history_total_months, f.outstanding_debt, f.num_delayed_payments, f.credit_mix,
         f.payment_behavior_spent_level, f.payment_behavior_value_level, """
    + ", ".join(f"coalesce(k.{c}, 0) AS {c}" for c in _BEHAVIOUR)
    + """, k.customer_id IS NULL AS clickstream_features_imputed
  FROM silver_attributes a LEFT JOIN silver_financials f USING (customer_id) LEFT JOIN click_agg k ON k.customer_id = a.customer_id),
joined AS (
  SELECT p.*, s.total_loans, s.num_defaulted_loans, s.num_distinct_defaulted_loans, s.avg_missed_payments, s.max_missed_payments,
         s.avg_percent_paid, s.max_overdue_amt, s.min_balance, s.num_defaulted_loans > 0 AS has_defaulted
  FROM profile p LEFT JOIN summary s USING (customer_id)),
scored AS (
  SELECT *, CAST(CASE WHEN num_defaulted_loans > 0 THEN 50 ELSE 0 END + num_defaulted_loans * 5 + floor(max_missed_payments * 1.5)
      + CASE WHEN outstanding_debt / nullif(annual_income, 0) * 100 > 50 THEN 10
             WHEN outstanding_debt / nullif(annual_income, 0) * 100 > 30 THEN 6
             WHEN outstanding_debt / nullif(annual_income, 0) * 100 > 10 THEN 3 ELSE 0 END
      + CASE credit_mix WHEN 'BAD' THEN 10 WHEN 'STANDARD' THEN 5 WHEN 'GOOD' THEN 0 ELSE 5 END
      + CASE WHEN credit_history_total_months < 120 THEN 5 WHEN credit_history_total_months < 240 THEN 3 ELSE 0 END
      + CASE WHEN payment_behavior_spent_level = 'HIGH' THEN 3 ELSE 0 END
      + CASE WHEN payment_behavior_value_level = 'LARGE' THEN 2 ELSE 0 END
      + CASE WHEN annual_income < 50000 THEN 5 WHEN annual_income < 100000 THEN 3 ELSE 0 END
      + CASE WHEN total_loans > 3 THEN 5 WHEN total_loans > 1 THEN 3 ELSE 0 END
      + CASE WHEN max_overdue_amt > 5000 THEN 5 WHEN max_overdue_amt > 1000 THEN 3 WHEN max_overdue_amt > 0 THEN 1 ELSE 0 END
      AS INTEGER) AS raw_score
  FROM joined),
gold AS (
  SELECT * EXCLUDE (raw_score), CASE WHEN raw_score > 120 THEN 120 WHEN raw_score < 0 THEN 0 ELSE raw_score END AS default_risk_score
  FROM scored)""",
    ("silver_attributes", "silver_financials", "click_detail", "summary"),
)


@query(
    "loan_summary",
    using("summary", f"SELECT * REPLACE ({rnd('avg_missed_payments', 'avg_percent_paid', 'max_overdue_amt', 'min_balance')}) FROM summary"),
)
def loan_summary(spark, sf):
    return rounded(customers.loan_summary(credit.silver_loans(spark, sf)))


@query(
    "base_with_presence",
    using(
        "attributes clicks",
        """SELECT a.customer_id, c.customer_id IS NOT NULL AS has_clickstream_data
           FROM attributes a LEFT JOIN (SELECT DISTINCT customer_id FROM clicks) c USING (customer_id)""",
    ),
)
def base_with_presence(spark, sf):
    base = views.attributes(spark, sf).select("customer_id")
    return customers.base_with_presence(base, views.clicks(spark, sf), "customer_id", "has_clickstream_data")


_PROFILE = ", ".join(customers.PROFILE_ATTRIBUTES + customers.PROFILE_FINANCIALS)


@query(
    "customer_profile",
    using(
        "silver_attributes silver_financials",
        f"SELECT * REPLACE (round(monthly_inhand_salary, 4) AS monthly_inhand_salary) FROM (SELECT a.customer_id, {_PROFILE}"
        " FROM silver_attributes a LEFT JOIN silver_financials f USING (customer_id))",
    ),
)
def customer_profile(spark, sf):
    attributes = credit.silver_attributes(spark, sf)
    df = customers.customer_profile(attributes.select("customer_id"), attributes, credit.silver_financials(spark, sf))
    return rounded(df, 4, ["monthly_inhand_salary"])


@query(
    "attach_behaviour",
    using("gold", f"SELECT customer_id, clickstream_features_imputed, {each('round(CAST({c} AS DOUBLE), 6) AS {c}', _BEHAVIOUR[:10])}, {', '.join(_BEHAVIOUR[10:])} FROM profile"),
)
def attach_behaviour(spark, sf):
    clicks = credit.behaviour_for_gold(spark, sf)
    base = customers.base_with_presence(
        credit.silver_attributes(spark, sf).select("customer_id"), clicks, "customer_id", "has_clickstream_data"
    )
    return rounded(customers.attach_behaviour(base, clicks).drop("has_clickstream_data"), 6)


@query(
    "attach_loans",
    using("gold", "SELECT customer_id, total_loans, num_defaulted_loans, has_defaulted FROM joined"),
)
def attach_loans(spark, sf):
    summary = customers.loan_summary(credit.silver_loans(spark, sf))
    df = customers.attach_loans(credit.silver_attributes(spark, sf).select("customer_id"), summary)
    return df.select("customer_id", "total_loans", "num_defaulted_loans", "has_defaulted")


@query("risk_score", using("gold", "SELECT customer_id, has_defaulted, default_risk_score FROM gold"))
def risk_score(spark, sf):
    return credit.gold_table(spark, sf).select("customer_id", "has_defaulted", "default_risk_score")


@query(
    "clamp",
    using("ledger", "SELECT loan_id, installment_num, CASE WHEN balance > 100000 THEN 100000 WHEN balance < 0 THEN 0 ELSE round(balance, 3) END AS balance FROM ledger"),
)
def clamp(spark, sf):
    return views.ledger(spark, sf).select(*LOAN_KEYS, F.round(fx.clamp(F.col("balance"), 0.0, 100000.0), 3).alias("balance"))


_GOLD_ROUND = ["monthly_inhand_salary", "avg_missed_payments", "avg_percent_paid", "max_overdue_amt", "min_balance", *_BEHAVIOUR[:10]]


@query("gold_feature_table", using("gold", f"SELECT * REPLACE ({rnd(*_GOLD_ROUND)}) FROM gold"))
def gold_feature_table(spark, sf):
    return rounded(credit.gold_table(spark, sf), 4, _GOLD_ROUND)


@query("gold_label_table", using("gold", "SELECT customer_id, has_defaulted, default_risk_score, has_clickstream_data FROM gold"))
def gold_label_table(spark, sf):
    return customers.label_table(credit.gold_table(spark, sf))


@query(
    "latest_record",
    using(
        "silver",
        """SELECT s.customer_id, s.loan_id, s.installment_num, s.snapshot_date, s.is_default, s.payment_status FROM silver s
           JOIN (SELECT customer_id, max(snapshot_date) AS d FROM silver GROUP BY 1) m ON m.customer_id = s.customer_id AND m.d = s.snapshot_date""",
    ),
)
def latest_record(spark, sf):
    df = customers.latest_record(credit.silver_loans(spark, sf), "customer_id", "snapshot_date")
    return df.select("customer_id", *LOAN_KEYS, "snapshot_date", "is_default", "payment_status")


@query(
    "raw_feature_label",
    using(
        "gold",
        """SELECT l.customer_id, l.is_default, l.payment_status, l.consecutive_missed_payments, l.snapshot_date, a.age, a.occupation,
                  a.is_valid_ssn, f.annual_income, f.num_of_loans, f.has_payday_loan, k.record_count,
                  round(k.fe_1_mean, 6) AS fe_1_mean, k.fe_1_mean IS NOT NULL AS has_clickstream_data
           FROM silver l JOIN (SELECT customer_id, max(snapshot_date) AS d FROM silver GROUP BY 1) m
             ON m.customer_id = l.customer_id AND m.d = l.snapshot_date
           LEFT JOIN silver_attributes a ON a.customer_id = l.customer_id
           LEFT JOIN silver_financials f ON f.customer_id = l.customer_id
           LEFT JOIN click_agg k ON k.customer_id = l.customer_id""",
    ),
)
def raw_feature_label(spark, sf):
    df = customers.raw_feature_label(
        credit.silver_loans(spark, sf),
        credit.silver_attributes(spark, sf),
        credit.silver_financials(spark, sf),
        credit.click_aggregates(spark, sf),
    )
    df = df.select(
        "customer_id", "is_default", "payment_status", "consecutive_missed_payments", "snapshot_date", "age", "occupation",
        "is_valid_ssn", "annual_income", "num_of_loans", "has_payday_loan", "record_count", "fe_1_mean", "has_clickstream_data",
    )
    return rounded(df, 6, ["fe_1_mean"])


# ---------------------------------------------------------------- label store

extend(
    "labels_store",
    """
typed AS (
  SELECT CAST(loan_id AS VARCHAR) AS loan_id, CAST(customer_id AS VARCHAR) AS customer_id, loan_start_date, snapshot_date, installment_num,
         CAST(CAST(due_amt AS FLOAT) AS DOUBLE) AS due_amt, CAST(CAST(overdue_amt AS FLOAT) AS DOUBLE) AS overdue_amt
  FROM ledger),
missed AS (
  SELECT *, installment_num AS mob, CAST(coalesce(ceil(overdue_amt / nullif(due_amt, 0)), 0) AS INTEGER) AS installments_missed FROM typed),
dated AS (
  SELECT *, CASE WHEN installments_missed > 0 THEN CAST(snapshot_date - INTERVAL 1 MONTH * installments_missed AS DATE) END AS first_missed_date FROM missed),
dpds AS (
  SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN datediff('day', first_missed_date, snapshot_date) ELSE 0 END AS INTEGER) AS dpd FROM dated),
label_rows AS (
  SELECT loan_id, customer_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date
  FROM dpds WHERE mob = 6)""",
    ("ledger",),
)


@query(
    "days_past_due",
    using("labels_store", "SELECT loan_id, mob, snapshot_date, installments_missed, first_missed_date, dpd FROM dpds"),
)
def days_past_due(spark, sf):
    typed = customers.enforce_types(views.ledger(spark, sf), credit.LEDGER_TYPES)
    return lending.days_past_due(typed).select(
        "loan_id", "mob", "snapshot_date", "installments_missed", "first_missed_date", "dpd"
    )


@query("dpd_label", using("labels_store", "SELECT * FROM label_rows"))
def dpd_label(spark, sf):
    return credit.label_store(views.ledger(spark, sf))


extend(
    "click_features",
    "\nclick_features AS (SELECT CAST(customer_id AS VARCHAR) AS customer_id, date_trunc('month', snapshot_date) + INTERVAL 0 DAY AS month_start, "
    + each("avg({c}) AS {c}", FEATURES)
    + " FROM clicks GROUP BY 1, 2)",
    ("clicks",),
)


def _monthly_features(spark, sf):
    """Features of a customer by month; label days are moved to the month start to meet them."""
    clicks = views.clicks(spark, sf)
    return clicks.groupBy(
        (F.col("customer_id")).cast("string").alias("customer_id"),
        F.trunc(F.add_months("snapshot_date", -300), "month").alias("snapshot_date"),
    ).agg(*[F.avg(f).alias(f) for f in views.FEATURES])


def _monthly_labels(spark, sf):
    labels = credit.label_store(views.ledger(spark, sf))
    return labels.withColumns(
        {
            "customer_id": (F.col("customer_id").cast("bigint") % 50).cast("string"),
            "snapshot_date": F.trunc("snapshot_date", "month"),
        }
    )


_TRAINING = """
month_features AS (
  SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(date_trunc('month', snapshot_date - INTERVAL 300 MONTH) AS DATE) AS snapshot_date,
    """ + each("avg({c}) AS {c}", FEATURES) + """
  FROM clicks GROUP BY 1, 2),
month_labels AS (
  SELECT loan_id, CAST(CAST(customer_id AS BIGINT) % 50 AS VARCHAR) AS customer_id, label, label_def,
    CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_date
  FROM label_rows)"""

extend("training", _TRAINING, ("labels_store", "clicks"))


@query(
    "label_feature_join",
    using(
        "training",
        "SELECT l.loan_id, l.customer_id, l.snapshot_date, l.label, " + each("round(f.{c}, 6) AS {c}", FEATURES) + """
           FROM month_labels l LEFT JOIN month_features f ON f.customer_id = l.customer_id AND f.snapshot_date = l.snapshot_date""",
    ),
)
def label_feature_join(spark, sf):
    df = customers.label_feature_join(_monthly_labels(spark, sf), _monthly_features(spark, sf))
    return rounded(df.select("loan_id", "customer_id", "snapshot_date", "label", *FEATURES), 6)


TRAIN_DATE = date(1999, 1, 1)


@query(
    "training_set",
    using(
        "training",
        "SELECT l.loan_id, l.customer_id, l.snapshot_date, l.label, l.label_def, " + each("round(f.{c}, 6) AS {c}", FEATURES) + """, CASE WHEN l.snapshot_date >= DATE '1998-11-01' THEN 'oot' ELSE 'train_test' END AS split
           FROM month_labels l LEFT JOIN month_features f ON f.customer_id = l.customer_id AND f.snapshot_date = l.snapshot_date
           WHERE l.snapshot_date BETWEEN DATE '1997-11-01' AND DATE '1998-12-31'""",
    ),
)
def training_set(spark, sf):
    df = credit.training_set(_monthly_labels(spark, sf), _monthly_features(spark, sf), TRAIN_DATE)
    return rounded(df, 6)
