"""SQL twins of the stand-in views, as common table expressions."""

from __future__ import annotations

USES = [
    "Education", "Lodging/residential", "Office", "Entertainment/public assembly", "Public services",
    "Other", "Retail", "Parking", "Warehouse/storage", "Food sales and service", "Religious worship",
    "Utility", "Technology/science", "Healthcare", "Manufacturing/industrial", "Services",
]

_LEDGER = """
lines AS (
  SELECT l_orderkey AS loan_id, CAST(l_shipdate AS DATE) AS snapshot_date, l_linenumber, l_partkey, l_suppkey,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS due,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2))
              * CASE l_returnflag WHEN 'R' THEN 0.0 WHEN 'A' THEN 0.5 ELSE 1.0 END AS DECIMAL(18,3)) AS paid
  FROM lineitem),
running AS (
  SELECT *, row_number() OVER w AS line,
         sum(due) OVER (w ROWS UNBOUNDED PRECEDING) AS due_to_date,
         sum(paid) OVER (w ROWS UNBOUNDED PRECEDING) AS paid_to_date
  FROM lines
  WINDOW w AS (PARTITION BY loan_id ORDER BY snapshot_date, l_linenumber, l_partkey, l_suppkey)),
ledger AS (
  SELECT r.loan_id, o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS loan_start_date, r.snapshot_date,
         10 AS tenure, CAST(r.line - 1 AS INTEGER) AS installment_num,
         CAST(CAST(o.o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS loan_amt,
         CAST(r.due AS DOUBLE) AS due_amt, CAST(r.paid AS DOUBLE) AS paid_amt,
         CAST(greatest(r.due_to_date - r.paid_to_date, 0) AS DOUBLE) AS overdue_amt,
         CAST(CAST(o.o_totalprice AS DECIMAL(14,2)) - r.paid_to_date AS DOUBLE) AS balance
  FROM running r JOIN orders o ON o.o_orderkey = r.loan_id)"""

_SILVER = """
flags AS (
  SELECT *, CASE WHEN paid_amt >= due_amt THEN 1 ELSE 0 END AS payment_made_flag,
         CASE WHEN installment_num > 0 AND paid_amt < due_amt THEN 1 ELSE 0 END AS monthly_overdue_flag,
         installment_num * due_amt AS total_due_amount,
         sum(paid_amt) OVER (PARTITION BY loan_id ORDER BY installment_num ROWS UNBOUNDED PRECEDING) AS total_paid_amount,
         CASE WHEN due_amt > 0 THEN paid_amt / due_amt ELSE 1.0 END AS payment_ratio
  FROM ledger),
counted AS (
  SELECT *, sum(monthly_overdue_flag) OVER (PARTITION BY loan_id ORDER BY installment_num ROWS UNBOUNDED PRECEDING) AS misses
  FROM flags),
based AS (
  SELECT *, coalesce(max(CASE WHEN monthly_overdue_flag = 0 THEN misses END)
                     OVER (PARTITION BY loan_id ORDER BY installment_num ROWS UNBOUNDED PRECEDING), 0) AS base
  FROM counted),
silver AS (
  SELECT loan_id, customer_id, loan_start_date, snapshot_date, tenure, installment_num, loan_amt, due_amt, paid_amt,
         overdue_amt, balance, payment_made_flag, monthly_overdue_flag, total_due_amount, total_paid_amount, payment_ratio,
         CASE WHEN installment_num = 0 THEN 'LOAN_INITIATED' WHEN monthly_overdue_flag = 0 THEN 'PAID_ON_TIME'
              WHEN overdue_amt <= due_amt THEN 'MISSED_PAYMENT' WHEN overdue_amt <= due_amt * 3 THEN 'OVERDUE'
              ELSE 'SEVERELY_OVERDUE' END AS payment_status,
         CAST(misses - base AS BIGINT) AS consecutive_missed_payments,
         datediff('day', loan_start_date, snapshot_date) / 30.0 AS loan_age_months,
         tenure - installment_num AS remaining_tenure,
         CAST(loan_start_date + INTERVAL 1 DAY * (tenure * 30) AS DATE) AS expected_end_date,
         (installment_num < tenure AND snapshot_date <= CAST(loan_start_date + INTERVAL 1 DAY * (tenure * 30) AS DATE)) AS is_active_loan,
         misses - base >= 3 AS is_default,
         CASE WHEN total_due_amount > 0 THEN total_paid_amount / total_due_amount * 100 ELSE 0 END AS percent_paid
  FROM based)"""

_ATTRIBUTES = """
attributes AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'abc'
              WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 130 - 5 AS VARCHAR) || '_'
              ELSE CAST(c_custkey % 130 - 5 AS VARCHAR) END AS age,
         CASE WHEN c_custkey % 23 = 0 THEN NULL
              WHEN c_custkey % 7 = 0 THEN lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
                   || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
              ELSE lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-'
                   || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
              END AS ssn,
         CASE WHEN c_custkey % 11 = 0 THEN '_______' WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN ''
              ELSE ' ' || lower(c_mktsegment) || '_mgr ' END AS occupation,
         CAST(DATE '2023-01-01' + INTERVAL 1 DAY * (c_custkey % 700) AS DATE) AS snapshot_date
  FROM customer)"""

_SILVER_ATTRIBUTES = r"""
parsed_attributes AS (
  SELECT *, TRY_CAST(CASE WHEN regexp_matches(regexp_replace(age, '[^0-9-]', '', 'g'), '^-?[0-9]+$')
                     THEN regexp_replace(age, '[^0-9-]', '', 'g') END AS INTEGER) AS age_int
  FROM attributes),
silver_attributes AS (
  SELECT customer_id, name, snapshot_date, CASE WHEN age_int BETWEEN 1 AND 100 THEN age_int END AS age,
         coalesce(age_int BETWEEN 1 AND 100, FALSE) AS is_valid_age, ssn,
         regexp_matches(ssn, '^[0-9]{3}-[0-9]{2}-[0-9]{4}$') AS is_valid_ssn,
         CASE WHEN occupation IS NULL OR occupation IN ('_______', '') THEN 'Unknown'
              ELSE upper(substr(trim(occupation), 1, 1)) || lower(substr(trim(occupation), 2)) END AS occupation
  FROM parsed_attributes)"""

_FINANCIALS = """
financials AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN '1.2.3' WHEN c_custkey % 41 = 0 THEN ''
         ELSE '$' || CAST(abs(bal) * 10 AS VARCHAR) || '_' END AS annual_income,
    CAST(abs(bal) AS VARCHAR) || CASE WHEN c_custkey % 3 = 0 THEN '_' ELSE '' END AS outstanding_debt,
    '__' || CAST(abs(bal) AS VARCHAR) || '__' AS amount_invested_monthly,
    CAST(bal AS VARCHAR) || CASE WHEN c_custkey % 6 = 0 THEN '_' ELSE '' END AS changed_credit_limit,
    CASE WHEN c_custkey % 43 = 0 THEN '--3' ELSE CAST(bal AS VARCHAR) END AS monthly_balance,
    CASE WHEN c_custkey % 14 = 0 THEN 'many' ELSE CAST(c_custkey % 9 AS VARCHAR) || '_' END AS num_of_loan,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE '-' || CAST(c_custkey % 25 AS VARCHAR) END AS num_of_delayed_payment,
    CASE WHEN c_custkey % 18 = 0 THEN 'NA' ELSE CAST(c_custkey % 33 AS VARCHAR) || ' Years and '
         || CAST(c_custkey % 12 AS VARCHAR) || ' Months' END AS credit_history_age,
    CASE c_custkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'NM' ELSE '?' END AS payment_of_min_amount,
    CASE WHEN c_custkey % 4 = 0 THEN '_' WHEN c_custkey % 4 = 1 THEN 'Bad' WHEN c_custkey % 4 = 2 THEN 'Good'
         WHEN c_custkey % 15 = 0 THEN 'other' ELSE 'Standard' END AS credit_mix,
    CASE WHEN c_custkey % 2 = 0 THEN 'High' WHEN c_custkey % 9 = 0 THEN 'No' ELSE 'Low' END || '_spent_'
      || CASE c_custkey % 5 WHEN 1 THEN 'Large' WHEN 2 THEN 'Medium' WHEN 3 THEN 'Small' ELSE 'Any' END
      || '_value_payments' AS payment_behaviour,
    CASE WHEN c_custkey % 5 = 0 THEN NULL
         WHEN c_custkey % 3 = 0 THEN 'Auto Loan'
         WHEN c_custkey % 3 = 1 THEN 'Payday Loan, Student Loan'
         ELSE 'Student Loan, and Mortgage Loan' END AS type_of_loan,
    CAST(abs(bal) AS DOUBLE) / 12 AS monthly_inhand_salary,
    CAST(c_custkey % 11 AS INTEGER) AS num_bank_accounts, CAST(c_custkey % 7 AS INTEGER) AS num_credit_card,
    CAST(c_custkey % 34 AS INTEGER) AS interest_rate, CAST(c_custkey % 62 AS INTEGER) AS delay_from_due_date,
    CAST(c_custkey % 17 AS INTEGER) AS num_credit_inquiries, (c_custkey % 500) / 10.0 AS credit_utilization_ratio,
    CAST(abs(bal) AS DOUBLE) / 24 AS total_emi_per_month, CAST(NULL AS DATE) AS snapshot_date
  FROM (SELECT *, CAST(c_acctbal AS DECIMAL(14,2)) AS bal FROM customer))"""


def _plain(col: str) -> str:
    kept = f"regexp_replace({col}, '[^0-9.]', '', 'g')"
    return rf"TRY_CAST(CASE WHEN regexp_matches({kept}, '^[0-9]+(\.[0-9]+)?$') THEN {kept} END AS DOUBLE)"


def _signed(col: str) -> str:
    kept = f"regexp_replace({col}, '[^0-9.-]', '', 'g')"
    return rf"TRY_CAST(CASE WHEN regexp_matches({kept}, '^-?[0-9]+(\.[0-9]+)?$') THEN {kept} END AS DOUBLE)"


def _count(col: str) -> str:
    return f"coalesce(TRY_CAST(regexp_replace({col}, '[^0-9]', '', 'g') AS INTEGER), 0)"


def _history(part: str) -> str:
    years = "coalesce(TRY_CAST(regexp_extract(credit_history_age, '^([0-9]+) Years?', 1) AS INTEGER), 0)"
    months = "coalesce(TRY_CAST(regexp_extract(credit_history_age, 'and ([0-9]+) Months?', 1) AS INTEGER), 0)"
    return {"years": years, "months": months, "total": f"{years} * 12 + {months}"}[part]


LOAN_KINDS = [
    "Personal Loan", "Student Loan", "Mortgage Loan", "Auto Loan", "Home Equity Loan", "Debt Consolidation Loan",
    "Credit-Builder Loan", "Payday Loan",
]


def _flag(kind: str) -> str:
    name = "has_" + kind.lower().replace("-", "_").replace(" ", "_")
    items = "string_split(type_of_loan, ',')"
    return f"coalesce(list_contains({items}, '{kind}') OR list_contains({items}, ' {kind}'), FALSE) AS {name}"


_SILVER_FINANCIALS = f"""
silver_financials AS (
  SELECT customer_id, snapshot_date, {_plain('annual_income')} AS annual_income, monthly_inhand_salary, num_bank_accounts,
    num_credit_card, interest_rate, {_count('num_of_loan')} AS num_of_loans,
    CASE WHEN type_of_loan IS NULL THEN 0 ELSE CAST(len(string_split(type_of_loan, ',')) AS INTEGER) END AS loan_types_count,
    {", ".join(_flag(k) for k in LOAN_KINDS)},
    delay_from_due_date, {_count('num_of_delayed_payment')} AS num_delayed_payments,
    {_signed('changed_credit_limit')} AS changed_credit_limit, num_credit_inquiries,
    CASE credit_mix WHEN '_' THEN 'UNKNOWN' ELSE upper(credit_mix) END AS credit_mix,
    {_plain('outstanding_debt')} AS outstanding_debt, credit_utilization_ratio,
    {_history('years')} AS credit_history_years, {_history('months')} AS credit_history_months,
    {_history('total')} AS credit_history_total_months,
    CASE payment_of_min_amount WHEN 'Yes' THEN TRUE WHEN 'No' THEN FALSE END AS is_min_payment_made,
    total_emi_per_month, {_plain('amount_invested_monthly')} AS amount_invested_monthly,
    CASE WHEN contains(payment_behaviour, 'High_spent') THEN 'HIGH'
         WHEN contains(payment_behaviour, 'Low_spent') THEN 'LOW' ELSE 'UNKNOWN' END AS payment_behavior_spent_level,
    CASE WHEN contains(payment_behaviour, 'Large_value') THEN 'LARGE' WHEN contains(payment_behaviour, 'Medium_value') THEN 'MEDIUM'
         WHEN contains(payment_behaviour, 'Small_value') THEN 'SMALL' ELSE 'UNKNOWN' END AS payment_behavior_value_level,
    {_signed('monthly_balance')} AS monthly_balance
  FROM financials)"""

FEATURES = [f"fe_{i}" for i in range(1, 21)]

_CLICKS = (
    "\nclicks AS (SELECT vec_id AS click_id, vec_id % 50 AS customer_id,"
    " CAST(DATE '2023-01-01' + INTERVAL 1 MONTH * label AS DATE) AS snapshot_date, "
    + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS fe_{i}" for i in range(1, 21))
    + " FROM embeddings)"
)

_CLICK_STATS = (
    "\nclick_stats AS (SELECT "
    + ", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in FEATURES)
    + " FROM clicks),\nfirst_seen AS (SELECT customer_id, min(snapshot_date) AS first_snapshot_date FROM clicks GROUP BY 1),"
    + "\nclick_detail AS (SELECT c.*, "
    + ", ".join(
        f"(c.{f} - s.m_{f}) / nullif(s.s_{f}, 0) AS {f}_normalized,"
        f" abs((c.{f} - s.m_{f}) / nullif(s.s_{f}, 0)) > 3 AS {f}_is_outlier"
        for f in FEATURES
    )
    + ", CAST(row_number() OVER (PARTITION BY c.customer_id ORDER BY c.snapshot_date, c.click_id) AS BIGINT) AS row_num_by_customer,"
    + " CAST(month(c.snapshot_date) AS INTEGER) AS month, CAST(quarter(c.snapshot_date) AS INTEGER) AS quarter,"
    + " CAST(year(c.snapshot_date) AS INTEGER) AS year, f.first_snapshot_date,"
    + " CAST((year(c.snapshot_date) - year(f.first_snapshot_date)) * 12 + month(c.snapshot_date)"
    + " - month(f.first_snapshot_date) AS INTEGER) AS months_since_first"
    + " FROM clicks c CROSS JOIN click_stats s JOIN first_seen f ON f.customer_id = c.customer_id),"
    + "\nclick_agg AS (SELECT customer_id, "
    + ", ".join(
        f"avg({f}) AS {f}_mean, max({f}) AS {f}_max, min({f}) AS {f}_min, stddev_samp({f}) AS {f}_stddev,"
        f" CAST(sum(CASE WHEN {f}_is_outlier THEN 1 ELSE 0 END) AS BIGINT) AS {f}_outlier_count"
        for f in FEATURES
    )
    + ", max(snapshot_date) AS latest_snapshot_date, count(*) AS record_count, max(months_since_first) AS max_months,"
    + " min(first_snapshot_date) AS first_snapshot_date FROM click_detail GROUP BY customer_id)"
)

_READINGS = """
readings AS (
  SELECT CAST(user_id // 15 AS INTEGER) AS building_id, CAST(event_id % 4 AS INTEGER) AS meter,
         date_trunc('hour', ts) AS timestamp,
         CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE CAST(value AS DECIMAL(14,2)) END) AS DOUBLE) AS meter_reading
  FROM events GROUP BY 1, 2, 3)"""

_BUILDINGS = (
    "\nbuildings AS (SELECT building_id, building_id % 16 AS site_id, CASE building_id % 16 "
    + " ".join(f"WHEN {i} THEN '{u}'" for i, u in enumerate(USES))
    + " END AS primary_use, CAST(1000 + building_id * 37 AS DOUBLE) AS square_feet,"
    + " CAST(CASE WHEN building_id % 5 <> 0 THEN 1900 + building_id % 120 END AS DOUBLE) AS year_built,"
    + " CAST(CASE WHEN building_id % 3 <> 0 THEN building_id % 20 + 1 END AS DOUBLE) AS floor_count"
    + " FROM (SELECT DISTINCT CAST(user_id // 15 AS INTEGER) AS building_id FROM events))"
)

_WEATHER = """
weather_all AS (
  SELECT CAST((user_id // 15) % 16 AS INTEGER) AS site_id, date_trunc('hour', ts) AS timestamp,
    CAST(sum(v) AS DOUBLE) / count(v) AS air_temperature,
    CAST(max(CASE WHEN event_type <> 'click' THEN v END) AS DOUBLE) AS cloud_coverage,
    CAST(min(v) AS DOUBLE) AS dew_temperature,
    CAST(sum(CASE WHEN event_type = 'view' THEN v END) AS DOUBLE) AS precip_depth_1_hr,
    CAST(sum(CASE WHEN event_type = 'click' THEN v END) AS DOUBLE)
      / nullif(count(CASE WHEN event_type = 'click' THEN v END), 0) AS sea_level_pressure,
    CAST(max(user_id % 360) AS DOUBLE) AS wind_direction,
    CAST(min(CASE WHEN event_type = 'purchase' THEN v END) AS DOUBLE) AS wind_speed
  FROM (SELECT *, CAST(value AS DECIMAL(14,2)) AS v FROM events) GROUP BY 1, 2),
weather AS (
  SELECT site_id, timestamp, air_temperature, cloud_coverage, dew_temperature, precip_depth_1_hr,
         CASE WHEN site_id <> 3 THEN sea_level_pressure END AS sea_level_pressure, wind_direction, wind_speed
  FROM weather_all)"""

_HOUR = "CAST(floor(epoch(timestamp - TIMESTAMP '2024-01-01') / 3600) AS BIGINT)"

_PREDICTIONS = f"""
keyed AS (
  SELECT *, (CAST(building_id AS BIGINT) * 4 + meter) * 100000 + {_HOUR} AS row_id FROM readings),
predictions AS (
  SELECT row_id, building_id, meter, timestamp, meter_reading, meter_reading * 0.9::DOUBLE AS pred0, meter_reading - 5.0::DOUBLE AS pred1,
         sqrt(meter_reading) * 3.0::DOUBLE AS pred2 FROM keyed),
reference AS (
  SELECT building_id, meter, timestamp, CASE WHEN row_id % 10 = 0 THEN NULL WHEN row_id % 7 = 0 THEN -meter_reading
         ELSE meter_reading * 1.05::DOUBLE END AS meter_reading
  FROM keyed WHERE row_id % 3 <> 1)"""

_PARTS = {
    "ledger": (_LEDGER, ()),
    "silver": (_SILVER, ("ledger",)),
    "attributes": (_ATTRIBUTES, ()),
    "silver_attributes": (_SILVER_ATTRIBUTES, ("attributes",)),
    "financials": (_FINANCIALS, ()),
    "silver_financials": (_SILVER_FINANCIALS, ("financials",)),
    "clicks": (_CLICKS, ()),
    "click_detail": (_CLICK_STATS, ("clicks",)),
    "readings": (_READINGS, ()),
    "buildings": (_BUILDINGS, ()),
    "weather": (_WEATHER, ()),
    "predictions": (_PREDICTIONS, ("readings",)),
}


def extend(name: str, text: str, needs: tuple[str, ...]) -> None:
    """Add a named group of common table expressions."""
    _PARTS[name] = (text, needs)


def using(names: str, body: str) -> str:
    """``body`` with the named views (and what they need) in front as common table expressions."""
    done: list[str] = []

    def visit(name: str) -> None:
        text, needs = _PARTS[name]
        for need in needs:
            visit(need)
        if text not in done:
            done.append(text)

    for name in names.split():
        visit(name)
    body = body.strip()
    joiner = ",\n" if body.upper().startswith("WITH ") else "\n"
    return "WITH " + ",".join(done) + joiner + (body[5:] if joiner == ",\n" else body)
