"""Stand-ins for the raw inputs, derived by Spark from the star-schema and event tables.

Every view is a lazy DataFrame over the whole table. Amounts are summed as whole cents (or mills), so
a sum does not depend on the order in which partitions are merged and stays a primitive long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.scans import HOT_ROWS, scan, split_hot

FEATURES = [f"fe_{i}" for i in range(1, 21)]
WEATHER_MEASURES = [
    "air_temperature",
    "cloud_coverage",
    "dew_temperature",
    "precip_depth_1_hr",
    "sea_level_pressure",
    "wind_direction",
    "wind_speed",
]

# Building use classes.
PRIMARY_USES = (
    "Education",
    "Lodging/residential",
    "Office",
    "Entertainment/public assembly",
    "Public services",
    "Other",
    "Retail",
    "Parking",
    "Warehouse/storage",
    "Food sales and service",
    "Religious worship",
    "Utility",
    "Technology/science",
    "Healthcare",
    "Manufacturing/industrial",
    "Services",
)

USERS_PER_BUILDING = 15
LOAN_ORDER = ["snapshot_date", "l_linenumber", "l_partkey", "l_suppkey"]


MILLS = 1000
CENTS = 100


def units(amount: Column | str, per_unit: int) -> Column:
    """A money amount as a whole number of cents or mills."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.round(amount * per_unit).cast("bigint")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per installment before any running value: lineitem columns only."""
    due = units("l_extendedprice", MILLS)
    halves_paid = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("loan_id"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        due.alias("due"),
        F.floor(due * halves_paid / 2).alias("paid"),
    )


def loan_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("loan_start_date"),
        units("o_totalprice", MILLS).alias("loan_amount"),
    )


def number_installments(lines: DataFrame, heads: DataFrame, slice_by: str | None) -> DataFrame:
    """Installment number, amounts and balance of every line of the given loans.

    The heads of sliced loans are one row for each hot loan (see ``split_hot``), few enough for adaptive
    execution to broadcast them, which keeps the rows spread by slice for the scans that follow.
    """
    if slice_by:
        listed = lines.select("loan_id").distinct()
        heads = heads.join(listed, "loan_id", "left_semi")
    running = scan(
        lines,
        ["loan_id"],
        LOAN_ORDER,
        slice_by,
        number="_line",
        sums={"_due_to_date": F.col("due"), "_paid_to_date": F.col("paid")},
    )
    short = F.greatest(F.col("_due_to_date") - F.col("_paid_to_date"), F.lit(0))
    joined = running.join(heads, "loan_id")
    return joined.select(
        "loan_id",
        "customer_id",
        "loan_start_date",
        "snapshot_date",
        F.lit(10).alias("tenure"),
        (F.col("_line") - 1).cast("int").alias("installment_num"),
        (F.col("loan_amount") / MILLS).alias("loan_amt"),
        (F.col("due") / MILLS).alias("due_amt"),
        (F.col("paid") / MILLS).alias("paid_amt"),
        (short / MILLS).alias("overdue_amt"),
        ((F.col("loan_amount") - F.col("_paid_to_date")) / MILLS).alias("balance"),
        *([slice_by] if slice_by else []),
    )


def ledger(spark: SparkSession, sf_dir: str, then=None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The loan ledger; ``then(rows, slice_by)`` adds further scans while hot loans are still sliced."""
    heads = loan_heads(spark, sf_dir)

    def build(lines: DataFrame, slice_by: str | None) -> DataFrame:
        rows = number_installments(lines, heads, slice_by)
        return then(rows, slice_by) if then else rows

    return split_hot(loan_lines(spark, sf_dir), ["loan_id"], LOAN_ORDER, build, hot_rows)


def _every(key: Column, step: int) -> Column:
    return key % step == 0


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer attributes with dirty ages, ids and occupations."""
    key = F.col("c_custkey")
    number = (key % 130 - 5).cast("string")
    age = (
        F.when(_every(key, 19), F.lit(None))
        .when(_every(key, 17), "abc")
        .when(_every(key, 4), F.concat(number, F.lit("_")))
        .otherwise(number)
    )
    area, group, serial = [
        F.lpad((key % m).cast("string"), n, "0") for m, n in ((1000, 3), (100, 2), (10000, 4))
    ]
    ssn = (
        F.when(_every(key, 23), F.lit(None))
        .when(_every(key, 7), F.concat(area, group, serial))
        .otherwise(F.concat_ws("-", area, group, serial))
    )
    occupation = (
        F.when(_every(key, 11), "_______")
        .when(_every(key, 13), F.lit(None))
        .when(_every(key, 29), "")
        .otherwise(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("_mgr ")))
    )
    snapshot = F.date_add(F.lit("2023-01-01").cast("date"), (key % 700).cast("int"))
    return table(spark, sf_dir, "customer").select(
        key.alias("customer_id"),
        F.col("c_name").alias("name"),
        age.alias("age"),
        ssn.alias("ssn"),
        occupation.alias("occupation"),
        snapshot.alias("snapshot_date"),
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer finances with dirty amounts, codes, a history text and a loan list."""
    key = F.col("c_custkey")
    money = F.col("c_acctbal").cast("decimal(14,2)")
    income = (
        F.when(_every(key, 31), F.lit(None))
        .when(_every(key, 37), "1.2.3")
        .when(_every(key, 41), "")
        .otherwise(F.concat(F.lit("$"), (F.abs(money) * 10).cast("string"), F.lit("_")))
    )
    history = F.when(_every(key, 18), "NA").otherwise(
        F.concat(
            (key % 33).cast("string"),
            F.lit(" Years and "),
            (key % 12).cast("string"),
            F.lit(" Months"),
        )
    )
    kinds = F.array(*[F.lit(k) for k in ("Auto Loan", "Payday Loan", "Student Loan", "and Mortgage Loan")])
    picked = F.slice(kinds, (key % 3 + 1).cast("int"), (key % 3 + 1).cast("int"))
    loan_list = F.when(_every(key, 5), F.lit(None)).otherwise(F.concat_ws(", ", picked))
    code = key % 4
    return table(spark, sf_dir, "customer").select(
        key.alias("customer_id"),
        income.alias("annual_income"),
        F.concat(F.abs(money).cast("string"), F.when(_every(key, 3), "_").otherwise("")).alias("outstanding_debt"),
        F.concat(F.lit("__"), F.abs(money).cast("string"), F.lit("__")).alias("amount_invested_monthly"),
        F.concat(money.cast("string"), F.when(_every(key, 6), "_").otherwise("")).alias("changed_credit_limit"),
        F.when(_every(key, 43), "--3").otherwise(money.cast("string")).alias("monthly_balance"),
        F.when(_every(key, 14), "many").otherwise(F.concat((key % 9).cast("string"), F.lit("_"))).alias("num_of_loan"),
        F.when(_every(key, 10), F.lit(None))
        .otherwise(F.concat(F.lit("-"), (key % 25).cast("string")))
        .alias("num_of_delayed_payment"),
        history.alias("credit_history_age"),
        F.when(code == 0, "Yes").when(code == 1, "No").when(code == 2, "NM").otherwise("?").alias(
            "payment_of_min_amount"
        ),
        F.when(code == 0, "_")
        .when(code == 1, "Bad")
        .when(code == 2, "Good")
        .when(_every(key, 15), "other")
        .otherwise("Standard")
        .alias("credit_mix"),
        F.concat_ws(
            "_",
            F.when(_every(key, 2), "High").when(_every(key, 9), "No").otherwise("Low"),
            F.lit("spent"),
            F.when(key % 5 == 1, "Large").when(key % 5 == 2, "Medium").when(key % 5 == 3, "Small").otherwise("Any"),
            F.lit("value_payments"),
        ).alias("payment_behaviour"),
        loan_list.alias("type_of_loan"),
        (F.abs(money) / 12).cast("double").alias("monthly_inhand_salary"),
        (key % 11).cast("int").alias("num_bank_accounts"),
        (key % 7).cast("int").alias("num_credit_card"),
        (key % 34).cast("int").alias("interest_rate"),
        (key % 62).cast("int").alias("delay_from_due_date"),
        (key % 17).cast("int").alias("num_credit_inquiries"),
        ((key % 500) / 10).cast("double").alias("credit_utilization_ratio"),
        (F.abs(money) / 24).cast("double").alias("total_emi_per_month"),
        F.lit(None).cast("date").alias("snapshot_date"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide behaviour rows; ``click_id`` makes the row order total."""
    wide = [F.col("embedding")[i].cast("double").alias(name) for i, name in enumerate(FEATURES)]
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("click_id"),
        (F.col("vec_id") % 50).alias("customer_id"),
        F.add_months(F.lit("2023-01-01").cast("date"), F.col("label")).alias("snapshot_date"),
        *wide,
    )


def _building() -> Column:
    return F.floor(F.col("user_id") / USERS_PER_BUILDING).cast("int")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly meter rows, unique per (building, meter, hour): partial sums are merged before the shuffle.

    A (building, meter) series is therefore bounded by the hours of the calendar (8,784 a year),
    whatever the event rate of one building.
    """
    amount = F.when(F.col("event_type") == "error", 0).otherwise(units("value", CENTS))
    return (
        table(spark, sf_dir, "events")
        .select(
            _building().alias("building_id"),
            (F.col("event_id") % 4).cast("int").alias("meter"),
            F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp"),
            amount.alias("amount"),
        )
        .groupBy("building_id", "meter", "timestamp")
        .agg((F.sum("amount") / CENTS).alias("meter_reading"))
    )


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per building; at most ``users / 15`` rows."""
    bid = F.col("building_id")
    uses = F.array(*[F.lit(x) for x in PRIMARY_USES])
    return (
        table(spark, sf_dir, "events")
        .select(_building().alias("building_id"))
        .distinct()
        .select(
            "building_id",
            (bid % 16).alias("site_id"),
            F.get(uses, bid % 16).alias("primary_use"),
            (F.lit(1000.0) + bid * 37).alias("square_feet"),
            F.when(bid % 5 != 0, (F.lit(1900) + bid % 120)).cast("double").alias("year_built"),
            F.when(bid % 3 != 0, bid % 20 + 1).cast("double").alias("floor_count"),
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly site rows with natural gaps, unique per (site, hour); site 3 never reports a pressure."""
    value = units("value", CENTS)

    def only(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, value)

    def mean(c: Column) -> Column:
        return F.try_divide(F.sum(c) / CENTS, F.count(c))

    site = (_building() % 16).alias("site_id")
    hourly = (
        table(spark, sf_dir, "events")
        .select(site, F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("timestamp"), "event_type", "value", "user_id")
        .groupBy("site_id", "timestamp")
        .agg(
            mean(value).alias("air_temperature"),
            (F.max(F.when(F.col("event_type") != "click", value)) / CENTS).alias("cloud_coverage"),
            (F.min(value) / CENTS).alias("dew_temperature"),
            (F.sum(only("view")) / CENTS).alias("precip_depth_1_hr"),
            mean(only("click")).alias("sea_level_pressure"),
            F.max(F.col("user_id") % 360).cast("double").alias("wind_direction"),
            (F.min(only("purchase")) / CENTS).alias("wind_speed"),
        )
    )
    return hourly.withColumn(
        "sea_level_pressure", F.when(F.col("site_id") != 3, F.col("sea_level_pressure"))
    )


def hour_of(ts: Column) -> Column:
    return F.floor(F.timestamp_diff("SECOND", F.lit("2024-01-01").cast("timestamp_ntz"), ts) / 3600).cast("bigint")


def row_ids(df: DataFrame) -> DataFrame:
    """A row id computed from the key, so it is the same on every run."""
    series = F.col("building_id").cast("bigint") * 4 + F.col("meter")
    return df.withColumn("row_id", series * 100000 + hour_of(F.col("timestamp")))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three prediction columns per reading; ``pred1`` goes negative."""
    y = F.col("meter_reading")
    return row_ids(readings(spark, sf_dir)).select(
        "row_id",
        "building_id",
        "meter",
        "timestamp",
        "meter_reading",
        (y * 0.9).alias("pred0"),
        (y - 5.0).alias("pred1"),
        (F.sqrt(y) * 3.0).alias("pred2"),
    )


def reference_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published readings for part of the hours, with NULLs and negatives."""
    row = F.col("row_id")
    y = F.col("meter_reading")
    return (
        row_ids(readings(spark, sf_dir))
        .where(row % 3 != 1)
        .select(
            "building_id",
            "meter",
            "timestamp",
            F.when(row % 10 == 0, F.lit(None)).when(row % 7 == 0, -y).otherwise(y * 1.05).alias("meter_reading"),
        )
    )
