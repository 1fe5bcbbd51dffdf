"""Installment-ledger operators. Every ordered one takes ``slice_by`` so a hot loan can be cut into slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import lending as fx
from ledgerline.operators.scans import scan

# Columns that order rows of one installment number, so that every scan has one order only.
TIES = ("snapshot_date", "due_amt", "paid_amt", "overdue_amt", "balance", "customer_id")


def by_installment(df: DataFrame) -> list[str]:
    """Installment number, then whichever tie columns the table has."""
    return ["installment_num", *(c for c in TIES if c in df.columns)]


def payment_flags(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "payment_made_flag": fx.payment_made_flag(c("paid_amt"), c("due_amt")),
            "monthly_overdue_flag": fx.overdue_flag(c("installment_num"), c("paid_amt"), c("due_amt")),
            "payment_ratio": fx.payment_ratio(c("paid_amt"), c("due_amt")),
        }
    )


def payment_status(df: DataFrame) -> DataFrame:
    c = F.col
    status = fx.payment_status(c("installment_num"), c("monthly_overdue_flag"), c("overdue_amt"), c("due_amt"))
    return df.withColumn("payment_status", status)


def loan_dates(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns(fx.loan_dates(c("loan_start_date"), c("snapshot_date"), c("tenure"), c("installment_num")))


def running_total(df: DataFrame, slice_by: str | None = None) -> DataFrame:
    """Cumulative paid amount of each loan by installment."""
    return scan(df, ["loan_id"], by_installment(df), slice_by, sums={"total_paid_amount": F.col("paid_amt")})


def percent_paid(df: DataFrame) -> DataFrame:
    """Needs ``total_paid_amount``."""
    due = F.col("installment_num") * F.col("due_amt")
    return df.withColumns(
        {"total_due_amount": due, "percent_paid": fx.percent_paid(F.col("total_paid_amount"), due)}
    )


def consecutive_missed(df: DataFrame, mode: str = "reset", slice_by: str | None = None) -> DataFrame:
    """Missed installments in a row, from ``monthly_overdue_flag``.

    ``reset`` starts again at 0 after a paid installment. ``legacy`` is the running number of misses
    minus the running sum, over paid installments above 0, of the misses before each of them; it goes
    below zero after two paid installments in a row.
    """
    missed = F.col("monthly_overdue_flag") == 1
    if mode == "reset":
        return scan(df, ["loan_id"], by_installment(df), slice_by, runs={"consecutive_missed_payments": missed})
    if mode != "legacy":
        raise ValueError(f"unknown mode {mode!r}")
    counted = scan(df, ["loan_id"], by_installment(df), slice_by, sums={"_misses": F.col("monthly_overdue_flag")})
    taken_off = F.when(~missed & (F.col("installment_num") > 0), F.col("_misses")).otherwise(0)
    summed = scan(counted, ["loan_id"], by_installment(df), slice_by, sums={"_taken_off": taken_off})
    return summed.withColumn(
        "consecutive_missed_payments", (F.col("_misses") - F.col("_taken_off")).cast("bigint")
    ).drop("_misses", "_taken_off")


def is_default(df: DataFrame, limit: int = 3) -> DataFrame:
    return df.withColumn("is_default", F.col("consecutive_missed_payments") >= limit)


def previous_status(df: DataFrame, slice_by: str | None = None) -> DataFrame:
    """Payment flag of the installment before."""
    return scan(df, ["loan_id"], by_installment(df), slice_by, lags={"previous_made_flag": F.col("payment_made_flag")})


def days_past_due(df: DataFrame) -> DataFrame:
    """Month on book, missed installments, first missed date and days past due."""
    missed = fx.installments_missed(F.col("overdue_amt"), F.col("due_amt"))
    dated = df.withColumns({"mob": F.col("installment_num").cast("int"), "installments_missed": missed})
    dated = dated.withColumn(
        "first_missed_date", fx.first_missed_date(F.col("snapshot_date"), F.col("installments_missed"))
    )
    dpd = fx.days_past_due(F.col("overdue_amt"), F.col("snapshot_date"), F.col("first_missed_date"))
    return dated.withColumn("dpd", dpd.cast("int"))


def dpd_label(df: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """One label row per loan that reached ``mob``."""
    return df.where(F.col("mob") == mob).select(
        "loan_id",
        "customer_id",
        F.coalesce((F.col("dpd") >= dpd).cast("int"), F.lit(0)).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def silver_ledger(df: DataFrame, slice_by: str | None = None, mode: str = "reset") -> DataFrame:
    """All derived ledger columns in one pass per loan; the running values share one window sort."""
    flagged = payment_flags(df)
    if mode == "reset":
        scanned = scan(
            flagged,
            ["loan_id"],
            by_installment(flagged),
            slice_by,
            sums={"total_paid_amount": F.col("paid_amt")},
            runs={"consecutive_missed_payments": F.col("monthly_overdue_flag") == 1},
        )
    else:
        scanned = consecutive_missed(running_total(flagged, slice_by), mode, slice_by)
    return is_default(percent_paid(loan_dates(payment_status(scanned))))
