"""Row formulas on loan installments and on customer summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status names, in order of severity.
STATUS_INITIATED = "LOAN_INITIATED"
STATUS_ON_TIME = "PAID_ON_TIME"
STATUS_MISSED = "MISSED_PAYMENT"
STATUS_OVERDUE = "OVERDUE"
STATUS_SEVERE = "SEVERELY_OVERDUE"
STATUS_UNKNOWN = "UNKNOWN"
SEVERE_MULTIPLE = 3
DAYS_PER_MONTH = 30

# Score card. A band list is (limit, points), first match wins; the last number is the rest.
SCORE_BASE_DEFAULTED = 50
SCORE_PER_DEFAULT = 5
SCORE_PER_MISSED = 1.5
DEBT_SHARE_BANDS = ((50, 10), (30, 6), (10, 3))
CREDIT_MIX_POINTS = {"BAD": 10, "STANDARD": 5, "GOOD": 0}
CREDIT_MIX_OTHER = 5
HISTORY_MONTH_BANDS = ((120, 5), (240, 3))
HIGH_SPENT_POINTS = 3
LARGE_VALUE_POINTS = 2
INCOME_BANDS = ((50_000, 5), (100_000, 3))
LOAN_COUNT_BANDS = ((3, 5), (1, 3))
OVERDUE_BANDS = ((5_000, 5), (1_000, 3), (0, 1))
SCORE_RANGE = (0, 120)


def payment_made_flag(paid: Column, due: Column) -> Column:
    return F.coalesce((paid >= due).cast("int"), F.lit(0))


def overdue_flag(installment: Column, paid: Column, due: Column) -> Column:
    """1 when a regular installment (number above 0) is short."""
    return F.coalesce(((installment > 0) & (paid < due)).cast("int"), F.lit(0))


def payment_ratio(paid: Column, due: Column) -> Column:
    return F.when(due > 0, F.try_divide(paid, due)).otherwise(1.0)


def payment_status(installment: Column, flag: Column, overdue: Column, due: Column) -> Column:
    return (
        F.when(installment == 0, STATUS_INITIATED)
        .when(flag == 0, STATUS_ON_TIME)
        .when(overdue <= due, STATUS_MISSED)
        .when(overdue <= due * SEVERE_MULTIPLE, STATUS_OVERDUE)
        .when(flag == 1, STATUS_SEVERE)
        .otherwise(STATUS_UNKNOWN)
    )


def expected_end(start: Column, tenure: Column) -> Column:
    return F.date_add(start, (tenure * DAYS_PER_MONTH).cast("int"))


def loan_dates(start: Column, snapshot: Column, tenure: Column, installment: Column) -> dict[str, Column]:
    end = expected_end(start, tenure)
    return {
        "loan_age_months": F.datediff(snapshot, start) / DAYS_PER_MONTH,
        "remaining_tenure": tenure - installment,
        "expected_end_date": end,
        "is_active_loan": (installment < tenure) & (snapshot <= end),
    }


def percent_paid(total_paid: Column, total_due: Column) -> Column:
    return F.when(total_due > 0, F.try_divide(total_paid, total_due) * 100).otherwise(0.0)


def installments_missed(overdue: Column, due: Column) -> Column:
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(0)


def bands_above(value: Column, bands: Sequence[tuple[float, int]]) -> Column:
    """Points of the first limit the value exceeds, else 0; NULL gets 0."""
    return F.coalesce(*[F.when(value > limit, points) for limit, points in bands], F.lit(0))


def bands_below(value: Column, bands: Sequence[tuple[float, int]]) -> Column:
    return F.coalesce(*[F.when(value < limit, points) for limit, points in bands], F.lit(0))


def risk_score(
    *,
    defaults: Column,
    max_missed: Column,
    debt: Column,
    income: Column,
    credit_mix: Column,
    history_months: Column,
    spent_level: Column,
    value_level: Column,
    loans: Column,
    max_overdue: Column,
) -> Column:
    """Additive score. NULL when the customer has no loan summary, because two terms are then NULL."""
    mix_points = F.coalesce(
        *[F.when(credit_mix == name, points) for name, points in CREDIT_MIX_POINTS.items()], F.lit(CREDIT_MIX_OTHER)
    )
    points = [
        F.when(defaults > 0, SCORE_BASE_DEFAULTED).otherwise(0),
        (defaults * SCORE_PER_DEFAULT).cast("int"),
        (max_missed * SCORE_PER_MISSED).cast("int"),
        bands_above(F.try_divide(debt, income) * 100, DEBT_SHARE_BANDS),
        mix_points,
        bands_below(history_months, HISTORY_MONTH_BANDS),
        F.when(spent_level == "HIGH", HIGH_SPENT_POINTS).otherwise(0),
        F.when(value_level == "LARGE", LARGE_VALUE_POINTS).otherwise(0),
        bands_below(income, INCOME_BANDS),
        bands_above(loans, LOAN_COUNT_BANDS),
        bands_above(max_overdue, OVERDUE_BANDS),
    ]
    total = points[0]
    for term in points[1:]:
        total = total + term
    return total.cast("int")


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL, unlike ``least``/``greatest`` which skip it."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def left_closed_bands(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` below ``edges[i]``; everything else, NULL included, gets the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    named = zip(edges, labels, strict=False)
    return F.coalesce(*[F.when(value < edge, label) for edge, label in named], F.lit(labels[-1]))


def right_closed_cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for ``edges[i] < value <= edges[i+1]``; NULL outside."""
    spans = zip(edges[:-1], edges[1:], labels, strict=True)
    return F.coalesce(*[F.when((value > low) & (value <= high), label) for low, high, label in spans])
