"""Joins of a large table with a derived small one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_checked(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a derived table, lazily.

    The planner broadcasts it only if its own estimate, or the size that adaptive execution has measured, is below
    the session's limit; otherwise the join is shuffled and skewed keys of the large side are split.
    """
    return df.join(small, list(keys), how)


def combine_readings(readings: DataFrame, buildings: DataFrame, weather: DataFrame, hour: str = "timestamp") -> DataFrame:
    """Readings with their building, then with the weather of its site and hour."""
    return attach_checked(readings, buildings, ["building_id"]).join(weather, ["site_id", hour], "left")


def attach_reference(reference: DataFrame, predictions: DataFrame, buildings: DataFrame) -> DataFrame:
    """Reference readings with the prediction of the same meter and hour, and the site."""
    joined = reference.join(predictions, ["building_id", "meter", "timestamp"], "left")
    return attach_checked(joined, buildings.select("building_id", "site_id"), ["building_id"])


def override_with_reference(predictions: DataFrame, reference: DataFrame, value: str = "meter_reading") -> DataFrame:
    """Replace a prediction by the reference value of its ``row_id`` where there is one."""
    known = reference.where(F.col(value).isNotNull()).select("row_id", F.col(value).alias("_known"))
    joined = predictions.join(known, "row_id", "left")
    return joined.withColumn(value, F.coalesce("_known", value)).drop("_known")


def date_window(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Rows whose day lies in the window, both ends included; NULL days are out.

    The bounds are literals of the column's own type, so a partition column prunes folders and any other column is
    compared while the file is read.
    """
    kind = df.schema[column].dataType.simpleString()
    if kind == "date":
        return df.where(F.col(column).between(F.lit(first), F.lit(last)))
    return df.where((F.col(column) >= F.lit(first).cast(kind)) & (F.col(column) < F.lit(last + timedelta(days=1)).cast(kind)))


def map_counts(df: DataFrame, fitted: DataFrame, column: str, out: str) -> DataFrame:
    """How often the value occurs in ``fitted``; NULL for a value not seen there."""
    counts = fitted.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return attach_checked(df, counts, [column])


def narrow_type(low: Column, high: Column, whole: Column) -> Column:
    """Smallest type whose open range holds the values; fractions are float when they fit one."""
    integer = F.when((low > -(2**7)) & (high < 2**7 - 1), "tinyint")
    integer = integer.when((low > -(2**15)) & (high < 2**15 - 1), "smallint")
    integer = integer.when((low > -(2**31)) & (high < 2**31 - 1), "int").otherwise("bigint")
    fits_float = (low > -3.4028234663852886e38) & (high < 3.4028234663852886e38)
    return F.when(whole, integer).otherwise(F.when(fits_float, "float").otherwise("double"))


def profile_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, max, integrality, NULLs and narrowest type of every numeric column, from one pass, long form."""
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        aggregates += [
            F.struct(
                F.min(value).alias("low"),
                F.max(value).alias("high"),
                F.coalesce(F.bool_and(value == F.floor(value)), F.lit(False)).alias("whole"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
            ).alias(c)
        ]
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(c)[part].alias(part) for part in ("low", "high", "whole", "nulls")],
            narrow_type(F.col(c)["low"], F.col(c)["high"], F.col(c)["whole"]).alias("type"),
        )
        for c in columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*cells)))


def narrow(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast each column to its narrowest type; reads the one-row-per-column profile to fix the schema."""
    types = {row["column"]: row["type"] for row in profile_types(df, columns).collect()}
    return df.select(*[F.col(c).cast(types[c]) if c in types else F.col(c) for c in df.columns])
