"""Rounding that keeps two engines comparable."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A mean of cents over 16 rows ends in ...5 at the sixth decimal, and engines break such ties differently.
# Five-digit columns are moved off the tie by this amount on both sides before rounding.
TIE = 1.3e-7


def rounded(df: DataFrame, digits: int = 4, only: Iterable[str] | None = None) -> DataFrame:
    """Round double columns (all, or the listed ones) and turn -0.0 into 0.0."""
    names = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    if only is not None:
        names &= set(only)
    shift = F.lit(TIE if digits == 5 else 0.0)
    return df.select(
        *[(F.round(F.col(c).cast("double") + shift, digits) + F.lit(0.0)).alias(c) if c in names else F.col(c) for c in df.columns]
    )


def rnd(*columns: str, digits: int = 4) -> str:
    """``SELECT * REPLACE`` list of the rounded columns."""
    return ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in columns)


def each(template: str, names: Iterable[str]) -> str:
    return ", ".join(template.format(c=n) for n in names)
