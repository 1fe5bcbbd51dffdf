"""Top-k, seeded picks and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int, tie: Sequence[str]) -> DataFrame:
    """``tie`` makes the order total, so the same rows come back on every run."""
    return df.orderBy(*order, *tie).limit(k)


def _shuffled(key: Sequence[str], seed: int) -> Column:
    return F.xxhash64(*[F.col(c) for c in key], F.lit(seed))


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows in the order of a seeded key hash (all rows when there are fewer)."""
    return df.orderBy(_shuffled(key, seed), *key).limit(n)


def pick_one(df: DataFrame, key: Sequence[str], seed: int = 0) -> DataFrame:
    return sample_n(df, 1, key, seed)


def ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.orderBy(*columns)
