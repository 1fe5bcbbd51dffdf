"""Blending of prediction sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.hours import generalized_mean, zero_below
from ledgerline.operators.metrics import rmse
from ledgerline.operators.tables import attach_checked, override_with_reference

# Final blend - power, inner and outer factor, and the weight of each of the sixteen sets.
FINAL_POWER = 0.11375872112626925
FINAL_INNER = 0.99817730007820798
FINAL_OUTER = 0.99576627605010293
FINAL_WEIGHTS = (
    0.01782498, 0.03520153, 0.03286305, 0.00718961,
    0.01797213, 0.0004982, 0.14172883, 0.12587602,
    0.08538773, 0.09482115, 0.09476288, 0.10101228,
    0.15306998, 0.03358389, 0.00719679, 0.05101097,
)


@dataclass(frozen=True)
class Candidate:
    p: float
    c: float
    weights: tuple[float, ...]


def assemble_predictions(sets: Mapping[str, DataFrame], key: str = "row_id", value: str = "meter_reading") -> DataFrame:
    """One column per set, negatives as 0; a row missing from a set is NULL there.

    The sets are stacked and dealt out by key before they are grouped: one shuffle of narrow rows for any number of sets,
    none if they are all dealt out by key already. Grouping before the shuffle as well would hold a row of all columns for
    every key of a task and merge nothing, since a set has a key once.
    """
    tagged = [df.select(key, F.lit(i).alias("_set"), zero_below(F.col(value)).alias("_value")) for i, df in enumerate(sets.values())]
    stacked = reduce(DataFrame.unionByName, tagged).repartition(key)
    return stacked.groupBy(key).agg(*[F.max(F.when(F.col("_set") == i, F.col("_value"))).alias(name) for i, name in enumerate(sets)])


def mean_blend(columns: Sequence[str]) -> Column:
    return sum((F.col(c) for c in columns[1:]), F.col(columns[0])) / len(columns)


def final_blend(columns: Sequence[str], weights: Sequence[float] = FINAL_WEIGHTS) -> Column:
    """Power mean of the ``log1p`` predictions, brought back by ``expm1``, clipped at 0.

    The published weights already add up to 1 within rounding and are used as they are.
    """
    if len(columns) != len(weights):
        raise ValueError("one weight per prediction column")
    logs = [F.log1p(F.col(c)) for c in columns]
    mixed = generalized_mean(logs, weights, FINAL_POWER, FINAL_INNER, normalize=False)
    return zero_below(F.expm1(mixed) * FINAL_OUTER)


def finish(predictions: DataFrame, reference: DataFrame) -> DataFrame:
    """Reference values win over blended ones."""
    return override_with_reference(predictions, reference)


def _scores(columns: Sequence[str], actual: str, candidates: Sequence[Candidate]) -> list[Column]:
    inputs = [F.col(c) for c in columns]
    return [
        rmse(F.col(actual), generalized_mean(inputs, k.weights, k.p, k.c)).alias(f"s{i}") for i, k in enumerate(candidates)
    ]


def search_blend(df: DataFrame, columns: Sequence[str], actual: str, candidates: Sequence[Candidate], by: Sequence[str] = ()) -> DataFrame:
    """Least-RMSE candidate (per group): every candidate is one aggregate of the same pass, rows are not multiplied."""
    scored = df.groupBy(*by).agg(*_scores(columns, actual, candidates))
    cells = [
        F.struct(
            F.col(f"s{i}").alias("rmse"),
            F.lit(i).alias("candidate"),
            F.lit(k.p).alias("p"),
            F.lit(k.c).alias("c"),
            F.array(*[F.lit(float(w)) for w in k.weights]).alias("weights"),
        )
        for i, k in enumerate(candidates)
    ]
    best = F.array_min(F.array(*cells)).alias("best")
    return scored.select(*by, best).select(*by, "best.*")


def blend_per_segment(df: DataFrame, columns: Sequence[str], actual: str, candidates: Sequence[Candidate], segment: str, out: str = "blend") -> DataFrame:
    """Fit the best candidate of every segment on scored rows and apply it to all rows."""
    best = search_blend(df.where(F.col(actual).isNotNull()), columns, actual, candidates, [segment])
    chosen = attach_checked(df, best.select(segment, F.col("candidate").alias("_candidate")), [segment])
    inputs = [F.col(c) for c in columns]
    blended = F.coalesce(
        *[
            F.when(F.col("_candidate") == i, generalized_mean(inputs, k.weights, k.p, k.c))
            for i, k in enumerate(candidates)
        ]
    )
    return chosen.withColumn(out, blended).drop("_candidate")


def simplex_candidates(sets: int, steps: int, powers: Sequence[float], factors: Sequence[float]) -> list[Candidate]:
    """All weight mixes in ``1 / steps`` steps, with every power and factor.

    The power mean of a single set does not depend on the power, so such a mix is listed once per factor.
    """

    def mixes(parts: int, left: int):
        if parts == 1:
            yield (left,)
            return
        for first in range(left + 1):
            for rest in mixes(parts - 1, left - first):
                yield (first, *rest)

    weights = [tuple(x / steps for x in mix) for mix in mixes(sets, steps)]
    return [
        Candidate(p, c, w) for p in powers for c in factors for w in weights if p == powers[0] or max(w) < 1
    ]
