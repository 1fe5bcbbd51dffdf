"""Segment regressors and the label classifier, fitted by Spark."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import boosting
from ledgerline.operators.ranking import auc_of_counts
from ledgerline.operators.tables import attach_checked
from ledgerline.session import pin


def fit_lines(df: DataFrame, segment: Sequence[str], feature: str, target: str) -> DataFrame:
    """Least-squares line of every segment, one grouped pass."""
    both = F.col(feature).isNotNull() & F.col(target).isNotNull()
    return df.where(both).groupBy(*segment).agg(
        F.regr_slope(target, feature).alias("slope"),
        F.regr_intercept(target, feature).alias("intercept"),
        F.count(F.lit(1)).alias("fitted_rows"),
    )


def predict_lines(df: DataFrame, lines: DataFrame, segment: Sequence[str], feature: str, out: str = "prediction") -> DataFrame:
    """Route every row to the line of its segment; NULL for an unseen segment."""
    joined = attach_checked(df, lines, segment)
    return joined.withColumn(out, F.col("slope") * F.col(feature) + F.col("intercept")).drop("slope", "intercept", "fitted_rows")


def out_of_fold_lines(df: DataFrame, segment: str, fold: Column, feature: str, target: str) -> DataFrame:
    """Predict each fold with the line fitted on the other folds of its segment.

    The line without a fold follows from the segment's sums less those of the fold, so one grouped pass
    serves all folds.
    """
    x, y = F.col(feature), F.col(target)
    rows = df.withColumn("fold", fold)
    usable = rows.where(x.isNotNull() & y.isNotNull())
    sums = {"n": F.count(F.lit(1)), "x": F.sum(x), "y": F.sum(y), "xx": F.sum(x * x), "xy": F.sum(x * y)}
    by_fold = usable.groupBy(segment, "fold").agg(*[c.alias(f"f_{k}") for k, c in sums.items()])
    totals = by_fold.groupBy(segment).agg(*[F.sum(f"f_{k}").alias(f"t_{k}") for k in sums])
    rest = by_fold.join(totals, segment).select(segment, "fold", *[(F.col(f"t_{k}") - F.col(f"f_{k}")).alias(k) for k in sums])
    slope = F.try_divide(F.col("n") * F.col("xy") - F.col("x") * F.col("y"), F.col("n") * F.col("xx") - F.col("x") * F.col("x"))
    lines = rest.withColumn("slope", slope).withColumn("intercept", F.try_divide(F.col("y") - F.col("slope") * F.col("x"), F.col("n")))
    joined = attach_checked(rows, lines.select(segment, "fold", "slope", "intercept"), [segment, "fold"])
    return joined.withColumn("prediction", F.col("slope") * x + F.col("intercept")).drop("slope", "intercept")


@dataclass(frozen=True)
class SegmentModels:
    """Boosted trees of the listed segment values."""

    segment: str
    values: tuple
    features: tuple[str, ...]
    edges: list
    fits: list[boosting.Fit]

    def __contains__(self, value: object) -> bool:
        """Whether the value has a model: rows with a target."""
        return any(f.trees and self.values[f.segment] == value for f in self.fits)


def fit_by_segment(
    df: DataFrame, segment: str, values: Sequence, features: Sequence[str], target: str, folds: Sequence[int] | None = None, fold: str = "fold", seed: int = 7, bins: int = boosting.BINS, **setting
) -> SegmentModels:
    """Boosted-tree regressors of all listed segment values, grown together; with ``folds``, one that leaves out each.

    ``setting`` are fields of ``boosting.Setting``. The number of jobs is trees x depth, whatever the number of
    segments and folds.
    """
    chosen = boosting.Setting(**setting)
    edges = boosting.edges_of(df, features, bins)
    number = boosting.segment_number(F.col(segment), values)
    held = F.col(fold) if folds is not None else F.lit(-1)
    usable = df.where(F.col(fold).isNotNull()) if folds is not None else df
    rows = boosting.binned(usable, features, edges, F.col(target), number, held, F.xxhash64(segment, target, *features))
    fits = [boosting.Fit(k, f, chosen) for k in range(len(values)) for f in (folds if folds is not None else [None])]
    boosting.set_bases(rows, fits)
    boosting.boost(rows, [f for f in fits if not math.isnan(f.base)], len(features), seed=seed, bins=bins)
    return SegmentModels(segment, tuple(values), tuple(features), edges, fits)


def predict_by_segment(df: DataFrame, models: SegmentModels) -> DataFrame:
    """Every row with the prediction of its segment's model; NULL where the segment is NULL or has none."""
    number = boosting.segment_number(F.col(models.segment), models.values)
    return boosting.predicted(df, models.features, models.edges, models.fits, number)


def out_of_fold_by_segment(
    df: DataFrame, segment: str, values: Sequence, folds: Sequence[int], features: Sequence[str], target: str, fold: str = "fold", **options
) -> DataFrame:
    """Every row predicted by the model of its segment that was fitted on the other folds; NULL without such a model."""
    models = fit_by_segment(df, segment, values, features, target, folds, fold, **options)
    number = boosting.segment_number(F.col(segment), values)
    return boosting.predicted(df, features, models.edges, models.fits, number, F.col(fold))


# What the classifier search draws its settings from.
SPACE = {
    "trees": (25, 50),
    "depth": (2, 3),
    "rate": (0.01, 0.1),
    "subsample": (0.6, 0.8),
    "colsample": (0.6, 0.8),
    "gamma": (0.0, 0.1),
    "min_child": (1.0, 3.0, 5.0),
    "alpha": (0.0, 0.1, 1.0),
    "reg": (1.0, 1.5, 2.0),
}
DRAWS, RUNGS, KEEP = 100, (6, 12, 25), 3


def draw_settings(space: Mapping[str, Sequence] = SPACE, draws: int = DRAWS, seed: int = 42) -> list[boosting.Setting]:
    """Different settings drawn at random from the combinations of the space (all of them, if fewer)."""
    sizes = [len(v) for v in space.values()]
    total = math.prod(sizes)
    out = []
    for number in random.Random(seed).sample(range(total), min(draws, total)):
        chosen = {}
        for (name, choices), size in zip(space.items(), sizes, strict=True):
            number, k = divmod(number, size)
            chosen[name] = choices[k]
        out.append(boosting.Setting(**chosen))
    return out


@dataclass(frozen=True)
class Search:
    """A finished search: the settings, the chosen one, and for every rung the scores and AUCs of its candidates.

    ``scores`` has (rung, candidate, fold, score, pos, neg), equal scores merged; ``ranked`` (rung, candidate, auc) holds
    mean AUCs over the folds that were left out.
    """

    settings: list[boosting.Setting]
    chosen: int
    scores: DataFrame
    ranked: list[tuple[int, int, float]]


def scored_candidates(rows: DataFrame, fits: Mapping[int, Sequence[boosting.Fit]], rung: int) -> DataFrame:
    """Scores of all rows by every candidate's fit that left out the row's fold, equal scores of a task merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, fold, _, target, bins = boosting.rows_in(batch)
            for candidate, own in fits.items():
                for fit in own:
                    at = np.flatnonzero(fold == fit.held)
                    if not len(at):
                        continue
                    score, place = np.unique(fit.margin(bins[at]), return_inverse=True)
                    pos = np.bincount(place, target[at] == 1, len(score)).astype(np.int64)
                    n = np.bincount(place, minlength=len(score))
                    same = [pa.array(np.full(len(score), x), pa.int32()) for x in (rung, candidate, fit.held)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(score), pa.array(pos), pa.array(n - pos)], names=["rung", "candidate", "fold", "score", "pos", "neg"])

    parts = rows.mapInArrow(run, "rung int, candidate int, fold int, score double, pos bigint, neg bigint")
    return parts.groupBy("rung", "candidate", "fold", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def search_settings(rows: DataFrame, width: int, folds: int, settings: Sequence[boosting.Setting], rungs: Sequence[int] = RUNGS, keep: int = KEEP, seed: int = 42) -> Search:
    """Successive halving over binned rows: all candidates grow a few trees, the best third by AUC goes on.

    A rung's candidates and folds grow together and are scored in one job. The last rung lets the rest grow to their own
    number of trees.
    """
    fits = {k: [boosting.Fit(0, f, s) for f in range(folds)] for k, s in enumerate(settings)}
    ranked: list[tuple[int, int, float]] = []
    kept: list[DataFrame] = []
    most = max(s.trees for s in settings)
    stops = [*(r for r in rungs if r < most), most]
    for rung, stop in enumerate(stops):
        boosting.boost(rows, [f for own in fits.values() for f in own], width, logistic=True, seed=seed, upto=stop)
        kept.append(pin(scored_candidates(rows, fits, rung), "scores"))
        aucs = auc_of_counts(kept[-1], ["candidate", "fold"]).groupBy("candidate").agg(F.avg("auc").alias("auc")).collect()
        mean = {r["candidate"]: 0.5 if r["auc"] is None else r["auc"] for r in aucs}
        order = sorted(fits, key=lambda k: (-mean.get(k, 0.5), k))
        ranked += [(rung, k, mean.get(k, 0.5)) for k in order]
        if stop != most:
            fits = {k: fits[k] for k in order[: max(1, -(-len(order) // keep))]}
    return Search(list(settings), order[0], reduce(DataFrame.unionByName, kept), ranked)


def prepare_labels(train: DataFrame, features: Sequence[str], label: str, folds: int) -> tuple[DataFrame, list]:
    """Binned training rows, dealt into folds by a hash of what they hold, and the edges of the bins."""
    edges = boosting.edges_of(train, features)
    place = F.xxhash64(label, *features)
    return boosting.binned(train, features, edges, F.col(label), F.lit(0), F.pmod(place, F.lit(folds)), place), edges


def classify(
    train: DataFrame,
    others: DataFrame,
    features: Sequence[str],
    label: str = "label",
    folds: int = 3,
    seed: int = 42,
    space: Mapping[str, Sequence] = SPACE,
    draws: int = DRAWS,
    rungs: Sequence[int] = RUNGS,
) -> DataFrame:
    """Boosted-tree classifier with a setting searched by cross-validated AUC; adds ``score`` to every row of ``others``."""
    rows, edges = prepare_labels(train, features, label, folds)
    found = search_settings(rows, len(features), folds, draw_settings(space, draws, seed), rungs, seed=seed)
    final = boosting.Fit(0, None, found.settings[found.chosen])
    boosting.boost(rows, [final], len(features), logistic=True, seed=seed)
    return boosting.predicted(others, features, edges, [final], F.lit(0), out="score", logistic=True)
