"""Toxicity scores from confirmed toxic examples and unlabelled text, by non-negative positive-unlabelled learning.

Positives are documents marked toxic. Everything else that may be learned from is unlabelled: a mixture that holds
toxic documents in the share of the class prior. The classifier minimises the prior-corrected risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss; where the second part would turn negative, the step goes the other way, which keeps a flexible
model from calling all unlabelled text clean. Features are the presence and the density of words and word beginnings
that positives use more often than chance allows, chosen by a Poisson test from the same rows.

The fit sees a bounded sample (``Limits``: rows, characters of a text, and characters in all); scoring sees every row and
the whole text, however long. Null and empty texts have no words and get the score of the bias. Rows that repeat a
doc_id are scored alike if their texts are. Labels that are null, doubled or belong to no document change nothing; without
any positive the score is the prior everywhere. An empty table gives an empty result. Further columns are kept; one that
has the name of the score column is replaced by it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_sample, free_name, held_out, partitions_for, texts_of
from ledgerline.session import pin

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Limits:
    """Bounds of the training sample: rows of either kind, characters of a sampled text and of all of a kind, features."""

    positives: int = 4_000
    unlabelled: int = 12_000
    characters: int = 20_000
    in_all: int = 40_000_000
    features: int = 2_000


class Vocabulary:
    """The chosen words and word beginnings, with a bounded memory of the words met so far."""

    def __init__(self, features: Sequence[str], remembered: int = 200_000):
        self.index = {w: i for i, w in enumerate(features)}
        self.met: dict[str, tuple[int, ...]] = {}
        self.remembered = remembered

    def of(self, text: str) -> tuple[list[int], list[float]]:
        """Ids of the features of a text, and how dense each is (log of occurrences in a hundred words)."""
        words = words_of(text)
        found: dict[int, int] = {}
        for word, n in Counter(words).items():
            ids = self.met.get(word)
            if ids is None:
                if len(self.met) >= self.remembered:
                    self.met.clear()
                ids = self.met[word] = tuple(self.index[f] for f in parts_of(word) if f in self.index)
            for i in ids:
                found[i] = found.get(i, 0) + n
        per = 100 / max(len(words), 1)
        return list(found), [math.log1p(per * n) for n in found.values()]


@dataclass(frozen=True)
class Model:
    features: tuple[str, ...]
    presence: np.ndarray
    density: np.ndarray
    bias: float
    prior: float

    def scorer(self) -> Callable[[list[str]], np.ndarray]:
        words = Vocabulary(self.features)

        def run(texts: list[str]) -> np.ndarray:
            z = np.full(len(texts), self.bias)
            for k, text in enumerate(texts):
                ids, dense = words.of(text)
                if ids:
                    z[k] += self.presence[ids].sum() + self.density[ids] @ np.array(dense)
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

        return run


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def parts_of(word: str) -> list[str]:
    """The word itself and its beginnings of four to six letters, marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in (4, 5, 6) if len(word) > n)]


def features_of(text: str) -> set[str]:
    return {f for word in set(words_of(text)) for f in parts_of(word)}


def choose_features(sample: DataFrame, most: int) -> list[str]:
    """Features in at least twice as many positives as their share of all features explains (and a Poisson z of 4 or more).

    ``sample`` has text and positive. Tasks count what their texts hold, sums meet per feature, and only the chosen
    features leave the executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, positive in zip(texts_of(batch), batch.column("positive").to_pylist(), strict=True):
                counts[positive].update(features_of(text))
        for positive, own in counts.items():
            names, n = list(own), list(own.values())
            for low in range(0, len(names), 50_000):
                part = slice(low, low + 50_000)
                columns = [pa.array(names[part]), *(pa.array(n[part] if k is positive else [0] * len(n[part]), pa.int64()) for k in (True, False))]
                yield pa.RecordBatch.from_arrays(columns, names=["feature", "p", "u"])

    held = pin(sample.mapInArrow(run, "feature string, p bigint, u bigint").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u")), "features")
    own, others = held.agg(F.sum("p"), F.sum("u")).first()
    expected = F.lit((own or 0) / max(1, (own or 0) + (others or 0))) * (F.col("p") + F.col("u"))
    often = held.where(F.col("p") >= 3).where(F.col("p") >= 2 * expected)
    scored = often.withColumn("z", (F.col("p") - expected) / F.sqrt(expected)).where("z >= 4")
    return [r["feature"] for r in scored.orderBy(F.desc("z"), "feature").limit(most).collect()]


def fit_nnpu(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, positive: np.ndarray, width: int, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights (last: bias) of a linear model under the non-negative risk, by Adam on all rows of a sparse matrix."""
    n = len(positive)
    share = np.where(positive, 1 / max(positive.sum(), 1), 1 / max((~positive).sum(), 1))
    w = np.zeros(width + 1)
    w[-1] = math.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.clip(np.bincount(rows, values * w[columns], n) + w[-1], -30, 30)
        s = 1 / (1 + np.exp(-z))
        minus = share * np.where(positive, -prior, 1.0)
        plus = np.where(positive, -prior * share * (1 - s), 0.0)
        risk_minus = (minus * np.logaddexp(0, z)).sum()
        slope = plus + minus * s if risk_minus >= 0 else -minus * s
        g = np.append(np.bincount(columns, values * slope[rows], width) + decay * w[:-1], slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def sparse_rows(sample: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the feature matrix, and which rows are positive; texts stay on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(features)
        for batch in batches:
            found = [words.of(text) for text in texts_of(batch)]
            columns = [batch.column("positive"), pa.array([i for i, _ in found], pa.list_(pa.int32())), pa.array([d for _, d in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["positive", "ids", "dense"])

    read = sample.mapInArrow(run, "positive boolean, ids array<int>, dense array<double>").toArrow().combine_chunks()
    ids, dense = (read.column(c).combine_chunks() for c in ("ids", "dense"))
    row = np.repeat(np.arange(read.num_rows), np.diff(ids.offsets.to_numpy()))
    column, value = ids.flatten().to_numpy().astype(np.int64), dense.flatten().to_numpy()
    known = read.column("positive").to_numpy().astype(bool)
    return np.concatenate([row, row]), np.concatenate([column, len(features) + column]), np.concatenate([np.ones(len(value)), value]), known


def fit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> Model:
    """Learn from the documents that aren't held out."""
    seen = docs.where(~held_out("doc_id")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = float(marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0)
    prior = min(max(prior, 1e-3), 0.9)
    usable = seen.where(F.length("text") <= limits.characters)
    toxic = marks.where("toxic = 1").select("doc_id")

    def draw(df: DataFrame, n: int, positive: bool) -> DataFrame:
        """Texts of a bounded sample, as many as fit into the characters in all."""
        so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)
        fitting = bounded_sample(df, "doc_id", n).withColumn("_size", F.sum(F.length("text")).over(so_far))
        return fitting.where(F.col("_size") <= limits.in_all).select("text", F.lit(positive).alias("positive"))

    positives = draw(usable.join(bounded_sample(toxic, "doc_id", 2 * limits.positives), "doc_id", "left_semi"), limits.positives, True)
    sample = pin(positives.unionByName(draw(usable, limits.unlabelled, False)).repartition(partitions_for(docs.sparkSession)), "sample")
    features = choose_features(sample, limits.features)
    rows, columns, values, known = sparse_rows(sample, features)
    if not known.any():
        return Model((), np.zeros(0), np.zeros(0), float(np.log(prior / (1 - prior))), prior)
    w = fit_nnpu(rows, columns, values, known, 2 * len(features), prior)
    return Model(tuple(features), w[: len(features)], w[len(features) : -1], float(w[-1]), prior)


def score(docs: DataFrame, model: Model, column: str = "toxic_score") -> DataFrame:
    """The documents with a column of scores; reads every whole text."""
    docs = docs.drop(column)
    out = docs.withColumn(column, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            yield batch.append_column(column, pa.array(scorer(texts_of(batch)), pa.float64()))

    return docs.mapInArrow(run, out)


def drop_toxic(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that score below one half, with all their columns."""
    name = free_name(docs, "_toxic")
    return score(docs, fit(docs, labels, limits), name).where(F.col(name) < 0.5).drop(name)
