"""Boosted trees for many fits at once.

A fit is a segment, a fold that it leaves out, and a setting. Features are binned once for all of them. A level of the
next tree of all fits is one job: every task adds the gradients of its rows per fit, node, feature and bin; the sums of a
fit meet in one task, which picks the best split of each node; only the splits reach the driver. So the number of jobs is
trees x depth, whatever the number of segments, folds and settings, and no segment is in one task.

Rows carry no state. Margins follow from the trees so far, which travel with the job, so a lost executor costs nothing
but its own tasks. Gradients are added as whole numbers (2^20 to the unit): the order of tasks changes no sum, and a run
can be repeated to the last bit.

A NULL or NaN feature has a bin of its own, the lowest; a row without a target isn't learned from; a segment or fold that
isn't listed has no model and its rows get a NULL prediction.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ranking import exact_quantiles
from ledgerline.session import pin

BINS, UNIT = 32, float(1 << 20)
BINNED = "segment int, fold int, place bigint, target double, bins binary"
SPLIT = "fit int, node int, feature int, bin int, g bigint, h bigint, left_g bigint, left_h bigint"


@dataclass(frozen=True)
class Setting:
    """What a fit may vary; shares are of rows (by hash) and of features per tree."""

    trees: int = 10
    depth: int = 4
    rate: float = 0.3
    subsample: float = 1.0
    colsample: float = 1.0
    gamma: float = 0.0
    min_child: float = 1.0
    alpha: float = 0.0
    reg: float = 0.0


@dataclass
class Fit:
    """One model: trees in heap order, each with the feature (-1 in a leaf), the last bin that goes left, and the value."""

    segment: int
    held: int | None
    setting: Setting
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def leaf(self, tree: tuple, bins: np.ndarray) -> np.ndarray:
        """The node that every row ends in; each split compares one column, best of a matrix that lies by columns."""
        feature, cut, _ = tree
        node = np.zeros(len(bins), np.uint8 if self.setting.depth < 7 else np.int32)
        for level in range(self.setting.depth):
            first = (1 << level) - 1
            splits = first + np.flatnonzero(feature[first : 2 * first + 1] >= 0)
            if not len(splits):
                break
            going, right = np.zeros(len(bins), bool), np.zeros(len(bins), bool)
            for k in splits.tolist():
                here = node == k
                going |= here
                right |= here & (bins[:, feature[k]] > cut[k])
            node += (node + 1 + right) * going
        return node

    def margin(self, bins: np.ndarray, trees: int | None = None) -> np.ndarray:
        total, bins = np.full(len(bins), self.base), np.asfortranarray(bins)
        for tree in self.trees[:trees]:
            total += tree[2].take(self.leaf(tree, bins))
        return total


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Numbers from 0 to 1 that follow from a row's place and a seed."""
    z = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z >> np.uint64(11)) / float(1 << 53)


def known(c: Column | str) -> Column:
    """A feature as a double; NaN is NULL."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x), x)


def edges_of(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Quantiles that part each feature into so many bins; equal ones count once."""
    values = df.select(*[known(c).alias(f"x{i}") for i, c in enumerate(features)])
    names = [f"x{i}" for i in range(len(features))]
    found = {r["column"]: r for r in exact_quantiles(values, names, [k / bins for k in range(1, bins)]).collect()}
    return [np.unique([found[n][f"q{k}"] for k in range(bins - 1)]) if n in found else np.zeros(0) for n in names]


def bins_of(column: pa.Array, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of an Arrow column of feature arrays: 0 for NULL, else 1 and the number of edges below the value."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), len(edges))
    out = np.zeros(x.shape, np.uint8)
    for k, cuts in enumerate(edges):
        out[:, k] = np.where(np.isnan(x[:, k]), 0, 1 + np.searchsorted(cuts, x[:, k], side="left"))
    return out


def segment_number(segment: Column | None, values: Sequence) -> Column:
    """Place of the row's segment among the listed ones, else -1."""
    if segment is None:
        return F.lit(0)
    return F.coalesce(*[F.when(segment == v, F.lit(i)) for i, v in enumerate(values)], F.lit(-1))


def binned(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], target: Column, segment: Column, fold: Column, place: Column) -> DataFrame:
    """The rows that are learned from, written once: segment, fold, place, target and one byte per feature."""
    given = df.select(
        segment.cast("int").alias("segment"), F.coalesce(fold.cast("int"), F.lit(-1)).alias("fold"), place.cast("bigint").alias("place"),
        known(target).alias("target"), F.array(*[known(c) for c in features]).alias("x"),
    ).where("segment >= 0 AND target IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = pa.array([row.tobytes() for row in bins_of(batch.column("x"), edges)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("segment", "fold", "place", "target")), bins], names=[c.split()[0] for c in BINNED.split(", ")])

    return pin(given.mapInArrow(run, BINNED), "binned")


def rows_in(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    segment, fold, place, target = (batch.column(c).to_numpy() for c in ("segment", "fold", "place", "target"))
    return segment, fold, place, target, bytes_of(batch.column("bins")).reshape(batch.num_rows, -1 if batch.num_rows else 0)


def bytes_of(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column without NULLs, as they lie there."""
    if not len(column):
        return np.zeros((0, 0), np.uint8)
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    low, high = np.frombuffer(offsets, np.int64)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(data, np.uint8)[low:high]


def slopes(margin: np.ndarray, target: np.ndarray, logistic: bool) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss, as whole numbers."""
    if logistic:
        p = 1 / (1 + np.exp(-margin))
        g, h = p - target, p * (1 - p)
    else:
        g, h = margin - target, np.ones(len(margin))
    return np.floor(g * UNIT + 0.5), np.floor(h * UNIT + 0.5)


def shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def worth(g: np.ndarray, h: np.ndarray, s: Setting) -> np.ndarray:
    """What a node with these sums takes off the loss (twice)."""
    g, h = shrunk(g / UNIT, s.alpha), h / UNIT + s.reg
    return np.divide(g * g, h, out=np.zeros_like(g), where=h > 0)


def value(g: int, h: int, s: Setting) -> float:
    weight = h / UNIT + s.reg
    return float(-s.rate * shrunk(np.float64(g / UNIT), s.alpha) / weight) if weight > 0 else 0.0


def best_splits(sums: np.ndarray, s: Setting, allowed: np.ndarray) -> Iterator[tuple[int, ...]]:
    """For every node: (node, feature or -1, last bin that goes left, sums of the node, sums of its left side)."""
    upto = np.cumsum(sums, axis=2)
    for node in range(len(sums)):
        g, h = upto[node, 0, -1]
        left_g, left_h = upto[node, :, :-1, 0], upto[node, :, :-1, 1]
        enough = (left_h / UNIT >= s.min_child) & ((h - left_h) / UNIT >= s.min_child) & allowed[:, None]
        gain = worth(left_g, left_h, s) + worth(g - left_g, h - left_h, s) - worth(np.array([g]), np.array([h]), s)
        gain = np.where(enough, gain, -1.0)
        at = int(np.argmax(gain))
        feature, cut = divmod(at, gain.shape[1])
        if gain.flat[at] > 2 * s.gamma and gain.flat[at] > 0:
            yield node, feature, cut, int(g), int(h), int(left_g[feature, cut]), int(left_h[feature, cut])
        else:
            yield node, -1, 0, int(g), int(h), 0, 0


def level_splits(rows: DataFrame, fits: dict[int, Fit], level: int, width: int, bins: int, logistic: bool, seed: int) -> list:
    """The best splits of all nodes of one level of all given fits, in one job."""
    # Fits that learn from the same rows of a batch pick them once.
    alike: dict[tuple, list[int]] = {}
    for k, fit in fits.items():
        alike.setdefault((fit.segment, fit.held, fit.setting.subsample, len(fit.trees) - 1), []).append(k)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << level) * width * bins
        sums = {k: np.zeros((size, 2), np.int64) for k in fits}
        for batch in batches:
            segment, fold, place, target, matrix = rows_in(batch)
            for (part, held, share, tree), same in alike.items():
                own = segment == part
                if held is not None:
                    own &= fold != held
                if share < 1:
                    own &= mixed(place, seed + tree) < share
                own = np.flatnonzero(own)
                if not len(own):
                    continue
                x, y = np.asfortranarray(matrix[own]), target[own]
                wide = x.astype(np.int64)
                for k in same:
                    node = fits[k].leaf(fits[k].trees[-1], x).astype(np.int64) - ((1 << level) - 1)
                    alive = node >= 0  # rows that ended in a leaf above add nothing
                    first = np.where(alive, node, 0) * bins
                    weights = [w * alive for w in slopes(fits[k].margin(x, tree), y, logistic)]
                    added = np.empty((2, width, bins << level))
                    for f in range(width):
                        at = first + wide[:, f]
                        for j, weight in enumerate(weights):
                            added[j, f] = np.bincount(at, weight, bins << level)
                    sums[k] += added.reshape(2, width, 1 << level, bins).transpose(2, 1, 3, 0).reshape(size, 2).astype(np.int64)
        held = [(k, s) for k, s in sums.items() if s.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int32()), pa.array([s.tobytes() for _, s in held], pa.binary())], names=["fit", "sums"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(k: int, total: np.ndarray) -> pa.RecordBatch:
            s = fits[k].setting
            chosen = np.random.default_rng([seed, len(fits[k].trees)]).permutation(width)[: max(1, round(s.colsample * width))]
            found = [(k, *split) for split in best_splits(total.reshape(1 << level, width, bins, 2), s, np.isin(np.arange(width), chosen))]
            kinds = [*[pa.int32()] * 4, *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=[c.split()[0] for c in SPLIT.split(", ")])

        now, total = None, None
        for batch in batches:  # sorted by fit: one sum is held at a time
            for k, part in zip(batch.column("fit").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                if k != now:
                    if now is not None:
                        yield ended(now, total)
                    now, total = k, np.zeros(((1 << level) * width * bins, 2), np.int64)
                total += np.frombuffer(part, np.int64).reshape(-1, 2)
        if now is not None:
            yield ended(now, total)

    partial = rows.mapInArrow(add, "fit int, sums binary").repartition("fit").sortWithinPartitions("fit")
    return partial.mapInArrow(pick, SPLIT).collect()  # one row per fit and node


def boost(rows: DataFrame, fits: Sequence[Fit], width: int, logistic: bool = False, seed: int = 0, upto: int | None = None, bins: int = BINS) -> None:
    """Add trees to all fits until each has as many as its setting says, or ``upto``."""
    goal = [min(f.setting.trees, upto or f.setting.trees) for f in fits]
    for tree in range(max(goal, default=0)):
        growing = {k: f for k, f in enumerate(fits) if len(f.trees) == tree < goal[k]}
        for f in growing.values():
            nodes = (1 << (f.setting.depth + 1)) - 1
            f.trees.append((np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes)))
        for level in range(max((f.setting.depth for f in growing.values()), default=0)):
            first = (1 << level) - 1
            open_fits = {k: f for k, f in growing.items() if level < f.setting.depth and (level == 0 or (f.trees[-1][0][first // 2 : first] >= 0).any())}
            if not open_fits:
                break
            for row in level_splits(rows, open_fits, level, width, bins + 1, logistic, seed):
                f = fits[row["fit"]]
                feature, cut, values = f.trees[-1]
                node = first + row["node"]
                if level == 0:
                    values[0] = value(row["g"], row["h"], f.setting)
                if row["feature"] >= 0:
                    feature[node], cut[node] = row["feature"], row["bin"]
                    values[2 * node + 1] = value(row["left_g"], row["left_h"], f.setting)
                    values[2 * node + 2] = value(row["g"] - row["left_g"], row["h"] - row["left_h"], f.setting)


def set_bases(rows: DataFrame, fits: Sequence[Fit]) -> None:
    """Start every fit from the mean target of the rows that it learns from; a fit without rows gets no trees."""
    held = sorted({f.held for f in fits if f.held is not None})
    fold = F.when(F.col("fold").isin(held), F.col("fold")).otherwise(-1) if held else F.lit(-1)
    whole = F.floor(F.col("target") * UNIT + 0.5).cast("bigint")
    sums = rows.groupBy("segment", fold.alias("fold")).agg(F.sum(whole).alias("t"), F.count(F.lit(1)).alias("n")).collect()
    for f in fits:
        own = [r for r in sums if r["segment"] == f.segment and (f.held is None or r["fold"] != f.held)]
        n = sum(r["n"] for r in own)
        f.base = sum(r["t"] for r in own) / UNIT / n if n else float("nan")


def predicted(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], fits: Sequence[Fit], segment: Column, fold: Column | None = None, out: str = "prediction", logistic: bool = False) -> DataFrame:
    """All rows and columns with the prediction of the fit of the row's segment (that leaves out its fold)."""
    models = {(f.segment, f.held): f for f in fits}
    kept = df.drop(out)
    helpers = [segment.cast("int"), (F.lit(None) if fold is None else fold).cast("int"), F.array(*[known(c) for c in features])]
    names = ["_segment", "_fold", "_x"]
    given = kept.withColumns({f"{n}_{out}": c for n, c in zip(names, helpers, strict=True)})
    schema = kept.withColumn(out, F.lit(None).cast("double")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(f"{n}_{out}") for n in names]
            seg, at = own[0].to_numpy(zero_copy_only=False), own[1].to_pylist()
            matrix, total = bins_of(own[2], edges), np.full(batch.num_rows, np.nan)
            at = np.array([-(1 << 40) if x is None else x for x in at], np.int64)
            for (s, held), fit in models.items():
                rows = np.flatnonzero((seg == s) & ((at == held) if held is not None else True))
                if len(rows):
                    total[rows] = fit.margin(matrix[rows])
            if logistic:
                total = 1 / (1 + np.exp(-total))
            plain = batch.drop_columns([f"{n}_{out}" for n in names])
            yield plain.append_column(out, pa.array(total, pa.float64(), mask=np.isnan(total)))

    return given.mapInArrow(run, schema)
