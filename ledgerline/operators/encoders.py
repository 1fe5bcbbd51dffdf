"""Category and target encoders, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.ranking import range_positions
from ledgerline.operators.scans import match_null_safe
from ledgerline.operators.tables import attach_checked
from ledgerline.session import pin

PRIOR_PRECISION = 1e-6
Encoding = tuple[Sequence[str], Sequence[str] | None]

# Use classes that keep a group of their own; all others share the last group.
USE_GROUPS = (
    ("Education",),
    ("Lodging/residential",),
    ("Office",),
    ("Entertainment/public assembly",),
    ("Public services",),
    (
        "Other", "Retail", "Parking", "Warehouse/storage", "Food sales and service", "Religious worship", "Utility",
        "Technology/science", "Healthcare", "Manufacturing/industrial", "Services",
    ),
)


def group_categories(value: Column, groups: Sequence[Sequence[str]] = USE_GROUPS) -> Column:
    """Number of the group that lists the value; NULL when none does."""
    return F.coalesce(*[F.when(value.isin(*names), F.lit(i)) for i, names in enumerate(groups)])


# ---------------------------------------------------------------- target encoding


def posterior(n: Column, mean: Column, variance: Column, prior: Column, tau: float = PRIOR_PRECISION, stat: str = "mean") -> Column:
    """Normal posterior of a group mean; NULL when the sample variance is missing.

    Where it is 0 (equal targets) the precision is infinite: its inverse is 0, mean and precision are NULL.
    """
    weight = F.try_divide(n, variance)
    precision = weight + F.lit(tau)
    if stat == "mean":
        return (prior * tau + weight * mean) / precision
    if stat == "var":
        return F.when(variance == 0, F.lit(0.0)).otherwise(F.lit(1.0) / precision)
    if stat == "precision":
        return precision
    raise ValueError(f"unknown statistic {stat!r}")


def _row_prior(df: DataFrame, target: str, priors: Sequence[str] | None) -> Column:
    """Mean of the prior columns, or the table-wide target mean as a one-value subquery."""
    if priors is None:
        return df.agg(F.avg(target)).scalar()
    return sum((F.col(p) for p in priors[1:]), F.col(priors[0])) / len(priors)


def gaussian_target_encode(
    fit: DataFrame,
    apply: DataFrame,
    keys: Sequence[str],
    target: str,
    priors: Sequence[str] | None = None,
    *,
    out: str,
    tau: float = PRIOR_PRECISION,
    stat: str = "mean",
) -> DataFrame:
    """Shrink group means of ``fit`` and attach them to ``apply``; unseen groups get the row's own prior."""
    prior = _row_prior(fit, target, priors)
    groups = fit.withColumn("_prior", prior).groupBy(*keys).agg(
        F.count(target).alias("_n"),
        F.avg(target).alias("_mean"),
        # Equal targets give exactly 0, whatever the rounding of the running variance.
        F.when(F.min(target) == F.max(target), F.when(F.count(target) > 1, F.lit(0.0)))
        .otherwise(F.var_samp(target))
        .alias("_var"),
        F.avg("_prior").alias("_mu0"),
    )
    fitted = groups.select(*keys, posterior(F.col("_n"), F.col("_mean"), F.col("_var"), F.col("_mu0"), tau, stat).alias("_fit"))
    joined = attach_checked(apply, fitted, keys)
    fallback = _row_prior(apply, target, priors)
    return joined.withColumn(out, F.coalesce(F.col("_fit"), fallback)).drop("_fit")


# Encodings in fitting order, with the earlier encodings that serve as prior.
ENCODINGS: tuple[Encoding, ...] = (
    (("hour",), None),
    (("weekday",), None),
    (("month",), None),
    (("building_id",), None),
    (("primary_use",), None),
    (("site_id",), None),
    (("meter",), None),
    (("meter", "hour"), ("gte_meter", "gte_hour")),
    (("meter", "weekday"), ("gte_meter", "gte_weekday")),
    (("meter", "month"), ("gte_meter", "gte_month")),
    (("meter", "building_id"), ("gte_meter", "gte_building_id")),
    (("meter", "primary_use"), ("gte_meter", "gte_primary_use")),
    (("meter", "site_id"), ("gte_meter", "gte_site_id")),
    (("meter", "building_id", "hour"), ("gte_meter_building_id", "gte_meter_hour")),
    (("meter", "building_id", "weekday"), ("gte_meter_building_id", "gte_meter_weekday")),
    (("meter", "building_id", "month"), ("gte_meter_building_id", "gte_meter_month")),
)
CELL = ["building_id", "site_id", "primary_use", "meter", "hour", "weekday", "month"]


def encoding_name(keys: Sequence[str]) -> str:
    return "gte_" + "_".join(keys)


@dataclass(frozen=True)
class TargetEncodings:
    """Fitted encodings: a small table (keys, fit) of each, and one row with the means that stand in for unseen groups.

    The state can be saved and applied to any table with the cell columns, rows of later periods among them.
    """

    tables: Mapping[str, DataFrame]
    means: DataFrame
    encodings: Sequence[Encoding] = ENCODINGS
    cell: Sequence[str] = tuple(CELL)

    def save(self, path: str) -> None:
        """One Parquet folder per encoding below ``path``, and one for the means."""
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        self.means.write.mode("overwrite").parquet(f"{path}/means")

    @staticmethod
    def load(spark: SparkSession, path: str, encodings: Sequence[Encoding] = ENCODINGS, cell: Sequence[str] = tuple(CELL)) -> TargetEncodings:
        tables = {encoding_name(keys): spark.read.parquet(f"{path}/{encoding_name(keys)}") for keys, _ in encodings}
        return TargetEncodings(tables, spark.read.parquet(f"{path}/means"), encodings, cell)

    def apply(self, df: DataFrame) -> DataFrame:
        """All rows with all encodings; a group that wasn't fitted falls back to its prior, the first to the mean of all rows.

        The chain runs on the distinct cells, which the rows meet in a single join.
        """
        cells = df.select(*self.cell).distinct().withColumn("_row", self.means.select("row").scalar())
        for keys, priors in self.encodings:
            name = encoding_name(keys)
            prior = F.col("_row") if priors is None else sum((F.col(p) for p in priors[1:]), F.col(priors[0])) / len(priors)
            cells = cells.join(self.tables[name], list(keys), "left").withColumn(name, F.coalesce("_fit", prior)).drop("_fit")
        names = [encoding_name(keys) for keys, _ in self.encodings]
        return match_null_safe(df, cells.select(*self.cell, *names), list(self.cell), "left")


def fit_target_encodings(
    train: DataFrame,
    *,
    target: str = "target",
    good: Column | None = None,
    encodings: Sequence[Encoding] = ENCODINGS,
    cell: Sequence[str] = CELL,
    tau: float = PRIOR_PRECISION,
) -> TargetEncodings:
    """Fit all encodings on the good training rows.

    Every encoding depends on a row only through its cell (the combination of all key columns), so the rows are reduced
    once to cell moments and the chain runs on those. Encodings that do not build on each other are fitted together, by
    one grouping-sets pass per level. A group without a usable variance has no fit. The first prior is the mean of the
    good rows while fitting, and the mean of all training rows where the encodings are applied.
    """
    y = F.col(target) if good is None else F.when(F.coalesce(good, F.lit(False)), F.col(target))
    cells = train.groupBy(*cell).agg(
        F.count(y).alias("_n"),
        F.sum(y).alias("_sum"),
        (F.var_pop(y) * F.count(y)).alias("_m2"),
        F.min(y).alias("_low"),
        F.max(y).alias("_high"),
    )
    means = pin(train.agg(F.avg(y).alias("fit"), F.avg(target).alias("row")), "means")
    cells = pin(cells.where("_n > 0").withColumn("_mean_fit", means.select("fit").scalar()), "cells")
    levels = _levels(encodings)
    tables: dict[str, DataFrame] = {}
    for at, level in enumerate(levels):
        cells = _encode_cells(cells, level, tau, tables, last=at == len(levels) - 1)
    return TargetEncodings(tables, means, encodings, cell)


def target_encode_stack(train: DataFrame, test: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame | None]:
    """All encodings, fitted on the good training rows and attached to train and test."""
    fitted = fit_target_encodings(train, **options)
    return fitted.apply(train), None if test is None else fitted.apply(test)


def _levels(encodings: Sequence[Encoding]) -> list[list[Encoding]]:
    """Encodings by depth: the first level has no priors, the others build on earlier levels."""
    depth: dict[str, int] = {}
    levels: list[list[Encoding]] = []
    for keys, priors in encodings:
        at = 0 if priors is None else 1 + max(depth[p] for p in priors)
        depth[encoding_name(keys)] = at
        if at == len(levels):
            levels.append([])
        levels[at].append((keys, priors))
    return levels


def _encode_cells(cells: DataFrame, level: Sequence[Encoding], tau: float, tables: dict[str, DataFrame], last: bool) -> DataFrame:
    """Fit the encodings of one level into ``tables``; the cells get ``_f_name`` as the next level's fit sees it.

    Cell moments (count, sum, squared deviations) combine to the moments of the group.
    """

    def prior(priors: Sequence[str] | None) -> Column:
        if priors is None:
            return F.col("_mean_fit")
        return sum((F.col("_f_" + p) for p in priors[1:]), F.col("_f_" + priors[0])) / len(priors)

    names = [encoding_name(keys) for keys, _ in level]
    columns = list(dict.fromkeys(c for keys, _ in level for c in keys))
    n = F.col("_n")
    priors_of = {f"_prior_{name}": prior(priors) for name, (_, priors) in zip(names, level, strict=True)}
    groups = pin(
        cells.withColumns(priors_of)
        .groupingSets([list(keys) for keys, _ in level], *columns)
        .agg(
            F.grouping_id().alias("_set"),
            F.sum("_n").alias("_gn"),
            F.sum("_sum").alias("_gsum"),
            F.sum("_m2").alias("_within"),
            F.sum(F.col("_sum") * F.col("_sum") / n).alias("_square"),
            F.min("_low").alias("_glow"),
            F.max("_high").alias("_ghigh"),
            *[(F.sum(F.col(p) * n) / F.sum("_n")).alias(p) for p in priors_of],
        )
    )
    total, mean = F.col("_gn"), F.col("_gsum") / F.col("_gn")
    deviations = F.col("_within") + F.col("_square") - total * mean * mean
    variance = F.when(F.col("_glow") < F.col("_ghigh"), F.try_divide(F.greatest(deviations, F.lit(0.0)), total - 1))
    for name, (keys, priors) in zip(names, level, strict=True):
        # A grouping-set id has a 1 for every column left out, the first column being the highest bit.
        set_id = int("".join("0" if c in keys else "1" for c in columns), 2)
        fit = posterior(total, mean, variance, F.col(f"_prior_{name}"), tau).alias("_fit")
        tables[name] = groups.where(F.col("_set") == set_id).select(*keys, fit)
        if not last:
            cells = cells.join(tables[name], list(keys), "left").withColumn(f"_f_{name}", F.coalesce("_fit", prior(priors))).drop("_fit")
    return cells


# ---------------------------------------------------------------- category codes


def vocabulary_codes(tables: Sequence[DataFrame], columns: Sequence[str], segment: str | None = None) -> DataFrame:
    """(segment, column, text, number) -> code: place of the value in sorted order, from 0.

    Numbers sort as numbers and text as text. All columns are ranked together in one range-partitioned
    pass over the distinct values.
    """
    def typed(df: DataFrame) -> DataFrame:
        cells = []
        for c in columns:
            is_text = df.schema[c].dataType.typeName() == "string"
            text = F.col(c) if is_text else F.lit(None).cast("string")
            number = F.lit(None).cast("double") if is_text else F.col(c).cast("double")
            cells.append(F.struct(F.lit(c).alias("column"), number.alias("number"), text.alias("text")))
        segments = [F.col(segment).alias("segment")] if segment else [F.lit(0).alias("segment")]
        pairs = df.select(*segments, F.inline(F.array(*cells)))
        return pairs.where(F.col("number").isNotNull() | F.col("text").isNotNull()).distinct()

    values = reduce(DataFrame.unionByName, [typed(t) for t in tables]).distinct()
    return range_positions(values, ["number", "text"], within=["segment", "column"], out="code")


def label_encode(train: DataFrame, test: DataFrame, columns: Sequence[str], segment: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Replace categories by sorted-order codes, fitted on train and test together, per segment."""
    codes = pin(vocabulary_codes([train, test], columns, segment))
    return tuple(_replace_by_codes(df, codes, columns, segment) for df in (train, test))  # type: ignore[return-value]


def codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted-order codes of one table."""
    return _replace_by_codes(df, pin(vocabulary_codes([df], columns)), columns, None)


def _replace_by_codes(df: DataFrame, table: DataFrame, columns: Sequence[str], segment: str | None) -> DataFrame:
    for c in columns:
        is_text = df.schema[c].dataType.typeName() == "string"
        value = F.col("text") if is_text else F.col("number").cast(df.schema[c].dataType)
        names = [F.col("segment").alias(segment)] if segment else []
        lookup = table.where(F.col("column") == c).select(*names, value.alias(c), F.col("code").alias("_code"))
        joined = attach_checked(df, lookup, [*([segment] if segment else []), c])
        df = joined.withColumn(c, F.col("_code")).drop("_code")
    return df


def first_seen_codes(df: DataFrame, column: str, order: str) -> DataFrame:
    """value -> code by first appearance along ``order``."""
    firsts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first"))
    return range_positions(firsts, ["_first", column], out="code").drop("_first")


def first_seen_encode(df: DataFrame, column: str, order: str) -> DataFrame:
    table = first_seen_codes(df, column, order).withColumnRenamed("code", "_code")
    return attach_checked(df, table, [column]).withColumn(column, F.col("_code")).drop("_code")


# ---------------------------------------------------------------- scaling


def standardize_by_segment(train: DataFrame, test: DataFrame, columns: Sequence[str], segment: str) -> tuple[DataFrame, DataFrame]:
    """(x - mean) / population deviation per segment, over train and test together."""
    both = train.select(segment, *columns).unionByName(test.select(segment, *columns))
    moments: list[Column] = []
    for c in columns:
        moments += [F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    stats = pin(both.groupBy(segment).agg(*moments))
    scaled = {c: F.try_divide(F.col(c) - F.col(f"_mu_{c}"), F.col(f"_sd_{c}")) for c in columns}
    helpers = [c for c in stats.columns if c != segment]

    def scale(df: DataFrame) -> DataFrame:
        return attach_checked(df, stats, [segment]).withColumns(scaled).drop(*helpers)

    return scale(train), scale(test)


def standard_scale(train: DataFrame, others: Mapping[str, DataFrame], columns: Sequence[str]) -> dict[str, DataFrame]:
    """Scale every table with mean and population deviation of the training table; a constant column becomes 0."""
    moments: list[Column] = []
    for c in columns:
        moments += [F.avg(c).alias(f"mu_{c}"), F.stddev_pop(c).alias(f"sd_{c}")]
    fitted = train.agg(*moments)
    row = fitted.select(F.struct(*fitted.columns)).scalar()

    def scale(df: DataFrame) -> DataFrame:
        with_row = df.withColumn("_fit", row)
        made = {}
        for c in columns:
            spread = F.col("_fit")[f"sd_{c}"]
            made[c] = (F.col(c) - F.col("_fit")[f"mu_{c}"]) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)
        return with_row.withColumns(made).drop("_fit")

    return {"train": scale(train), **{name: scale(df) for name, df in others.items()}}
