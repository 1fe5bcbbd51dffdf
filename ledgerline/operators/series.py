"""Hourly meter and weather series.

A series is one (building, meter) or one site and has at most one row per hour, so its length is
bounded by the calendar. The run scans still accept ``slice_by``, for callers whose rows are denser.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import hours as hr
from ledgerline.operators.ranking import exact_quantiles
from ledgerline.operators.scans import HOT_ROWS, Build, match_null_safe, scan, slice_of, split_hot
from ledgerline.operators.tables import attach_checked

SERIES = ["building_id", "meter"]


# ---------------------------------------------------------------- row rules


def drop_rows(df: DataFrame, *bad: Column) -> DataFrame:
    """Remove rows on which any rule holds; a rule that is NULL does not remove the row."""
    flag = F.lit(False)
    for rule in bad:
        flag = flag | F.coalesce(rule, F.lit(False))
    return df.where(~flag)


# Known bad meters and the day up to which the first site's electricity is unusable.
BAD_BUILDING = 1099
FIRST_SITE_LAST_BUILDING = 104
FIRST_SITE_BAD_UNTIL = "2016-05-20"
ZERO_IS_BAD = (954, 1221)
WARMUP_HOURS = 3378
EXTREME_READING = 3e4


def known_bad_rules(
    bad_building: int = BAD_BUILDING,
    last_building: int = FIRST_SITE_LAST_BUILDING,
    until: str = FIRST_SITE_BAD_UNTIL,
    zero_is_bad: Sequence[int] = ZERO_IS_BAD,
) -> list[Column]:
    building, meter = F.col("building_id"), F.col("meter")
    early = F.col("timestamp") <= F.lit(until).cast("timestamp_ntz")
    return [
        building == bad_building,
        (building <= last_building) & (meter == 0) & early,
        building.isin(*zero_is_bad) & (F.col("meter_reading") == 0),
    ]


def warmup_rule(hours: int = WARMUP_HOURS) -> Column:
    return (F.col("hour_index") < hours) & (F.col("site_id") == 0) & (F.col("meter") == 0)


def extreme_rule(building: int = BAD_BUILDING, limit: float = EXTREME_READING) -> Column:
    return (F.col("building_id") == building) & (F.col("meter") == 2) & (F.col("meter_reading") > limit)


def reference_rows(df: DataFrame, first_year: int = 2017, last_year: int = 2018, without: int = 245) -> DataFrame:
    """Reference readings usable for scoring: NULL is 0, negatives are 0, one building is left out."""
    kept = df.where(F.year("timestamp").between(first_year, last_year) & (F.col("building_id") != without))
    return kept.withColumn("meter_reading", hr.zero_below(F.coalesce("meter_reading", F.lit(0.0))))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order`` (total within a key); an aggregate, so copies merge before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*keys, "_row.*").select(*df.columns)


# ---------------------------------------------------------------- runs


def zero_streak(df: DataFrame, slice_by: str | None = None, out: str = "zero_streak") -> DataFrame:
    """Length so far of the current run of zero readings, 0 on other rows."""
    return scan(df, SERIES, ["timestamp"], slice_by, runs={out: F.col("meter_reading") == 0})


def by_series(df: DataFrame, build: Build, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Run a series operator with long series cut into slices of about ``hot_rows`` rows."""
    return split_hot(df, SERIES, ["timestamp"], build, hot_rows)


def run_ids(df: DataFrame, value: Column, slice_by: str | None = None, out: str = "run_id") -> DataFrame:
    """Number the runs of equal ``value`` in a series 1, 2, ..."""
    before = scan(df, SERIES, ["timestamp"], slice_by, lags={"_before": F.struct(value.alias("v"))})
    changed = F.col("_before").isNull() | ~F.col("_before")["v"].eqNullSafe(value)
    return scan(before, SERIES, ["timestamp"], slice_by, sums={out: changed.cast("int")}).drop("_before")


def _per_group(df: DataFrame, keys: Sequence[str], slice_by: str | None, totals: Mapping[str, Column]) -> DataFrame:
    """Group totals on every row. Ordinary series are already in one task; a sliced one is aggregated and joined."""
    if slice_by is None:
        group = Window.partitionBy(*keys)
        return df.withColumns({name: c.over(group) for name, c in totals.items()})
    return match_null_safe(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()]), keys, "left")


def drop_long_zero_runs(df: DataFrame, limit: int = 240) -> DataFrame:
    """Keep rows whose running zero count is below ``limit``."""
    return df.where(F.col("zero_streak") < limit)


def constant_runs(df: DataFrame, min_constant: int = 6, slice_by: str | None = None) -> DataFrame:
    """Flag all rows but the first of a run of equal readings that repeats more than ``min_constant`` times."""
    runs = run_ids(df, F.col("meter_reading"), slice_by)
    counted = _per_group(
        runs,
        [*SERIES, "run_id"],
        slice_by,
        {"_run_rows": F.count(F.lit(1)), "_run_start": F.min("timestamp")},
    )
    repeats = (F.col("_run_rows") - 1 > min_constant) & (F.col("timestamp") > F.col("_run_start"))
    flag = repeats & F.col("meter_reading").isNotNull()
    return counted.withColumn("is_constant", flag).drop("_run_rows", "_run_start", "run_id")


# Shortest bad zero run, summer hours, and the year-end hours of the chilled-water rule.
MIN_ZERO_RUN = 48
SUMMER_HOURS = (3000, 7500)
YEAR_END_HOURS = (0, 500, 8283, 8783)


def bad_zero_flag(
    df: DataFrame,
    min_interval: int = MIN_ZERO_RUN,
    summer: tuple[int, int] = SUMMER_HOURS,
    year_ends: tuple[int, int, int, int] = YEAR_END_HOURS,
    slice_by: str | None = None,
) -> DataFrame:
    """``is_bad_zero`` by meter kind, from ``hour_index``.

    Kind 0: every zero. Kinds 2 and 3: a zero run of ``min_interval`` rows or more of which some row lies
    outside the summer. Kind 1: a run of that length, except the first and the last run of the year when
    both span the given hours.
    """
    is_zero = F.coalesce(F.col("meter_reading") == 0, F.lit(False))
    hour, meter, run = F.col("hour_index"), F.col("meter"), F.col("run_id")
    off_season = is_zero & ((hour < summer[0]) | (hour > summer[1]))
    runs = run_ids(df, is_zero, slice_by)
    measured = _per_group(
        runs,
        [*SERIES, "run_id"],
        slice_by,
        {"_run_rows": F.count(F.lit(1)), "_off_season": F.max(off_season.cast("int"))},
    )
    zero_run_at = {f"_at{i}": F.max(F.when(is_zero & (hour == h), run)) for i, h in enumerate(year_ends)}
    placed = _per_group(measured, SERIES, slice_by, zero_run_at)
    long_run = F.col("_run_rows") >= min_interval
    winter_off = (F.col("_at0") == F.col("_at1")) & (F.col("_at2") == F.col("_at3"))
    excused = F.coalesce(winter_off & ((run == F.col("_at0")) | (run == F.col("_at2"))), F.lit(False))
    bad = (
        F.when(meter == 0, F.lit(True))
        .when(meter.isin(2, 3), long_run & (F.col("_off_season") == 1))
        .when(meter == 1, long_run & ~excused)
        .otherwise(F.raise_error(F.lit("unknown meter kind")).cast("boolean"))
    )
    return placed.withColumn("is_bad_zero", is_zero & bad).drop("run_id", "_run_rows", "_off_season", *zero_run_at)


# ---------------------------------------------------------------- rolling features


def _stats(frame, column: str, suffix: str) -> dict[str, Column]:
    return {
        f"{column}_mean_{suffix}": F.avg(column).over(frame),
        f"{column}_max_{suffix}": F.max(column).over(frame),
        f"{column}_min_{suffix}": F.min(column).over(frame),
        f"{column}_std_{suffix}": F.stddev_samp(column).over(frame),
    }


def rolling_trailing(df: DataFrame, columns: Sequence[str], rows: int, key: str = "site_id", order: str = "timestamp") -> DataFrame:
    """Mean, max, min and sample deviation of the last ``rows`` rows, the current one included; NULLs skipped."""
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(-(rows - 1), 0)
    made: dict[str, Column] = {}
    for column in columns:
        made |= _stats(frame, column, f"lag{rows}")
    return df.withColumns(made)


def rolling_centered(df: DataFrame, columns: Sequence[str], rows: int, key: str = "site_id", order: str = "timestamp") -> DataFrame:
    """Centered window of an odd number of rows; ``max`` and ``min`` are the 0.95 and 0.05 quantiles."""
    if rows % 2 == 0:
        raise ValueError("a centered window needs an odd number of rows")
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(-(rows // 2), rows // 2)
    made: dict[str, Column] = {}
    for column in columns:
        made |= _stats(frame, column, f"lag{rows}")
        made[f"{column}_max_lag{rows}"] = F.percentile(column, 0.95).over(frame)
        made[f"{column}_min_lag{rows}"] = F.percentile(column, 0.05).over(frame)
    return df.withColumns(made)


# ---------------------------------------------------------------- gaps


def hour_grid(df: DataFrame, key: str = "site_id", hour: str = "hour_index", start: int | None = None, end: int | None = None) -> DataFrame:
    """All hours of every key, from ``start`` to ``end`` (default: first to last hour of the table); new rows hold NULLs."""
    ends = df.agg(F.min(hour).alias("first"), F.max(hour).alias("last")).select(F.struct("first", "last")).scalar()
    first = F.lit(start).cast("bigint") if start is not None else F.col("_ends")["first"]
    last = F.lit(end).cast("bigint") if end is not None else F.col("_ends")["last"]
    keys = df.select(key).distinct().withColumn("_ends", ends)
    grid = keys.select(key, F.explode(F.sequence(first, last)).alias(hour))
    return grid.join(df, [key, hour], "left")


def presence_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"had_{c}": F.col(c).isNotNull() for c in columns})


def fill_sentinel(df: DataFrame, value: float = -1) -> DataFrame:
    """NULL numbers become ``value``."""
    return df.fillna(value)


def fill_below_min(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs of each column become its minimum less one; the minima come from one pass."""
    lows = df.agg(*[F.min(c).alias(c) for c in columns]).select(F.struct(*columns)).scalar()
    filled = df.withColumn("_lows", lows)
    return filled.withColumns({c: F.coalesce(c, F.col("_lows")[c] - 1) for c in columns}).drop("_lows")


def group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def _day_groups(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"_day": F.dayofmonth(ts), "_month": F.month(ts)})


def fill_group_mean(df: DataFrame, columns: Sequence[str], key: str = "site_id", ts: str = "timestamp") -> DataFrame:
    """NULL becomes the mean of the same key, day of month and month."""
    return _fill(_day_groups(df, ts), None, columns, key)


def fill_group_mean_ffill(
    df: DataFrame, columns: Sequence[str], key: str = "site_id", ts: str = "timestamp", mode: str = "within_site"
) -> DataFrame:
    """Like :func:`fill_group_mean`; an empty group takes the mean of the group before it (by day, then month).

    ``within_site`` looks back inside the key only, ``legacy`` goes on into the key before it.
    """
    if mode not in ("within_site", "legacy"):
        raise ValueError(f"unknown mode {mode!r}")
    return _fill(_day_groups(df, ts), mode, columns, key)


def _fill(dated: DataFrame, mode: str | None, columns: Sequence[str], key: str) -> DataFrame:
    keys = [key, "_day", "_month"]
    means = group_means(dated, keys, columns)
    filled = {f"_m_{c}": F.col(c) for c in columns}
    if mode == "within_site":
        means = scan(means, [key], ["_day", "_month"], lasts=filled)
    elif mode == "legacy":
        # One sequence over all keys, cut by key.
        whole = means.withColumn("_all", F.lit(0))
        whole = whole.withColumn("_slice", slice_of(["_all"], F.col(key)))
        means = scan(whole, ["_all"], keys, "_slice", lasts=filled).drop("_all", "_slice")
    else:
        means = means.withColumns(filled)
    joined = attach_checked(dated, means.select(*keys, *filled), keys)
    return joined.withColumns({c: F.coalesce(c, f"_m_{c}") for c in columns}).drop(*filled, "_day", "_month")


def interpolate_linear(
    df: DataFrame, columns: Sequence[str], key: str = "site_id", order: str = "hour_index", fallback: bool = True
) -> DataFrame:
    """Linear between the neighbours by ``order`` (one row per step), edges held, then the column median.

    The later neighbour comes from a scan in descending order: a frame that looks ahead without end
    would be evaluated anew for every row.
    """
    spot = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("at"), F.col(c).alias("value"))) for c in columns}
    earlier = scan(df, [key], [order], lasts={f"_p_{c}": spot[c] for c in columns})
    back = earlier.withColumn("_back", -F.col(order))
    both = scan(back, [key], ["_back"], lasts={f"_n_{c}": spot[c] for c in columns})

    def between(c: str) -> Column:
        left, right = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        step = F.try_divide(F.col(order) - left["at"], right["at"] - left["at"])
        inside = left["value"] + (right["value"] - left["value"]) * step
        return F.coalesce(F.col(c), inside, left["value"], right["value"])

    drawn = both.withColumns({c: between(c) for c in columns})
    drawn = drawn.drop("_back", *[f"_{side}_{c}" for side in "pn" for c in columns])
    if not fallback:
        return drawn
    medians = exact_quantiles(df, columns, [0.5])
    one_row = medians.agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(c) for c in columns])
    with_medians = drawn.withColumn("_medians", one_row.select(F.struct(*columns)).scalar())
    return with_medians.withColumns({c: F.coalesce(c, F.col("_medians")[c]) for c in columns}).drop("_medians")


# ---------------------------------------------------------------- smoothing

SAVGOL_WINDOW = 11
SAVGOL_POLY = 2


def savgol_weights(window: int = SAVGOL_WINDOW, poly: int = SAVGOL_POLY, deriv: int = 0) -> list[list[float]]:
    """Weights of the ``window`` values for every place in the window: the fitted polynomial, or a derivative of it."""
    half = window // 2
    at = np.arange(-half, half + 1, dtype=float)
    solve = np.linalg.pinv(np.vander(at, poly + 1, increasing=True))
    rows = []
    for place in at:
        basis = np.zeros(poly + 1)
        for power in range(deriv, poly + 1):
            scale = np.prod(np.arange(power, power - deriv, -1)) if deriv else 1.0
            basis[power] = scale * place ** (power - deriv)
        rows.append([float(x) for x in basis @ solve])
    return rows


def savgol(
    df: DataFrame,
    column: str,
    outputs: Mapping[str, int],
    key: str = "site_id",
    order: str = "hour_index",
    window: int = SAVGOL_WINDOW,
    poly: int = SAVGOL_POLY,
) -> DataFrame:
    """Savitzky-Golay smoothing: ``outputs`` maps a new column to the derivative it holds.

    Inner rows use the centered weights; the first and last rows are read off the polynomial fitted to
    the first and last ``window`` rows. A series shorter than the window, or a NULL inside it, gives NULL.
    """
    half = window // 2
    ordered = Window.partitionBy(key).orderBy(order)
    offsets = range(-2 * half, 2 * half + 1)
    near = F.array(*[F.lead(column, k).over(ordered) if k >= 0 else F.lag(column, -k).over(ordered) for k in offsets])
    located = df.withColumns(
        {"_near": near, "_i": F.row_number().over(ordered) - 1, "_rows": F.count(F.lit(1)).over(Window.partitionBy(key))}
    )
    last_center = F.col("_rows") - half - 1
    center = F.greatest(F.lit(half), F.least(F.col("_i"), last_center))
    # Place of the row inside its window, from -half to half; 0 for inner rows.
    located = located.withColumn("_place", (F.col("_i") - center).cast("int"))

    made: dict[str, Column] = {}
    for name, deriv in outputs.items():
        weights = savgol_weights(window, poly, deriv)
        inner = F.lit(0.0)
        for step, weight in zip(range(-half, half + 1), weights[half], strict=True):
            inner = inner + F.col("_near")[2 * half + step] * F.lit(weight)
        table = F.array(*[F.array(*[F.lit(w) for w in row]) for row in weights])
        values = F.slice(F.col("_near"), F.lit(half + 1) - F.col("_place"), F.lit(window))
        terms = F.zip_with(values, F.get(table, F.col("_place") + half), lambda v, w: v * w)
        edge = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
        fitted = F.when(F.col("_place") == 0, inner).otherwise(edge)
        made[name] = F.when(F.col("_rows") >= window, fitted)
    return located.withColumns(made).drop("_near", "_i", "_rows", "_place")


SMOOTHED = {"air": "air_temperature", "dew": "dew_temperature"}


def smooth_temperatures(df: DataFrame, key: str = "site_id", order: str = "hour_index") -> DataFrame:
    """Smoothed value, slope and curvature of air and dew temperature."""
    for short, column in SMOOTHED.items():
        df = savgol(df, column, {f"{short}_smooth": 0, f"{short}_diff": 1, f"{short}_diff2": 2}, key, order)
    return df


def shift_hours(df: DataFrame, offsets: Sequence[int] = hr.SITE_INDEX_SHIFT) -> DataFrame:
    """Hour index to local time; a site without a listed offset gets NULL."""
    return df.withColumn("hour_index", F.col("hour_index") + hr.site_offset(F.col("site_id"), offsets))


def shift_clock(df: DataFrame, offsets: Sequence[int] = hr.SITE_CLOCK_SHIFT, ts: str = "timestamp") -> DataFrame:
    """Timestamp minus the site's hours; sites outside the list keep their clock."""
    hours = F.coalesce(hr.site_offset(F.col("site_id"), offsets), F.lit(0))
    return df.withColumn(ts, F.col(ts) - F.make_dt_interval(hours=hours))


def clean_weather(
    df: DataFrame, measures: Sequence[str], start: int | None = None, end: int | None = None, offsets=hr.SITE_INDEX_SHIFT
) -> DataFrame:
    """Local hours, full grid, presence flags, interpolation, smoothed temperatures. Expects ``site_id, hour_index, measures``."""
    local = shift_hours(df.select("site_id", "hour_index", *measures), offsets)
    grid = presence_flags(hour_grid(local, start=start, end=end), measures)
    return smooth_temperatures(interpolate_linear(grid, measures))
