"""Ordered scans over keyed rows that stay parallel when one key owns a large share of the table.

A plain window sends all rows of a key to one task. Here a long key is cut along its scan order, at
the places of rows that a hash of key and place picks, about one in ``HOT_ROWS``. Each slice is scanned
on its own, and what the earlier slices hand over - a sum, a count, a last value, the length of an open
run - comes from a small table with one row per (key, slice). Keys that no cut falls into take the
plain window. Cuts follow from the rows alone: nothing is counted beforehand, both parts are one lazy
plan, and every reader sees the same slices.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
SLICE = "scan_slice"

Build = Callable[[DataFrame, "str | None"], DataFrame]


def match_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` in which NULL matches NULL; the key columns of ``left`` are kept."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for index, key in enumerate(keys):
        equal = F.col(key).eqNullSafe(F.col(f"_r_{key}"))
        condition = equal if index == 0 else condition & equal
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{key}" for key in keys])


def slice_of(keys: Sequence[str], at: Column) -> Column:
    """A slice: the key columns and the slice value in one struct.

    A struct is never NULL and its NULL fields compare equal, so windows, grouping and joins on it agree
    on one hash partitioning and the scanned rows are shuffled once.
    """
    return F.struct(*[F.col(k) for k in keys], at.alias("at"))


def split_hot(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Build,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Run ``build(rows, slice_by)`` on keys without a cut (``slice_by=None``) and on the slices of the others.

    ``order`` is the scan order, total within a key. The cuts are broadcast: one place for about every ``hot_rows``
    rows of the table, some 40 MB for 10^12 rows. A short key is rarely cut, and is as right in slices as without. Without
    any cut the part with slices is empty, and adaptive execution drops it.
    """
    picked = F.pmod(F.xxhash64(*[F.col(c) for c in (*keys, *order)]), F.lit(max(1, hot_rows))) == 0
    cuts = df.where(picked).groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct(*order))).alias("_cuts"))
    ordinary = build(match_null_safe(df, F.broadcast(cuts.select(*keys)), keys, "left_anti"), None)
    sliced_rows = match_null_safe(df, F.broadcast(_in_chunks(cuts)), keys, "inner")
    sliced_rows = sliced_rows.withColumn(SLICE, slice_of(keys, _cuts_upto(F.struct(*order)))).drop("_cuts", "_firsts").repartition(SLICE)
    return ordinary.unionByName(build(sliced_rows, SLICE).drop(SLICE))


#: Cuts of a key that are compared one by one; a longer list is entered by the first cut of each such chunk.
CHUNK = 256


def _in_chunks(cuts: DataFrame) -> DataFrame:
    chunks = F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / CHUNK).cast("int"))
    return cuts.withColumn("_firsts", F.transform(chunks, lambda i: F.get("_cuts", i * CHUNK)))


def _cuts_upto(place: Column) -> Column:
    """How many cuts lie at or before the place."""
    whole = F.greatest(F.size(F.filter("_firsts", lambda c: c <= place)) - 1, F.lit(0)) * CHUNK
    return whole + F.size(F.filter(F.slice("_cuts", whole + 1, F.lit(CHUNK)), lambda c: c <= place))


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: str | None = None,
    *,
    number: str | None = None,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    lags: Mapping[str, Column] | None = None,
    runs: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    mins: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running values along ``order`` (ascending, total within a key) for each key.

    ``slice_by`` names a column made by :func:`slice_of` for the same keys.

    ``number`` row number from 1; ``sums`` running sum; ``lasts`` latest non-NULL value up to and
    including the row; ``lags`` value of the row before; ``runs`` length of the run of rows, ending
    here, on which the condition holds (0 where it does not); ``totals`` sum over the whole key;
    ``mins`` smallest value of the whole key.
    """
    sums, lasts, lags, runs, totals, mins = (dict(x or {}) for x in (sums, lasts, lags, runs, totals, mins))
    part = [slice_by] if slice_by else list(keys)
    ordered = Window.partitionBy(*part).orderBy(*order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    position = F.row_number().over(ordered)
    local: dict[str, Column] = {}
    if number or runs or slice_by:
        local["_pos"] = position
    local |= {name: F.sum(c).over(so_far) for name, c in sums.items()}
    local |= {name: F.last(c, ignorenulls=True).over(so_far) for name, c in lasts.items()}
    local |= {name: F.lag(c).over(ordered) for name, c in lags.items()}
    local |= {name: F.sum(c).over(Window.partitionBy(*part)) for name, c in totals.items()}
    local |= {name: F.min(c).over(Window.partitionBy(*part)) for name, c in mins.items()}
    # NULL counts as "does not hold", so it breaks a run.
    broken = {name: F.coalesce(~c, F.lit(True)) for name, c in runs.items()}
    local |= {f"_cut_{name}": F.when(broken[name], F.lit(1)) for name in runs}
    out = df.withColumns(local)
    if runs:
        out = out.withColumns(
            {
                name: F.col("_pos")
                - F.coalesce(F.max(F.when(F.col(f"_cut_{name}") == 1, F.col("_pos"))).over(so_far), F.lit(0))
                for name in runs
            }
        )
    if slice_by:
        out = _add_carry(out, keys, order, slice_by, sums, lasts, lags, runs, totals, mins)
    named = {name: F.col(name).cast("bigint") for name in runs}
    if number:
        named[number] = F.col("_pos").cast("bigint")
    return out.withColumns(named).drop("_pos", *[f"_cut_{name}" for name in runs])


def _add_carry(
    local: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: str,
    sums: Mapping[str, Column],
    lasts: Mapping[str, Column],
    lags: Mapping[str, Column],
    runs: Mapping[str, Column],
    totals: Mapping[str, Column],
    mins: Mapping[str, Column],
) -> DataFrame:
    place = F.struct(*[F.col(c) for c in order])
    parts = [F.count(F.lit(1)).alias("_n")]
    parts += [F.sum(c).alias(f"_c_{name}") for name, c in sums.items()]
    parts += [F.max_by(c, F.when(c.isNotNull(), place)).alias(f"_c_{name}") for name, c in lasts.items()]
    parts += [F.max_by(F.struct(c.alias("v")), place).alias(f"_c_{name}") for name, c in lags.items()]
    parts += [F.max_by(F.col(name), place).alias(f"_c_{name}") for name in runs]
    parts += [F.sum(c).alias(f"_c_{name}") for name, c in totals.items()]
    parts += [F.min(c).alias(f"_c_{name}") for name, c in mins.items()]
    per_slice = local.groupBy(slice_by).agg(*parts)
    per_slice = per_slice.withColumns({k: F.col(slice_by)[k] for k in keys})

    before = Window.partitionBy(*keys).orderBy(slice_by)
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if runs:
        # An open run crosses a slice only when it covers the whole slice.
        per_slice = per_slice.withColumns(
            {
                f"_b_{name}": F.when(
                    F.col(f"_c_{name}") < F.col("_n"),
                    F.sum(f"_c_{name}").over(upto) - F.col(f"_c_{name}"),
                )
                for name in runs
            }
        )
    handed = [F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_h_pos")]
    handed += [F.sum(f"_c_{name}").over(earlier).alias(f"_h_{name}") for name in sums]
    handed += [F.last(f"_c_{name}", ignorenulls=True).over(earlier).alias(f"_h_{name}") for name in lasts]
    handed += [F.lag(f"_c_{name}").over(before)["v"].alias(f"_h_{name}") for name in lags]
    handed += [
        (
            F.coalesce(F.sum(f"_c_{name}").over(earlier), F.lit(0))
            - F.coalesce(F.last(f"_b_{name}", ignorenulls=True).over(earlier), F.lit(0))
        ).alias(f"_h_{name}")
        for name in runs
    ]
    handed += [F.sum(f"_c_{name}").over(Window.partitionBy(*keys)).alias(f"_h_{name}") for name in totals]
    handed += [F.min(f"_c_{name}").over(Window.partitionBy(*keys)).alias(f"_h_{name}") for name in mins]
    joined = local.join(per_slice.select(slice_by, *handed), slice_by, "left")
    merged: dict[str, Column] = {}
    for name in sums:
        merged[name] = F.coalesce(F.col(name) + F.col(f"_h_{name}"), F.col(name), F.col(f"_h_{name}"))
    for name in lasts:
        merged[name] = F.coalesce(F.col(name), F.col(f"_h_{name}"))
    for name in lags:
        merged[name] = F.when(F.col("_pos") == 1, F.col(f"_h_{name}")).otherwise(F.col(name))
    for name in runs:
        merged[name] = F.col(name) + F.when(F.col(name) == F.col("_pos"), F.col(f"_h_{name}")).otherwise(0)
    for name in (*totals, *mins):
        merged[name] = F.col(f"_h_{name}")
    merged["_pos"] = F.col("_pos") + F.col("_h_pos")
    return joined.withColumns(merged).drop("_h_pos", *[f"_h_{n}" for n in (*sums, *lasts, *lags, *runs, *totals, *mins)])
