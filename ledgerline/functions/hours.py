"""Clock, calendar and numeric expressions for hourly meter rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Origin of the hour index; hour offset of sites 0..15 (index shift, and timestamp shift).
HOUR_ORIGIN = "2016-01-01 00:00:00"
SITE_INDEX_SHIFT = (-5, 0, -7, -5, -8, 0, -5, -5, -5, -6, -7, -5, 0, -6, -5, -5)
SITE_CLOCK_SHIFT = (4, 0, 7, 4, 7, 0, 4, 4, 4, 5, 7, 4, 0, 5, 4, 4)

# Hours per cycle of the cyclic encodings.
CYCLES = {"hour": 24.0, "weekday": 7 * 24.0, "month": 30.4 * 24.0}

# Unit factors of site 0, meter 0 (on the way in, and back out).
SITE0_FACTOR_IN = 0.2931
SITE0_FACTOR_OUT = 3.4118


def hour_index(ts: Column, origin: str = HOUR_ORIGIN) -> Column:
    start = F.lit(origin).cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", start, ts.cast("timestamp_ntz")) / 3600).cast("bigint")


def site_offset(site: Column, offsets: Sequence[int]) -> Column:
    """Offset of a site from a short literal list; NULL for a site outside it."""
    listed = F.array(*[F.lit(int(x)) for x in offsets])
    return F.get(listed, site.cast("int"))


def calendar_parts(ts: Column) -> dict[str, Column]:
    """``weekday`` counts Monday as 0."""
    return {
        "hour": F.hour(ts),
        "weekday": F.weekday(ts),
        "day": F.dayofmonth(ts),
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "year": F.year(ts),
    }


def hour_index_parts(hour: Column) -> dict[str, Column]:
    day = F.floor(hour / 24)
    return {"tm_day_of_week": F.pmod(day, F.lit(7)).cast("int"), "tm_hour_of_day": F.pmod(hour, F.lit(24)).cast("int")}


def composite_key(*parts: Column) -> Column:
    return F.concat_ws("-", *[p.cast("string") for p in parts])


def cyclic(index: Column, cycles: Mapping[str, float] = CYCLES) -> dict[str, Column]:
    encoded = {}
    for name, period in cycles.items():
        angle = index * (2 * math.pi) / period
        encoded[f"{name}_x"] = F.cos(angle)
        encoded[f"{name}_y"] = F.sin(angle)
    return encoded


def log_target(y: Column, area: Column | None = None) -> Column:
    """``log1p(y)``, divided by ``log1p(area)`` when an area is given."""
    return F.log1p(y) if area is None else F.try_divide(F.log1p(y), F.log1p(area))


def invert_target(prediction: Column, area: Column | None = None) -> Column:
    return F.expm1(prediction if area is None else prediction * F.log1p(area))


def scale_where(value: Column, condition: Column, factor: float) -> Column:
    return F.when(condition, value * factor).otherwise(value)


def zero_below(value: Column) -> Column:
    """Negative values become 0, NULL stays NULL."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def rebase(value: Column, base: float) -> Column:
    return value - base


def generalized_mean(
    columns: Sequence[Column], weights: Sequence[float], p: float, c: float = 1.0, normalize: bool = True
) -> Column:
    """Weighted power mean times ``c``; ``p=0`` is the mean in ``log1p`` space. Weights are scaled to sum 1 unless told not to."""
    total = math.fsum(weights) if normalize else 1.0
    shares = [w / total for w in weights]
    lifted = [F.log1p(x) if p == 0 else F.pow(x, F.lit(float(p))) for x in columns]
    mixed = lifted[0] * shares[0]
    for column, share in zip(lifted[1:], shares[1:], strict=True):
        mixed = mixed + column * share
    return F.lit(float(c)) * (F.expm1(mixed) if p == 0 else F.pow(mixed, F.lit(1.0 / p)))
