"""Holiday calendars and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Calendar of each site that is not on the US calendar.
SITE_CALENDARS = {1: "england", 5: "england", 12: "ireland", 7: "canada", 11: "canada"}
DEFAULT_CALENDAR = "us"

# Fixed values: (month, day) holidays moved to the nearest weekday, and (month, weekday, nth) ones; -1 is the last.
US_FIXED = ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))
# First year of a holiday that is younger than the others.
US_SINCE = {(6, 19): 2021}
US_FLOATING = ((1, 0, 3), (2, 0, 3), (5, 0, -1), (9, 0, 1), (10, 0, 2), (11, 3, 4))


def _observed(day: date) -> date:
    """Saturday holidays are kept on Friday, Sunday ones on Monday."""
    return day + timedelta(days={5: -1, 6: 1}.get(day.weekday(), 0))


def _nth(year: int, month: int, weekday: int, nth: int) -> date:
    if nth > 0:
        first = date(year, month, 1)
        return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (nth - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)
    return last - timedelta(days=(last.weekday() - weekday) % 7)


def us_federal_holidays(first_year: int, last_year: int) -> list[date]:
    """Observed US federal holidays whose observed day falls in the given years, in date order."""
    days = set()
    for year in range(first_year, last_year + 2):
        days |= {_observed(date(year, m, d)) for m, d in US_FIXED if year >= US_SINCE.get((m, d), 0)} | {_nth(year, *rule) for rule in US_FLOATING}
    return sorted(d for d in days if first_year <= d.year <= last_year)


def easter(year: int) -> date:
    """Easter Sunday of the Gregorian calendar: the Sunday after the full moon on or after 21 March."""
    golden, century = year % 19, year // 100
    # Age of the moon on 1 January by the lunar calendar, with its century corrections.
    epact = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    moon = epact - (epact // 28) * (1 - (29 // (epact + 1)) * ((21 - golden) // 11))
    weekday = (year + year // 4 + moon + 2 - century + century // 4) % 7
    return date(year, 3, 28) + timedelta(days=moon - weekday)


@dataclass(frozen=True)
class Rules:
    """A country's holidays.

    ``fixed`` are (month, day), a weekend one also kept on the next free weekday; ``floating`` (month, weekday, nth; -1 is
    the last); ``easter`` days after Easter Sunday. ``since`` has the first year of a rule, ``before`` Mondays before a
    (month, day), ``moved`` years whose day of a rule is another one, ``extra`` single days.
    """

    fixed: tuple[tuple[int, int], ...]
    floating: tuple[tuple[int, int, int], ...]
    easter: tuple[int, ...]
    before: tuple[tuple[int, int], ...] = ()
    since: Mapping[tuple, int] = field(default_factory=dict)
    moved: Mapping[tuple, date] = field(default_factory=dict)
    extra: tuple[date, ...] = ()


# Public holidays of England, Ireland and Canada (Ontario).
COUNTRIES = {
    "england": Rules(
        fixed=((1, 1), (12, 25), (12, 26)),
        floating=((5, 0, 1), (5, 0, -1), (8, 0, -1)),
        easter=(-2, 1),
        since={(5, 0, 1): 1978, (5, 0, -1): 1971, (8, 0, -1): 1971, (1, 1): 1974},
        moved={
            (1995, (5, 0, 1)): date(1995, 5, 8), (2020, (5, 0, 1)): date(2020, 5, 8), (2002, (5, 0, -1)): date(2002, 6, 4),
            (2012, (5, 0, -1)): date(2012, 6, 4), (2022, (5, 0, -1)): date(2022, 6, 2),
        },
        extra=(date(1999, 12, 31), date(2002, 6, 3), date(2011, 4, 29), date(2012, 6, 5), date(2022, 6, 3), date(2022, 9, 19), date(2023, 5, 8)),
    ),
    "ireland": Rules(
        fixed=((1, 1), (3, 17), (12, 25), (12, 26)),
        floating=((2, 0, 1), (5, 0, 1), (6, 0, 1), (8, 0, 1), (10, 0, -1)),
        easter=(1,),
        since={(2, 0, 1): 2023, (5, 0, 1): 1994, (10, 0, -1): 1977},
        extra=(date(2022, 3, 18),),
    ),
    "canada": Rules(
        fixed=((1, 1), (7, 1), (12, 25), (12, 26)),
        floating=((2, 0, 3), (8, 0, 1), (9, 0, 1), (10, 0, 2)),
        easter=(-2,),
        before=((5, 25),),
        since={(2, 0, 3): 2008},
    ),
}


def country_holidays(country: str, first_year: int, last_year: int) -> list[date]:
    """Holidays and their substitute days that fall in the given years, in date order."""
    rules = COUNTRIES[country]
    days: set[date] = set()
    for year in range(first_year - 1, last_year + 1):
        holds = lambda rule, year=year: year >= rules.since.get(rule, 0)
        days |= {rules.moved.get((year, r), _nth(year, *r)) for r in rules.floating if holds(r)}
        days |= {easter(year) + timedelta(days=n) for n in rules.easter}
        for month, day in rules.before:
            last = date(year, month, day) - timedelta(days=1)
            days.add(last - timedelta(days=last.weekday()))
        days |= {d for d in rules.extra if d.year == year}
        fixed = [date(year, *r) for r in rules.fixed if holds(r)]
        days |= set(fixed)
        for day in fixed:
            if day.weekday() >= 5:
                while day.weekday() >= 5 or day in days:
                    day += timedelta(days=1)
                days.add(day)
    return sorted(d for d in days if first_year <= d.year <= last_year)


def all_calendars(first_year: int, last_year: int) -> dict[str, list[date]]:
    """The calendars of all sites over these years."""
    return {DEFAULT_CALENDAR: us_federal_holidays(first_year, last_year)} | {c: country_holidays(c, first_year, last_year) for c in COUNTRIES}


def holiday_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per calendar and day: calendar, year, day."""
    rows = [(name, d.year, d) for name, days in all_calendars(first_year, last_year).items() for d in days]
    return spark.createDataFrame(rows, "calendar string, year int, day date")


def holiday_flag(ts: Column, days: Sequence[date], legacy: bool = False) -> Column:
    """1 on a listed day; ``legacy`` flags its midnight row only. A few days a year: a literal list, no join."""
    listed = [F.lit(d) for d in days]
    hit = F.to_date(ts).isin(*listed)
    if legacy:
        hit = hit & (F.date_trunc("day", ts).cast("timestamp_ntz") == ts.cast("timestamp_ntz"))
    return F.coalesce(hit, F.lit(False)).cast("int")


def site_holiday_flag(
    site: Column,
    ts: Column,
    calendars: Mapping[str, Sequence[date]],
    sites: Mapping[int, str] = SITE_CALENDARS,
    default: str = DEFAULT_CALENDAR,
) -> Column:
    """Flag by the calendar of the row's site."""
    flag = holiday_flag(ts, calendars[default])
    for name, days in calendars.items():
        members = [s for s, calendar in sites.items() if calendar == name]
        if name != default and members:
            flag = F.when(site.isin(*members), holiday_flag(ts, days)).otherwise(flag)
    return flag
