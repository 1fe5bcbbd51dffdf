"""Meter readings, weather, encoders, folds, scores and blends."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks.helpers import rounded
from checks.registry import query
from checks.views_sql import extend, using
from ledgerline.functions import hours as hr
from ledgerline.operators import encoders, series, tables
from ledgerline.plans import meters
from ledgerline.sources import views
from ledgerline.sources.calendars import all_calendars, holiday_flag, holiday_table, site_holiday_flag, us_federal_holidays

ORIGIN = "2024-01-01 00:00:00"
KEY = ["building_id", "meter", "timestamp"]
KEYS = ", ".join(KEY)
W = views.WEATHER_MEASURES


def _hours(df):
    return df.withColumn("hour_index", hr.hour_index(F.col("timestamp"), ORIGIN))


def _metered(spark, sf):
    return _hours(views.readings(spark, sf)).join(views.buildings(spark, sf), "building_id", "left")


extend(
    "metered",
    """
metered AS (
  SELECT r.*, CAST(floor(epoch(r.timestamp - TIMESTAMP '2024-01-01') / 3600) AS BIGINT) AS hour_index, b.site_id, b.primary_use,
         b.square_feet, b.year_built, b.floor_count
  FROM readings r LEFT JOIN buildings b USING (building_id))""",
    ("readings", "buildings"),
)

# ---------------------------------------------------------------- clock and numbers


@query(
    "hour_index",
    using("metered", "SELECT building_id, meter, timestamp, hour_index + 70128 AS hour_index, CAST((((hour_index + 70128) // 24) % 7) AS INTEGER) AS tm_day_of_week, CAST((hour_index + 70128) % 24 AS INTEGER) AS tm_hour_of_day FROM metered"),
)
def hour_index(spark, sf):
    df = views.readings(spark, sf).withColumn("hour_index", hr.hour_index(F.col("timestamp")))
    return df.select(*KEY, "hour_index", *[c.alias(n) for n, c in hr.hour_index_parts(F.col("hour_index")).items()])


@query(
    "calendar_parts",
    using(
        "readings",
        """SELECT building_id, meter, timestamp, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(isodow(timestamp) - 1 AS INTEGER) AS weekday,
             CAST(day(timestamp) AS INTEGER) AS day, CAST(month(timestamp) AS INTEGER) AS month, CAST(quarter(timestamp) AS INTEGER) AS quarter,
             CAST(year(timestamp) AS INTEGER) AS year FROM readings""",
    ),
)
def calendar_parts(spark, sf):
    return views.readings(spark, sf).select(*KEY, *[c.alias(n) for n, c in hr.calendar_parts(F.col("timestamp")).items()])


_CASE_INDEX = "CASE site_id " + " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(hr.SITE_INDEX_SHIFT)) + " END"
_CASE_CLOCK = "CASE site_id " + " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(hr.SITE_CLOCK_SHIFT)) + " ELSE 0 END"


@query(
    "local_time_shift",
    using(
        "weather",
        f"""SELECT site_id, CAST(floor(epoch(timestamp - TIMESTAMP '2024-01-01') / 3600) AS BIGINT) + {_CASE_INDEX} AS hour_index,
              timestamp - INTERVAL 1 HOUR * ({_CASE_CLOCK}) AS timestamp FROM weather""",
    ),
)
def local_time_shift(spark, sf):
    df = _hours(views.weather(spark, sf)).select("site_id", "hour_index", "timestamp")
    return series.shift_clock(series.shift_hours(df))


@query(
    "composite_keys",
    using(
        "readings",
        """SELECT building_id, meter, timestamp, (isodow(timestamp) - 1) || '-' || hour(timestamp) AS weekday_hour,
             building_id || '-' || meter || '-' || (isodow(timestamp) - 1) || '-' || hour(timestamp) AS building_weekday_hour,
             building_id || '-' || meter || '-' || month(timestamp) AS building_month FROM readings""",
    ),
)
def composite_keys(spark, sf):
    part = hr.calendar_parts(F.col("timestamp"))
    b, m = F.col("building_id"), F.col("meter")
    return views.readings(spark, sf).select(
        *KEY,
        hr.composite_key(part["weekday"], part["hour"]).alias("weekday_hour"),
        hr.composite_key(b, m, part["weekday"], part["hour"]).alias("building_weekday_hour"),
        hr.composite_key(b, m, part["month"]).alias("building_month"),
    )


@query(
    "cyclic_encode",
    using(
        "metered",
        "SELECT building_id, meter, timestamp, "
        + ", ".join(
            f"round({fn}(2 * pi() * hour_index / {period}), 6) + 0.0 AS {name}_{axis}"
            for name, period in hr.CYCLES.items()
            for axis, fn in (("x", "cos"), ("y", "sin"))
        )
        + " FROM metered",
    ),
)
def cyclic_encode(spark, sf):
    df = _hours(views.readings(spark, sf))
    return rounded(df.select(*KEY, *[c.alias(n) for n, c in hr.cyclic(F.col("hour_index")).items()]), 6)


_US_DAYS = "DATE '2024-01-01', DATE '2024-01-15'"


@query(
    "holiday_flag",
    using(
        "readings",
        f"""SELECT building_id, meter, timestamp, CAST(CAST(timestamp AS DATE) IN ({_US_DAYS}) AS INTEGER) AS is_holiday,
              CAST(CAST(timestamp AS DATE) IN ({_US_DAYS}) AND hour(timestamp) = 0 AS INTEGER) AS is_holiday_legacy FROM readings""",
    ),
)
def holiday(spark, sf):
    days = us_federal_holidays(2023, 2024)
    ts = F.col("timestamp")
    return views.readings(spark, sf).select(
        *KEY,
        holiday_flag(ts, days).alias("is_holiday"),
        holiday_flag(ts, days, legacy=True).alias("is_holiday_legacy"),
    )


@query(
    "holiday_orders",
    using(
        "ledger",
        """WITH years AS (SELECT unnest(generate_series(1990, 2030)) AS y),
           fixed AS (SELECT make_date(CAST(y AS INTEGER), m, d) AS day FROM years, (VALUES (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) f(m, d) WHERE m <> 6 OR y >= 2021),
           observed AS (SELECT CASE isodow(day) WHEN 6 THEN day - 1 WHEN 7 THEN day + 1 ELSE day END AS day FROM fixed),
           firsts AS (SELECT make_date(CAST(y AS INTEGER), m, 1) AS f, w, n FROM years, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) f(m, w, n)),
           nth AS (SELECT CAST(f + ((w - isodow(f) + 7) % 7 + 7 * (n - 1)) * INTERVAL 1 DAY AS DATE) AS day FROM firsts),
           lasts AS (SELECT CAST(make_date(CAST(y AS INTEGER), 5, 31) - (isodow(make_date(CAST(y AS INTEGER), 5, 31)) - 1) * INTERVAL 1 DAY AS DATE) AS day FROM years),
           days AS (SELECT day FROM observed UNION SELECT day FROM nth UNION SELECT day FROM lasts),
           o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + INTERVAL 25 YEAR AS day FROM orders)
           SELECT o_orderkey, CAST(CAST(o.day AS DATE) IN (SELECT day FROM days) AS INTEGER) AS is_holiday FROM o""",
    ),
)
def holiday_orders(spark, sf):
    """Order dates moved 25 years on, flagged by the calendar of the years that occur, 19 June among them."""
    orders = views.table(spark, sf, "orders").select("o_orderkey", F.add_months(F.to_date("o_orderdate"), 300).alias("day"))
    first, last = orders.agg(F.min(F.year("day")), F.max(F.year("day"))).first()
    return orders.select("o_orderkey", holiday_flag(F.col("day").cast("timestamp_ntz"), us_federal_holidays(first, last)).alias("is_holiday"))


_CALENDARS = """
years AS (SELECT CAST(unnest(generate_series(1990, 2035)) AS INTEGER) AS y),
moons AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
moons2 AS (SELECT y, a, b, c, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM moons),
moons3 AS (SELECT y, a, h, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM moons2),
moons4 AS (SELECT y, h, l, (a + 11 * h + 22 * l) // 451 AS m FROM moons3),
sundays AS (SELECT y, make_date(y, CAST((h + l - 7 * m + 114) // 31 AS INTEGER), CAST((h + l - 7 * m + 114) % 31 + 1 AS INTEGER)) AS easter FROM moons4),
around AS (SELECT 'england' AS calendar, easter - 2 AS day FROM sundays UNION ALL SELECT 'england', easter + 1 FROM sundays
  UNION ALL SELECT 'ireland', easter + 1 FROM sundays UNION ALL SELECT 'canada', easter - 2 FROM sundays),
mondays AS (
  SELECT calendar, y, m, n, CASE WHEN n > 0 THEN CAST(f + ((8 - isodow(f)) % 7 + 7 * (n - 1)) * INTERVAL 1 DAY AS DATE)
    ELSE CAST(last_day(f) - (isodow(last_day(f)) - 1) * INTERVAL 1 DAY AS DATE) END AS day
  FROM (SELECT calendar, y, m, n, make_date(y, m, 1) AS f FROM years, (VALUES ('england', 5, 1, 1978), ('england', 5, -1, 0), ('england', 8, -1, 0),
    ('ireland', 2, 1, 2023), ('ireland', 5, 1, 1994), ('ireland', 6, 1, 0), ('ireland', 8, 1, 0), ('ireland', 10, -1, 0),
    ('canada', 2, 3, 2008), ('canada', 8, 1, 0), ('canada', 9, 1, 0), ('canada', 10, 2, 0)) r(calendar, m, n, since) WHERE y >= since)),
kept AS (SELECT calendar, day FROM mondays WHERE NOT (calendar = 'england' AND (y, m, n) IN ((1995, 5, 1), (2020, 5, 1), (2002, 5, -1), (2012, 5, -1), (2022, 5, -1)))),
single AS (SELECT 'england' AS calendar, unnest([DATE '1995-05-08', DATE '2020-05-08', DATE '2002-06-04', DATE '2012-06-04', DATE '2022-06-02', DATE '1999-12-31', DATE '2002-06-03',
    DATE '2011-04-29', DATE '2012-06-05', DATE '2022-06-03', DATE '2022-09-19', DATE '2023-05-08']) AS day UNION ALL SELECT 'ireland', DATE '2022-03-18'
  UNION ALL SELECT 'canada', CAST(make_date(y, 5, 24) - (isodow(make_date(y, 5, 24)) - 1) * INTERVAL 1 DAY AS DATE) FROM years),
yearly AS (SELECT calendar, make_date(y, m, d) AS day FROM years, (VALUES ('england', 1, 1), ('ireland', 1, 1), ('canada', 1, 1), ('ireland', 3, 17), ('canada', 7, 1)) r(calendar, m, d)),
christmas AS (SELECT calendar, make_date(y, 12, 25) AS day FROM years, (VALUES ('england'), ('ireland'), ('canada')) r(calendar)),
abroad AS (
  SELECT calendar, day FROM around UNION SELECT calendar, day FROM kept UNION SELECT calendar, day FROM single UNION SELECT calendar, day FROM yearly
  UNION SELECT calendar, CASE isodow(day) WHEN 6 THEN day + 2 WHEN 7 THEN day + 1 ELSE day END FROM yearly
  UNION SELECT calendar, day + k FROM christmas, (VALUES (0), (1)) v(k)
  UNION SELECT calendar, day + 2 FROM christmas WHERE isodow(day) IN (6, 7) UNION SELECT calendar, day + 3 FROM christmas WHERE isodow(day) IN (5, 6))"""


@query(
    "site_holiday_flag",
    using(
        "ledger",
        "WITH "
        + _CALENDARS
        + """,
           home AS (SELECT make_date(y, m, d) AS day FROM years, (VALUES (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) f(m, d) WHERE m <> 6 OR y >= 2021),
           firsts AS (SELECT make_date(y, m, 1) AS f, w, n FROM years, (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) f(m, w, n)),
           us AS (SELECT CASE isodow(day) WHEN 6 THEN day - 1 WHEN 7 THEN day + 1 ELSE day END AS day FROM home
                  UNION SELECT CAST(f + ((w - isodow(f) + 7) % 7 + 7 * (n - 1)) * INTERVAL 1 DAY AS DATE) FROM firsts
                  UNION SELECT CAST(make_date(y, 5, 31) - (isodow(make_date(y, 5, 31)) - 1) * INTERVAL 1 DAY AS DATE) FROM years),
           every AS (SELECT calendar, day FROM abroad UNION ALL SELECT 'us', day FROM us),
           o AS (SELECT o_orderkey, CAST(o_custkey % 16 AS INTEGER) AS site_id, CAST(CAST(o_orderdate AS DATE) + INTERVAL 25 YEAR AS DATE) AS day FROM orders),
           placed AS (SELECT *, CASE WHEN site_id IN (1, 5) THEN 'england' WHEN site_id = 12 THEN 'ireland' WHEN site_id IN (7, 11) THEN 'canada' ELSE 'us' END AS calendar FROM o)
           SELECT o_orderkey, site_id, CAST((calendar, day) IN (SELECT (calendar, day) FROM every) AS INTEGER) AS is_holiday FROM placed""",
    ),
)
def site_holidays(spark, sf):
    """Order dates moved 25 years on, by the calendar of a site; the years are those that occur."""
    day = F.add_months(F.to_date("o_orderdate"), 300)
    orders = views.table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 16).cast("int").alias("site_id"), day.alias("day"))
    first, last = orders.agg(F.min(F.year("day")), F.max(F.year("day"))).first()
    flag = site_holiday_flag(F.col("site_id"), F.col("day").cast("timestamp_ntz"), all_calendars(first, last))
    return orders.select("o_orderkey", "site_id", flag.alias("is_holiday"))


@query(
    "holiday_table",
    using("ledger", "WITH " + _CALENDARS + """, s AS (SELECT year(min(o_orderdate)) + 25 AS a, year(max(o_orderdate)) + 25 AS z FROM orders)
      SELECT calendar, CAST(year(day) AS INTEGER) AS year, CAST(day AS DATE) AS day FROM abroad, s WHERE year(day) BETWEEN a AND z"""),
)
def holidays_abroad(spark, sf):
    """The calendars beside the home one, over the years of the orders."""
    years = views.table(spark, sf, "orders").select((F.year("o_orderdate") + 25).alias("y"))
    return holiday_table(spark, *years.agg(F.min("y"), F.max("y")).first()).where("calendar <> 'us'")


@query(
    "log_target",
    using(
        "metered",
        """SELECT building_id, meter, timestamp, round(ln(1 + meter_reading), 6) AS y, round(ln(1 + meter_reading) / ln(1 + square_feet), 6) AS y_per_area,
             round(meter_reading, 4) AS back FROM metered""",
    ),
)
def log_target(spark, sf):
    y, area = F.col("meter_reading"), F.col("square_feet")
    df = _metered(spark, sf).select(
        *KEY,
        F.round(hr.log_target(y), 6).alias("y"),
        F.round(hr.log_target(y, area), 6).alias("y_per_area"),
        F.round(hr.invert_target(hr.log_target(y, area), area), 4).alias("back"),
    )
    return rounded(df, 6)


@query(
    "unit_correction",
    using(
        "metered",
        """SELECT building_id, meter, timestamp, round(CASE WHEN site_id = 0 AND meter = 0 THEN meter_reading * 0.2931 ELSE meter_reading END, 6) AS reading_in,
             round(CASE WHEN site_id = 0 AND meter = 0 THEN meter_reading * 3.4118 ELSE meter_reading END, 6) AS reading_out FROM metered""",
    ),
)
def unit_correction(spark, sf):
    site0 = (F.col("site_id") == 0) & (F.col("meter") == 0)
    y = F.col("meter_reading")
    df = _metered(spark, sf).select(
        *KEY,
        hr.scale_where(y, site0, hr.SITE0_FACTOR_IN).alias("reading_in"),
        hr.scale_where(y, site0, hr.SITE0_FACTOR_OUT).alias("reading_out"),
    )
    return rounded(df, 6)


@query(
    "clip_negative",
    using("predictions", "SELECT row_id, round(CASE WHEN pred1 < 0 THEN 0 ELSE pred1 END, 4) AS pred1 FROM predictions"),
)
def clip_negative(spark, sf):
    return rounded(views.predictions(spark, sf).select("row_id", hr.zero_below(F.col("pred1")).alias("pred1")))


@query(
    "fill_sentinel",
    using("buildings", "SELECT building_id, coalesce(year_built, -1) AS year_built, coalesce(floor_count, -1) AS floor_count FROM buildings"),
)
def fill_sentinel(spark, sf):
    return series.fill_sentinel(views.buildings(spark, sf).select("building_id", "year_built", "floor_count"))


@query(
    "fill_below_min",
    using(
        "weather",
        """SELECT site_id, timestamp, round(coalesce(sea_level_pressure, (SELECT min(sea_level_pressure) FROM weather) - 1), 6) AS sea_level_pressure,
             round(coalesce(wind_speed, (SELECT min(wind_speed) FROM weather) - 1), 6) AS wind_speed FROM weather""",
    ),
)
def fill_below_min(spark, sf):
    columns = ["sea_level_pressure", "wind_speed"]
    df = views.weather(spark, sf).select("site_id", "timestamp", *columns)
    return rounded(series.fill_below_min(df, columns), 6)


@query("presence_flags", using("weather", "SELECT site_id, timestamp, " + ", ".join(f"{c} IS NOT NULL AS had_{c}" for c in W) + " FROM weather"))
def presence_flags(spark, sf):
    df = series.presence_flags(views.weather(spark, sf), W)
    return df.select("site_id", "timestamp", *[f"had_{c}" for c in W])


_PROFILED = ["building_id", "meter", "hour_index", "meter_reading", "square_feet", "year_built"]
_RANGE = "min(CAST({c} AS DOUBLE)) AS low, max(CAST({c} AS DOUBLE)) AS high, coalesce(bool_and({c} = floor({c})), FALSE) AS whole, count(*) - count({c}) AS nulls"


@query(
    "profile_types",
    using(
        "metered",
        "SELECT \"column\", low, high, whole, nulls, CASE WHEN NOT whole AND low > -3.4028234663852886e38 AND high < 3.4028234663852886e38 THEN 'float' WHEN NOT whole THEN 'double' WHEN low > -128 AND high < 127 THEN 'tinyint'"
        " WHEN low > -32768 AND high < 32767 THEN 'smallint' WHEN low > -2147483648 AND high < 2147483647 THEN 'int' ELSE 'bigint' END AS type FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_RANGE.format(c=c)} FROM metered" for c in _PROFILED)
        + ")",
    ),
)
def profile_types(spark, sf):
    return tables.profile_types(_metered(spark, sf), _PROFILED)


@query("narrow", using("metered", "SELECT building_id, meter, timestamp, CAST(square_feet AS INTEGER) AS area, CAST(hour_index AS INTEGER) AS hours FROM metered"))
def narrow(spark, sf):
    df = tables.narrow(_metered(spark, sf), ["square_feet", "hour_index"])
    return df.select(*KEY, F.col("square_feet").cast("int").alias("area"), F.col("hour_index").cast("int").alias("hours"))


@query("rebase", using("buildings", "SELECT building_id, year_built - 1900 AS year_built FROM buildings"))
def rebase(spark, sf):
    return views.buildings(spark, sf).select("building_id", hr.rebase(F.col("year_built"), 1900).alias("year_built"))


# ---------------------------------------------------------------- row rules


@query(
    "drop_known_bad",
    using(
        "metered",
        """SELECT building_id, meter, timestamp, meter_reading FROM metered WHERE NOT (building_id = 5
             OR (building_id <= 3 AND meter = 0 AND timestamp <= TIMESTAMP '2024-01-10') OR (building_id IN (7, 8) AND meter_reading = 0))""",
    ),
)
def drop_known_bad(spark, sf):
    rules = series.known_bad_rules(5, 3, "2024-01-10", (7, 8))
    return series.drop_rows(views.readings(spark, sf), *rules)


@query(
    "drop_site_warmup",
    using("metered", "SELECT building_id, meter, timestamp FROM metered WHERE NOT coalesce(hour_index < 300 AND site_id = 0 AND meter = 0, FALSE)"),
)
def drop_site_warmup(spark, sf):
    return series.drop_rows(_metered(spark, sf), series.warmup_rule(300)).select(*KEY)


@query(
    "drop_extreme",
    using("metered", "SELECT building_id, meter, timestamp FROM metered WHERE NOT (building_id = 6 AND meter = 2 AND meter_reading > 100)"),
)
def drop_extreme(spark, sf):
    return series.drop_rows(_metered(spark, sf), series.extreme_rule(6, 100.0)).select(*KEY)


extend(
    "bad_zero",
    """
zero_change AS (
  SELECT *, CASE WHEN lag(meter_reading = 0) OVER w IS NOT DISTINCT FROM (meter_reading = 0) THEN 0 ELSE 1 END AS changed
  FROM metered WINDOW w AS (PARTITION BY building_id, meter ORDER BY timestamp)),
zero_runs AS (SELECT *, sum(changed) OVER (PARTITION BY building_id, meter ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS run_id FROM zero_change),
run_sizes AS (
  SELECT *, count(*) OVER r AS run_rows, max(CASE WHEN meter_reading = 0 AND (hour_index < 200 OR hour_index > 500) THEN 1 ELSE 0 END) OVER r AS off_season,
    max(CASE WHEN meter_reading = 0 AND hour_index = 0 THEN run_id END) OVER k AS at0, max(CASE WHEN meter_reading = 0 AND hour_index = 10 THEN run_id END) OVER k AS at1,
    max(CASE WHEN meter_reading = 0 AND hour_index = 700 THEN run_id END) OVER k AS at2, max(CASE WHEN meter_reading = 0 AND hour_index = 719 THEN run_id END) OVER k AS at3
  FROM zero_runs WINDOW r AS (PARTITION BY building_id, meter, run_id), k AS (PARTITION BY building_id, meter)),
bad_zero AS (
  SELECT *, meter_reading = 0 AND CASE WHEN meter = 0 THEN TRUE WHEN meter IN (2, 3) THEN run_rows >= 2 AND off_season = 1
      ELSE run_rows >= 2 AND NOT coalesce(at0 = at1 AND at2 = at3 AND (run_id = at0 OR run_id = at2), FALSE) END AS is_bad_zero FROM run_sizes)""",
    ("metered",),
)
ZERO_RULES = {"min_interval": 2, "summer": (200, 500), "year_ends": (0, 10, 700, 719)}


@query("bad_zero_flag", using("bad_zero", "SELECT building_id, meter, timestamp, is_bad_zero FROM bad_zero"))
def bad_zero_flag(spark, sf):
    flagged = series.by_series(_metered(spark, sf), lambda rows, s: series.bad_zero_flag(rows, **ZERO_RULES, slice_by=s))
    return flagged.select(*KEY, "is_bad_zero")


@query(
    "drop_bad_rows",
    using(
        "bad_zero",
        """SELECT building_id, meter, timestamp, meter_reading FROM bad_zero WHERE NOT (is_bad_zero OR coalesce(hour_index < 300 AND site_id = 0 AND meter = 0, FALSE)
             OR (building_id = 6 AND meter = 2 AND meter_reading > 100))""",
    ),
)
def drop_bad_rows(spark, sf):
    flagged = series.by_series(_metered(spark, sf), lambda rows, s: series.bad_zero_flag(rows, **ZERO_RULES, slice_by=s))
    kept = series.drop_rows(flagged, F.col("is_bad_zero"), series.warmup_rule(300), series.extreme_rule(6, 100.0))
    return kept.select(*KEY, "meter_reading")


extend(
    "streaks",
    """
streak_groups AS (SELECT *, sum(CASE WHEN meter_reading = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY building_id, meter ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS g FROM readings),
streaks AS (
  SELECT building_id, meter, timestamp, meter_reading,
    CAST(CASE WHEN meter_reading = 0 THEN sum(CASE WHEN meter_reading = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY building_id, meter, g ORDER BY timestamp ROWS UNBOUNDED PRECEDING)
         ELSE 0 END AS BIGINT) AS zero_streak FROM streak_groups)""",
    ("readings",),
)


@query("zero_streak", using("streaks", "SELECT * FROM streaks"))
def zero_streak(spark, sf):
    return series.by_series(views.readings(spark, sf), series.zero_streak)


@query("drop_long_zero_runs", using("streaks", "SELECT * FROM streaks WHERE zero_streak < 2"))
def drop_long_zero_runs(spark, sf):
    return series.drop_long_zero_runs(series.by_series(views.readings(spark, sf), series.zero_streak), 2)


@query("run_ids", using("bad_zero", "SELECT building_id, meter, timestamp, CAST(run_id AS BIGINT) AS run_id FROM zero_runs"))
def run_ids(spark, sf):
    numbered = series.by_series(
        views.readings(spark, sf), lambda rows, s: series.run_ids(rows, F.col("meter_reading") == 0, s)
    )
    return numbered.select(*KEY, "run_id")


@query(
    "constant_runs",
    using(
        "readings",
        """WITH stepped AS (SELECT *, CASE WHEN lag(floor(meter_reading / 40)) OVER w IS NOT DISTINCT FROM floor(meter_reading / 40) THEN 0 ELSE 1 END AS changed
              FROM readings WINDOW w AS (PARTITION BY building_id, meter ORDER BY timestamp)),
           numbered AS (SELECT *, sum(changed) OVER (PARTITION BY building_id, meter ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS g FROM stepped)
           SELECT building_id, meter, timestamp, floor(meter_reading / 40) AS meter_reading,
             count(*) OVER (PARTITION BY building_id, meter, g) - 1 > 2 AND timestamp > min(timestamp) OVER (PARTITION BY building_id, meter, g) AS is_constant
           FROM numbered""",
    ),
)
def constant_runs(spark, sf):
    """Readings are coarsened to steps of 40, so runs of equal values occur."""
    coarse = views.readings(spark, sf).withColumn("meter_reading", F.floor(F.col("meter_reading") / 40).cast("double"))
    return series.by_series(coarse, lambda rows, s: series.constant_runs(rows, 2, s))


@query(
    "reference_rows",
    using(
        "predictions",
        """SELECT building_id, meter, timestamp, round(CASE WHEN coalesce(meter_reading, 0) < 0 THEN 0 ELSE coalesce(meter_reading, 0) END, 4) + 0.0 AS meter_reading
           FROM reference WHERE year(timestamp) BETWEEN 2023 AND 2024 AND building_id <> 4""",
    ),
)
def reference_rows(spark, sf):
    return rounded(series.reference_rows(views.reference_readings(spark, sf), 2023, 2024, 4))


@query(
    "dedupe",
    """SELECT user_id, ts_hour, event_id, event_type FROM (
         SELECT user_id, date_trunc('hour', ts) AS ts_hour, event_id, event_type,
           row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS k FROM events) WHERE k = 1""",
)
def dedupe(spark, sf):
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("ts_hour")
    events = views.table(spark, sf, "events").select("user_id", hour, "ts", "event_id", "event_type")
    return series.dedupe(events, ["user_id", "ts_hour"], ["ts", "event_id"]).drop("ts")


@query(
    "date_window",
    using("ledger", "SELECT loan_id, installment_num, snapshot_date FROM ledger WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'"),
)
def date_window(spark, sf):
    df = tables.date_window(views.ledger(spark, sf), "snapshot_date", date(1997, 1, 1), date(1997, 6, 30))
    return df.select("loan_id", "installment_num", "snapshot_date")


# ---------------------------------------------------------------- joins


@query(
    "combine_readings",
    using(
        "metered weather",
        """SELECT m.building_id, m.meter, m.timestamp, m.meter_reading, m.site_id, m.primary_use, round(w.air_temperature, 6) AS air_temperature,
             w.dew_temperature, w.wind_speed FROM metered m LEFT JOIN weather w ON w.site_id = m.site_id AND w.timestamp = m.timestamp""",
    ),
)
def combine_readings(spark, sf):
    df = tables.combine_readings(views.readings(spark, sf), views.buildings(spark, sf), views.weather(spark, sf))
    df = df.select(*KEY, "meter_reading", "site_id", "primary_use", "air_temperature", "dew_temperature", "wind_speed")
    return rounded(df, 6, ["air_temperature"])


@query(
    "attach_reference",
    using(
        "predictions buildings",
        """SELECT r.building_id, r.meter, r.timestamp, round(r.meter_reading, 4) + 0.0 AS meter_reading, p.row_id, round(p.pred0, 4) + 0.0 AS pred0, b.site_id
           FROM reference r LEFT JOIN predictions p USING (building_id, meter, timestamp) LEFT JOIN buildings b USING (building_id)""",
    ),
)
def attach_reference(spark, sf):
    predicted = views.predictions(spark, sf).select(*KEY, "row_id", "pred0")
    return rounded(tables.attach_reference(views.reference_readings(spark, sf), predicted, views.buildings(spark, sf)))


@query(
    "override_with_reference",
    using(
        "predictions",
        """SELECT k.row_id, round(coalesce(r.meter_reading, k.pred0), 4) + 0.0 AS meter_reading FROM predictions k
           LEFT JOIN (SELECT x.row_id, f.meter_reading FROM reference f JOIN keyed x USING (building_id, meter, timestamp)) r USING (row_id)""",
    ),
)
def override_with_reference(spark, sf):
    predicted = views.predictions(spark, sf).select("row_id", F.col("pred0").alias("meter_reading"))
    return rounded(tables.override_with_reference(predicted, views.row_ids(views.reference_readings(spark, sf))))


@query(
    "map_counts",
    using(
        "buildings readings",
        """SELECT b.building_id, (SELECT count(*) FROM buildings x WHERE x.year_built = b.year_built) AS year_n, r.n AS bid_cnt,
             CASE WHEN b.year_built IS NOT NULL THEN y.n END AS year_cnt
           FROM buildings b LEFT JOIN (SELECT building_id, count(*) AS n FROM readings WHERE timestamp < TIMESTAMP '2024-01-03' GROUP BY 1) r USING (building_id)
           LEFT JOIN (SELECT year_built, count(*) AS n FROM buildings GROUP BY 1) y ON y.year_built = b.year_built""".replace(
            "(SELECT count(*) FROM buildings x WHERE x.year_built = b.year_built) AS year_n, ", ""
        ),
    ),
)
def map_counts(spark, sf):
    sites = views.buildings(spark, sf)
    fitted = views.readings(spark, sf).where(F.col("timestamp") < F.lit("2024-01-03").cast("timestamp_ntz"))
    counted = tables.map_counts(tables.map_counts(sites, sites, "year_built", "year_cnt"), fitted, "building_id", "bid_cnt")
    return counted.select("building_id", "year_cnt", "bid_cnt")


# ---------------------------------------------------------------- weather

_GRID = f"""
hourly AS (SELECT site_id, CAST(floor(epoch(timestamp - TIMESTAMP '2024-01-01') / 3600) AS BIGINT) AS hour_index, {", ".join(W)} FROM weather),
shifted AS (SELECT * REPLACE (hour_index + {_CASE_INDEX} AS hour_index) FROM hourly),
"""


def _grid_of(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT s.site_id, h.hour_index, {", ".join("x." + c for c in W)}
  FROM (SELECT DISTINCT site_id FROM {source}) s
  CROSS JOIN (SELECT CAST(unnest(range((SELECT min(hour_index) FROM {source}), (SELECT max(hour_index) FROM {source}) + 1)) AS BIGINT) AS hour_index) h
  LEFT JOIN {source} x ON x.site_id = s.site_id AND x.hour_index = h.hour_index)"""


extend("grid", _GRID + _grid_of("hourly", "grid") + ",\n" + _grid_of("shifted", "local_grid"), ("weather",))


def _interpolated(source: str, name: str) -> str:
    def near(c):
        return f"""last_value(CASE WHEN {c} IS NOT NULL THEN hour_index END IGNORE NULLS) OVER b AS pa_{c}, last_value({c} IGNORE NULLS) OVER b AS pv_{c},
        first_value(CASE WHEN {c} IS NOT NULL THEN hour_index END IGNORE NULLS) OVER f AS na_{c}, first_value({c} IGNORE NULLS) OVER f AS nv_{c}"""

    def fill(c):
        return f"""coalesce({c}, pv_{c} + (nv_{c} - pv_{c}) * (CAST(hour_index - pa_{c} AS DOUBLE) / nullif(na_{c} - pa_{c}, 0)), pv_{c}, nv_{c},
          (SELECT quantile_cont({c}, 0.5) FROM weather)) AS {c}"""

    return f"""
near_{name} AS (SELECT *, {", ".join(near(c) for c in W)} FROM {source}
  WINDOW b AS (PARTITION BY site_id ORDER BY hour_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY site_id ORDER BY hour_index ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{name} AS (SELECT site_id, hour_index, {", ".join(fill(c) for c in W)}, {", ".join(f"{c} IS NOT NULL AS had_{c}" for c in W)} FROM near_{name})"""


extend("filled", _interpolated("grid", "filled"), ("grid",))
extend("local_filled", _interpolated("local_grid", "local_filled"), ("grid",))


def _smoothed(source: str, name: str) -> str:
    weights = [series.savgol_weights(deriv=d) for d in range(3)]
    values = ", ".join(
        f"({place - 5}, {step - 5}, {weights[0][place][step]!r}::DOUBLE, {weights[1][place][step]!r}::DOUBLE, {weights[2][place][step]!r}::DOUBLE)"
        for place in range(11)
        for step in range(11)
    )
    outs = ", ".join(
        f"sum(n.{column} * w.w{d}) AS {short}_{kind}"
        for short, column in series.SMOOTHED.items()
        for d, kind in enumerate(("smooth", "diff", "diff2"))
    )
    return f"""
weights_{name}(place, step, w0, w1, w2) AS (VALUES {values}),
placed_{name} AS (SELECT *, i - greatest(5, least(i, n - 6)) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY hour_index) - 1 AS i, count(*) OVER (PARTITION BY site_id) AS n FROM {source})),
{name} AS (
  SELECT p.site_id, p.hour_index, {outs} FROM placed_{name} p JOIN weights_{name} w ON w.place = p.place
  JOIN placed_{name} n ON n.site_id = p.site_id AND n.i = p.i - p.place + w.step GROUP BY 1, 2)"""


extend("smooth", _smoothed("filled", "smooth"), ("filled",))
extend("local_smooth", _smoothed("local_filled", "local_smooth"), ("local_filled",))
SMOOTH = ["air_smooth", "air_diff", "air_diff2", "dew_smooth", "dew_diff", "dew_diff2"]


def _hourly(spark, sf):
    return _hours(views.weather(spark, sf)).select("site_id", "hour_index", *W)


@query("hour_grid", using("grid", f"SELECT site_id, hour_index, {', '.join(f'round({c} + 1.3e-7, 5) AS {c}' for c in W)} FROM grid"))
def hour_grid(spark, sf):
    return rounded(series.hour_grid(_hourly(spark, sf)), 5)


extend(
    "day_grid",
    f"\nday_grid AS (SELECT *, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * hour_index AS timestamp, CAST(day(TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * hour_index) AS INTEGER) AS d,"
    f" CAST(month(TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * hour_index) AS INTEGER) AS mo FROM grid),"
    f"\nday_means AS (SELECT site_id, d, mo, {', '.join(f'avg({c}) AS {c}' for c in W)} FROM day_grid GROUP BY 1, 2, 3)",
    ("grid",),
)


def _day_grid(spark, sf):
    grid = series.hour_grid(_hourly(spark, sf))
    return grid.withColumn("timestamp", F.lit(ORIGIN).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour_index").cast("int")))


def _filled_sql(source: str) -> str:
    return (
        f"SELECT g.site_id, g.hour_index, {', '.join(f'round(coalesce(g.{c}, m.{c}) + 1.3e-7, 5) AS {c}' for c in W)} FROM day_grid g"
        f" LEFT JOIN {source} m ON m.site_id = g.site_id AND m.d = g.d AND m.mo = g.mo"
    )


@query(
    "group_means",
    using("day_grid", f"SELECT site_id, d AS day, mo AS month, {', '.join(f'round({c} + 1.3e-7, 5) AS {c}' for c in W)} FROM day_means"),
)
def group_means(spark, sf):
    grid = _day_grid(spark, sf).withColumns({"day": F.dayofmonth("timestamp"), "month": F.month("timestamp")})
    return rounded(series.group_means(grid, ["site_id", "day", "month"], W), 5)


@query("fill_group_mean", using("day_grid", _filled_sql("day_means")))
def fill_group_mean(spark, sf):
    return rounded(series.fill_group_mean(_day_grid(spark, sf), W).drop("timestamp"), 5)


_FFILL = "(SELECT site_id, d, mo, " + ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in W) + " FROM day_means WINDOW w AS ({part}ORDER BY {order} ROWS UNBOUNDED PRECEDING))"


@query("fill_group_mean_ffill", using("day_grid", _filled_sql(_FFILL.format(part="PARTITION BY site_id ", order="d, mo"))))
def fill_group_mean_ffill(spark, sf):
    return rounded(series.fill_group_mean_ffill(_day_grid(spark, sf), W).drop("timestamp"), 5)


@query("fill_group_mean_ffill_legacy", using("day_grid", _filled_sql(_FFILL.format(part="", order="site_id, d, mo"))))
def fill_group_mean_ffill_legacy(spark, sf):
    return rounded(series.fill_group_mean_ffill(_day_grid(spark, sf), W, mode="legacy").drop("timestamp"), 5)


@query("interpolate_linear", using("filled", f"SELECT site_id, hour_index, {', '.join(f'round({c} + 1.3e-7, 5) AS {c}' for c in W)} FROM filled"))
def interpolate_linear(spark, sf):
    return rounded(series.interpolate_linear(series.hour_grid(_hourly(spark, sf)), W), 5)


@query("savgol", using("smooth", f"SELECT site_id, hour_index, {', '.join(f'round({c} + 1.3e-7, 5) + 0.0 AS {c}' for c in SMOOTH)} FROM smooth"))
def savgol(spark, sf):
    filled = series.interpolate_linear(series.hour_grid(_hourly(spark, sf)), list(series.SMOOTHED.values()))
    return rounded(series.smooth_temperatures(filled).select("site_id", "hour_index", *SMOOTH), 5)


@query(
    "clean_weather",
    using(
        "local_smooth",
        f"SELECT site_id, hour_index, {', '.join(f'round(f.{c} + 1.3e-7, 5) AS {c}' for c in W)}, {', '.join(f'had_{c}' for c in W)},"
        f" {', '.join(f'round({c} + 1.3e-7, 5) + 0.0 AS {c}' for c in SMOOTH)} FROM local_filled f JOIN local_smooth USING (site_id, hour_index)",
    ),
)
def clean_weather(spark, sf):
    return rounded(series.clean_weather(_hourly(spark, sf), W), 5)


def _rolled(columns, rows):
    return ", ".join(
        f"round({expr.format(c=c)} OVER w + 1.3e-7, 5) + 0.0 AS {c}_{kind}_lag{rows}"
        for c in columns
        for kind, expr in (("mean", "avg({c})"), ("max", "max({c})"), ("min", "min({c})"), ("std", "stddev_samp({c})"))
    )


@query(
    "rolling_trailing",
    using(
        "weather",
        "SELECT * FROM (SELECT site_id, timestamp, "
        + _rolled(W, 3)
        + " FROM weather WINDOW w AS (PARTITION BY site_id ORDER BY timestamp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) JOIN (SELECT site_id, timestamp, "
        + _rolled(["air_temperature"], 72)
        + " FROM weather WINDOW w AS (PARTITION BY site_id ORDER BY timestamp ROWS BETWEEN 71 PRECEDING AND CURRENT ROW)) USING (site_id, timestamp)",
    ),
)
def rolling_trailing(spark, sf):
    df = series.rolling_trailing(views.weather(spark, sf), W, 3)
    return rounded(series.rolling_trailing(df, ["air_temperature"], 72).drop(*W), 5)


_CENTER = ["air_temperature", "dew_temperature"]


def _centered(rows):
    return (
        "(SELECT site_id, timestamp, "
        + ", ".join(
            f"round({expr.format(c=c)} OVER w + 1.3e-7, 5) + 0.0 AS {c}_{kind}_lag{rows}"
            for c in _CENTER
            for kind, expr in (
                ("mean", "avg({c})"),
                ("max", "quantile_cont({c}, 0.95)"),
                ("min", "quantile_cont({c}, 0.05)"),
                ("std", "stddev_samp({c})"),
            )
        )
        + f" FROM weather WINDOW w AS (PARTITION BY site_id ORDER BY timestamp ROWS BETWEEN {rows // 2} PRECEDING AND {rows // 2} FOLLOWING))"
    )


@query("rolling_centered", using("weather", f"SELECT * FROM {_centered(7)} JOIN {_centered(73)} USING (site_id, timestamp)"))
def rolling_centered(spark, sf):
    df = views.weather(spark, sf).select("site_id", "timestamp", *_CENTER)
    for rows in (7, 73):
        df = series.rolling_centered(df, _CENTER, rows)
    return rounded(df.drop(*_CENTER), 5)


# ---------------------------------------------------------------- encoders

SPLIT_AT = "2024-01-21 00:00:00"
extend(
    "encode_base",
    """
base AS (
  SELECT m.*, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(isodow(timestamp) - 1 AS INTEGER) AS weekday, CAST(day(timestamp) % 3 + 1 AS INTEGER) AS month,
         ln(1 + meter_reading) AS target, timestamp < TIMESTAMP '2024-01-21' AS in_train FROM metered m)""",
    ("metered",),
)


def _encode_base(spark, sf):
    """The day of month stands in for the month: the events cover a single month."""
    ts = F.col("timestamp")
    return _metered(spark, sf).withColumns(
        {
            "hour": F.hour(ts),
            "weekday": F.weekday(ts),
            "month": F.dayofmonth(ts) % 3 + 1,
            "target": hr.log_target(F.col("meter_reading")),
            "in_train": ts < F.lit(SPLIT_AT).cast("timestamp_ntz"),
        }
    )


_TAU = 1e-6


def _fit_sql(keys, prior, where, tau=_TAU):
    return f"""SELECT {keys}, CASE WHEN min(target) < max(target) THEN ({tau} * avg({prior}) + count(target) / var_samp(target) * avg(target))
        / ({tau} + count(target) / var_samp(target)) END AS fit FROM {{src}} WHERE {where} GROUP BY {keys}"""


@query(
    "gaussian_target_encode",
    using(
        "encode_base",
        f"""WITH fits AS ({_fit_sql('meter, hour', '(SELECT avg(target) FROM base WHERE in_train)', 'in_train', 0.5).format(src='base')}),
            spread AS (SELECT meter, hour, CASE WHEN min(target) < max(target) THEN 1.0::DOUBLE / (0.5 + count(target) / var_samp(target)) WHEN count(target) > 1 THEN 0.0 END AS v FROM base WHERE in_train GROUP BY 1, 2)
            SELECT building_id, meter, timestamp, round(coalesce(f.fit, (SELECT avg(target) FROM base WHERE NOT in_train)), 6) AS gte_mean,
              round(coalesce(s.v, (SELECT avg(target) FROM base WHERE NOT in_train)), 6) AS gte_var
            FROM base LEFT JOIN fits f USING (meter, hour) LEFT JOIN spread s USING (meter, hour) WHERE NOT in_train""",
    ),
)
def gaussian_target_encode(spark, sf):
    base = _encode_base(spark, sf)
    train, test = base.where("in_train"), base.where("not in_train")
    keys = ["meter", "hour"]
    encoded = encoders.gaussian_target_encode(train, test, keys, "target", out="gte_mean", tau=0.5)
    encoded = encoders.gaussian_target_encode(train, encoded, keys, "target", out="gte_var", tau=0.5, stat="var")
    return rounded(encoded.select(*KEY, "gte_mean", "gte_var"), 6)


ENCODED = [encoders.encoding_name(k) for k, _ in encoders.ENCODINGS]


def _stack_sql(source: str, train: str, good: str) -> str:
    """The chain of encodings row by row, with the fitting rows' own fallback beside the features."""
    text = f"means AS (SELECT avg(CASE WHEN {good} THEN target END) AS fit_mean, avg(target) AS row_mean FROM {source} WHERE {train})"
    previous = source
    for i, (keys, priors) in enumerate(encoders.ENCODINGS):
        name = encoders.encoding_name(keys)
        row_prior = "(SELECT row_mean FROM means)" if priors is None else "(" + " + ".join(priors) + ") / 2"
        fit_prior = "(SELECT fit_mean FROM means)" if priors is None else "(" + " + ".join("f_" + p for p in priors) + ") / 2"
        cols = ", ".join(keys)
        text += f",\ns{i} AS ({_fit_sql(cols, fit_prior, f'{train} AND {good}').format(src=previous)})"
        text += f",\ne{i} AS (SELECT p.*, coalesce(s.fit, {row_prior}) AS {name}, coalesce(s.fit, {fit_prior}) AS f_{name} FROM {previous} p LEFT JOIN s{i} s USING ({cols}))"
        previous = f"e{i}"
    return text


@query(
    "target_encode_stack",
    using(
        "encode_base",
        "WITH "
        + _stack_sql("base", "in_train", "meter_reading > 0")
        + f" SELECT building_id, meter, timestamp, in_train, {', '.join(f'round({c} + 1.3e-7, 5) AS {c}' for c in ENCODED)} FROM e15",
    ),
)
def target_encode_stack(spark, sf):
    base = _encode_base(spark, sf)
    train, test = encoders.target_encode_stack(
        base.where("in_train"), base.where("not in_train"), good=F.col("meter_reading") > 0
    )
    return rounded(train.unionByName(test).select(*KEY, "in_train", *ENCODED), 5)


_CATS = ["building_id", "primary_use", "weekday"]


@query(
    "label_encode",
    using(
        "encode_base",
        "SELECT building_id AS building, meter, timestamp, in_train, "
        + ", ".join(f"dense_rank() OVER (PARTITION BY meter ORDER BY {c}) - 1 AS {c}" for c in _CATS)
        + " FROM base",
    ),
)
def label_encode(spark, sf):
    base = _encode_base(spark, sf).select(F.col("building_id").alias("building"), "meter", "timestamp", "in_train", *_CATS)
    train, test = encoders.label_encode(base.where("in_train"), base.where("not in_train"), _CATS, "meter")
    return train.unionByName(test)


@query(
    "category_codes",
    using("buildings", "SELECT building_id, dense_rank() OVER (ORDER BY primary_use) - 1 AS primary_use FROM buildings"),
)
def category_codes(spark, sf):
    return encoders.codes(views.buildings(spark, sf).select("building_id", "primary_use"), ["primary_use"])


@query(
    "first_seen_encode",
    using(
        "buildings",
        """SELECT b.building_id, f.code AS primary_use FROM buildings b JOIN (
             SELECT primary_use, row_number() OVER (ORDER BY min(building_id)) - 1 AS code FROM buildings GROUP BY 1) f USING (primary_use)""",
    ),
)
def first_seen_encode(spark, sf):
    df = views.buildings(spark, sf).select("building_id", "primary_use")
    return encoders.first_seen_encode(df, "primary_use", "building_id")


_SCALED = ["meter_reading", "square_feet", "target"]


@query(
    "standardize_by_segment",
    using(
        "encode_base",
        "SELECT building_id, timestamp, meter, in_train, "
        + ", ".join(f"round(({c} - avg({c}) OVER w) / nullif(stddev_pop({c}) OVER w, 0) + 1.3e-7, 5) + 0.0 AS {c}" for c in _SCALED)
        + " FROM base WINDOW w AS (PARTITION BY meter)",
    ),
)
def standardize_by_segment(spark, sf):
    base = _encode_base(spark, sf).select(*KEY, "in_train", *_SCALED)
    train, test = encoders.standardize_by_segment(base.where("in_train"), base.where("not in_train"), _SCALED, "meter")
    return rounded(train.unionByName(test), 5)


@query(
    "standard_scale_fit",
    using(
        "encode_base",
        "SELECT building_id, timestamp, meter, in_train, "
        + ", ".join(f"round(({c} - (SELECT avg({c}) FROM base WHERE in_train)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM base WHERE in_train) + 1.3e-7, 5) + 0.0 AS {c}" for c in _SCALED)
        + " FROM base",
    ),
)
def standard_scale_fit(spark, sf):
    base = _encode_base(spark, sf).select(*KEY, "in_train", *_SCALED)
    scaled = encoders.standard_scale(base.where("in_train"), {"test": base.where("not in_train")}, _SCALED)
    return rounded(scaled["train"].unionByName(scaled["test"]), 5)


_GROUPED = " ".join(f"WHEN primary_use IN ({', '.join(repr(n) for n in names)}) THEN {i}" for i, names in enumerate(encoders.USE_GROUPS))


@query("group_categories", using("buildings", f"SELECT building_id, primary_use, CASE {_GROUPED} END AS use_group FROM buildings"))
def group_categories(spark, sf):
    return views.buildings(spark, sf).select(
        "building_id", "primary_use", encoders.group_categories(F.col("primary_use")).alias("use_group")
    )


@query(
    "segment_cardinality",
    using(
        "encode_base",
        "SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT meter, '{c}' AS \"column\", count(DISTINCT {c}) AS categories FROM base GROUP BY meter" for c in _CATS)
        + ")",
    ),
)
def segment_cardinality(spark, sf):
    from ledgerline.operators.aggregates import segment_cardinality as cardinality

    return cardinality(_encode_base(spark, sf), "meter", _CATS)


# ---------------------------------------------------------------- whole job


_PART = "building_id, meter, timestamp, is_bad, target, hour_index, site_id, year_built, building_weekday_hour, " + ", ".join(ENCODED)


def _applied_sql(source: str) -> str:
    """The fitted encodings on other rows."""
    text, previous = [], source
    for i, (keys, priors) in enumerate(encoders.ENCODINGS):
        prior = "(SELECT row_mean FROM means)" if priors is None else "(" + " + ".join(priors) + ") / 2"
        text.append(f"a{i} AS (SELECT p.*, coalesce(s.fit, {prior}) AS {encoders.encoding_name(keys)} FROM {previous} p LEFT JOIN s{i} s USING ({', '.join(keys)}))")
        previous = f"a{i}"
    return ", ".join(text)


def _job_sql() -> str:
    rolled = {}
    for rows in (7, 73):
        rolled[rows] = ", ".join(
            f"{expr.format(c=c)} OVER w{rows} AS {c}_{kind}_lag{rows}"
            for c in _CENTER
            for kind, expr in (("mean", "avg({c})"), ("max", "quantile_cont({c}, 0.95)"), ("min", "quantile_cont({c}, 0.05)"), ("std", "stddev_samp({c})"))
        )
    return f"""WITH weather_table AS (
  SELECT f.*, {", ".join("s." + c for c in SMOOTH)}, {rolled[7]}, {rolled[73]} FROM local_filled f JOIN local_smooth s USING (site_id, hour_index)
  WINDOW w7 AS (PARTITION BY f.site_id ORDER BY f.hour_index ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),
         w73 AS (PARTITION BY f.site_id ORDER BY f.hour_index ROWS BETWEEN 36 PRECEDING AND 36 FOLLOWING)),
cleaned AS (
  SELECT building_id, meter, timestamp, hour_index, site_id, primary_use, square_feet, year_built - 1900 AS year_built,
    CASE WHEN site_id = 0 AND meter = 0 THEN meter_reading * 0.2931::DOUBLE ELSE meter_reading END AS meter_reading,
    is_bad_zero OR coalesce(hour_index < 3378 AND site_id = 0 AND meter = 0, FALSE) OR coalesce(building_id = 1099 AND meter = 2 AND meter_reading > 30000, FALSE) AS is_bad
  FROM bad_zero),
featured AS (
  SELECT *, ln(1 + meter_reading) AS target, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(isodow(timestamp) - 1 AS INTEGER) AS weekday,
    CAST(month(timestamp) AS INTEGER) AS month, building_id || '-' || meter || '-' || (isodow(timestamp) - 1) || '-' || hour(timestamp) AS building_weekday_hour
  FROM cleaned), {_stack_sql("featured", "TRUE", "NOT is_bad")},
moved AS (
  SELECT CASE WHEN r.building_id % 9 = 0 THEN r.building_id + 1000000 ELSE r.building_id END AS building_id, CAST((r.meter + 1) % 4 AS INTEGER) AS meter, r.timestamp,
    CAST(floor(epoch(r.timestamp - TIMESTAMP '2024-01-01') / 3600) AS BIGINT) AS hour_index FROM readings r),
a_ AS (
  SELECT m.*, b.site_id, b.primary_use, b.year_built - 1900 AS year_built, CAST(NULL AS BOOLEAN) AS is_bad, CAST(NULL AS DOUBLE) AS target, CAST(hour(timestamp) AS INTEGER) AS hour,
    CAST(isodow(timestamp) - 1 AS INTEGER) AS weekday, CAST(month(timestamp) AS INTEGER) AS month,
    m.building_id || '-' || m.meter || '-' || (isodow(timestamp) - 1) || '-' || hour(timestamp) AS building_weekday_hour
  FROM moved m LEFT JOIN buildings b USING (building_id)), {_applied_sql("a_")},
parts AS (
  SELECT 'train' AS part, {_PART} FROM e15 UNION ALL SELECT 'test', {_PART} FROM a15)
SELECT e.part, e.building_id, e.meter, e.timestamp, e.is_bad, round(e.target + 1.3e-7, 5) AS target, round(cos(2 * pi() * e.hour_index / 24) + 1.3e-7, 5) + 0.0 AS hour_x, e.year_built,
  e.building_weekday_hour, {", ".join(f"round(e.{c} + 1.3e-7, 5) AS {c}" for c in ENCODED)}, round(w.air_temperature + 1.3e-7, 5) AS air_temperature, w.had_wind_speed,
  round(w.dew_diff + 1.3e-7, 5) + 0.0 AS dew_diff, round(w.air_temperature_max_lag7 + 1.3e-7, 5) AS air_temperature_max_lag7, round(w.dew_temperature_std_lag73 + 1.3e-7, 5) AS dew_temperature_std_lag73
FROM parts e LEFT JOIN weather_table w ON w.site_id = e.site_id AND w.hour_index = e.hour_index"""


@query("meter_feature_table", using("bad_zero local_smooth", _job_sql()))
def meter_feature_table(spark, sf):
    df = meters.from_test_tables(spark, sf)
    df = df.select(
        "part", *KEY, "is_bad", "target", "hour_x", "year_built", "building_weekday_hour", *ENCODED, "air_temperature", "had_wind_speed",
        "dew_diff", "air_temperature_max_lag7", "dew_temperature_std_lag73",
    )
    return rounded(df, 5)



