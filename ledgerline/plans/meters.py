"""Meter job: clean readings, weather, features, encodings, one feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import hours as hr
from ledgerline.operators import encoders, series, tables
from ledgerline.session import pin, stage_path
from ledgerline.sources import views

ROLL_COLUMNS = ["air_temperature", "dew_temperature"]


def base_features(df: DataFrame, origin: str = hr.HOUR_ORIGIN) -> DataFrame:
    """Calendar, cyclic, interaction and log features of readings that carry building columns."""
    parts = hr.calendar_parts(F.col("timestamp"))
    dated = df.withColumns({k: parts[k] for k in ("hour", "weekday", "month", "year")})
    dated = dated.withColumn("hour_index", hr.hour_index(F.col("timestamp"), origin))
    b, m, w, h, mo = (F.col(c) for c in ("building_id", "meter", "weekday", "hour", "month"))
    return dated.withColumns(
        {
            **hr.cyclic(F.col("hour_index")),
            "year_built": hr.rebase(F.col("year_built"), 1900),
            "weekday_hour": hr.composite_key(w, h),
            "building_weekday_hour": hr.composite_key(b, m, w, h),
            "building_weekday": hr.composite_key(b, m, w),
            "building_month": hr.composite_key(b, m, mo),
            "building_hour": hr.composite_key(b, m, h),
            "building_meter": hr.composite_key(b, m),
        }
    )


def clean_readings(readings: DataFrame, buildings: DataFrame, origin: str, **zero_rules) -> DataFrame:
    """Readings with building columns, hour index and the merged bad-row flag; site 0 units corrected.

    All rules end in one flag, so cleaning needs a single filter and no anti join.
    """
    with_buildings = tables.attach_checked(readings, buildings, ["building_id"])
    hours = with_buildings.withColumn("hour_index", hr.hour_index(F.col("timestamp"), origin))
    flagged = series.by_series(hours, lambda rows, slice_by: series.bad_zero_flag(rows, **zero_rules, slice_by=slice_by))
    bad = F.col("is_bad_zero") | F.coalesce(series.warmup_rule(), F.lit(False)) | F.coalesce(series.extreme_rule(), F.lit(False))
    site0 = (F.col("site_id") == 0) & (F.col("meter") == 0)
    return flagged.withColumn("is_bad", bad).drop("is_bad_zero").withColumn(
        "meter_reading", hr.scale_where(F.col("meter_reading"), site0, hr.SITE0_FACTOR_IN)
    )


def weather_features(weather: DataFrame, origin: str, windows: Sequence[int] = (7, 73)) -> DataFrame:
    """Local hours, gaps filled, smoothed and rolled; keyed by site and hour index."""
    indexed = weather.withColumn("hour_index", hr.hour_index(F.col("timestamp"), origin))
    clean = series.clean_weather(indexed, views.WEATHER_MEASURES)
    for rows in windows:
        clean = series.rolling_centered(clean, ROLL_COLUMNS, rows, order="hour_index")
    return clean


def with_weather(rows: DataFrame, weather: DataFrame, origin: str) -> DataFrame:
    """Rows that carry building columns, with base features and the weather of their site and hour."""
    return base_features(rows, origin).join(weather_features(weather, origin), ["site_id", "hour_index"], "left")


def fit_meter_features(
    readings: DataFrame, buildings: DataFrame, weather: DataFrame, origin: str = hr.HOUR_ORIGIN, **zero_rules
) -> tuple[DataFrame, encoders.TargetEncodings]:
    """The feature table of the training readings, bad rows flagged and left out of the encodings, and the fitted state."""
    clean = clean_readings(readings, buildings, origin, **zero_rules)
    featured = with_weather(clean.drop("hour_index"), weather, origin)
    # The encodings read the rows several times: write them once.
    staged = pin(featured.withColumn("target", hr.log_target(F.col("meter_reading"))), "features")
    fitted = encoders.fit_target_encodings(staged, good=~F.col("is_bad"))
    return fitted.apply(staged), fitted


def apply_meter_features(
    rows: DataFrame, buildings: DataFrame, weather: DataFrame, fitted: encoders.TargetEncodings, origin: str = hr.HOUR_ORIGIN
) -> DataFrame:
    """The feature table of rows without a reading: the weather of their own period, the encodings of the training rows.

    No reading rule applies; all rows stay. Encodings of groups that training didn't see fall back to their priors.
    """
    with_buildings = tables.attach_checked(rows.drop("meter_reading"), buildings, ["building_id"])
    return fitted.apply(pin(with_weather(with_buildings, weather, origin), "features"))


def meter_features(
    train: DataFrame,
    test: DataFrame | None,
    buildings: DataFrame,
    train_weather: DataFrame,
    test_weather: DataFrame | None = None,
    origin: str = hr.HOUR_ORIGIN,
    state_path: str | None = None,
    **zero_rules,
) -> tuple[DataFrame, DataFrame | None]:
    """Feature tables of the training readings and of the rows to predict.

    With ``state_path`` the fitted encodings are saved there, and the test rows get what was read back.
    """
    table, fitted = fit_meter_features(train, buildings, train_weather, origin, **zero_rules)
    if state_path:
        fitted.save(state_path)
        fitted = encoders.TargetEncodings.load(train.sparkSession, state_path)
    if test is None:
        return table, None
    return table, apply_meter_features(test, buildings, train_weather if test_weather is None else test_weather, fitted, origin)


def from_test_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts; the test rows are the readings' hours at the building's next meter, every ninth at a building unseen."""
    readings = views.readings(spark, sf_dir)
    bid = F.when(F.col("building_id") % 9 == 0, F.col("building_id") + 1_000_000).otherwise(F.col("building_id"))
    test = readings.select(bid.cast(readings.schema["building_id"].dataType).alias("building_id"), ((F.col("meter") + 1) % 4).alias("meter"), "timestamp")
    train_part, test_part = meter_features(
        readings,
        test,
        views.buildings(spark, sf_dir),
        views.weather(spark, sf_dir),
        origin="2024-01-01 00:00:00",
        state_path=stage_path(spark, "encodings"),
        min_interval=2,
        summer=(200, 500),
        year_ends=(0, 10, 700, 719),
    )
    parts = train_part.withColumn("part", F.lit("train")), test_part.withColumn("part", F.lit("test"))
    return parts[0].unionByName(parts[1], allowMissingColumns=True)
