"""Holiday calendars against days looked up by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline.sources.calendars import all_calendars, country_holidays, easter, holiday_table, site_holiday_flag


def days(*texts):
    return [date.fromisoformat(t) for t in texts]


@pytest.mark.parametrize(
    "day", ["1981-04-19", "1994-04-03", "1999-04-04", "2000-04-23", "2008-03-23", "2011-04-24", "2016-03-27", "2017-04-16", "2018-04-01", "2019-04-21", "2024-03-31", "2025-04-20", "2038-04-25"]
)
def test_easter(day):
    assert easter(int(day[:4])) == date.fromisoformat(day)


def test_england():
    assert country_holidays("england", 2016, 2016) == days("2016-01-01", "2016-03-25", "2016-03-28", "2016-05-02", "2016-05-30", "2016-08-29", "2016-12-25", "2016-12-26", "2016-12-27")
    assert country_holidays("england", 2022, 2022) == days(
        "2022-01-01", "2022-01-03", "2022-04-15", "2022-04-18", "2022-05-02", "2022-06-02", "2022-06-03", "2022-08-29", "2022-09-19", "2022-12-25", "2022-12-26", "2022-12-27"
    )
    assert set(days("2020-05-08", "2020-12-28")) <= set(country_holidays("england", 2020, 2020)) and date(2020, 5, 4) not in country_holidays("england", 2020, 2020)
    assert set(days("2021-12-25", "2021-12-26", "2021-12-27", "2021-12-28")) <= set(country_holidays("england", 2021, 2021))


def test_ireland():
    assert country_holidays("ireland", 2017, 2017) == days(
        "2017-01-01", "2017-01-02", "2017-03-17", "2017-04-17", "2017-05-01", "2017-06-05", "2017-08-07", "2017-10-30", "2017-12-25", "2017-12-26"
    )
    assert date(2018, 3, 19) in country_holidays("ireland", 2018, 2018) and date(2018, 3, 30) not in country_holidays("ireland", 2018, 2018)
    assert date(2023, 2, 6) in country_holidays("ireland", 2023, 2023) and date(2022, 2, 7) not in country_holidays("ireland", 2022, 2022)


def test_canada():
    assert country_holidays("canada", 2017, 2017) == days(
        "2017-01-01", "2017-01-02", "2017-02-20", "2017-04-14", "2017-05-22", "2017-07-01", "2017-07-03", "2017-08-07", "2017-09-04", "2017-10-09", "2017-12-25", "2017-12-26"
    )
    assert date(2016, 5, 23) in country_holidays("canada", 2016, 2016)


def test_flag_by_site_and_table(spark):
    rows = [(s, f"2018-{d}") for s in (0, 1, 5, 7, 11, 12, 13) for d in ("03-19", "03-30", "04-02", "05-21", "07-04", "08-27", "10-29")]
    df = spark.createDataFrame(rows, "site int, day string").withColumn("ts", F.to_timestamp_ntz("day"))
    got = {(r.site, r.day[5:]) for r in df.where(site_holiday_flag(F.col("site"), F.col("ts"), all_calendars(2018, 2018)) == 1).collect()}
    england = {(s, d) for s in (1, 5) for d in ("03-30", "04-02", "08-27")}
    canada = {(s, d) for s in (7, 11) for d in ("03-30", "05-21")}
    assert got == england | canada | {(12, d) for d in ("03-19", "04-02", "10-29")} | {(0, "07-04"), (13, "07-04")}
    table = holiday_table(spark, 2016, 2018)
    assert table.groupBy("calendar").count().count() == 4 and table.where("calendar = 'ireland' AND year = 2017").count() == 10
