"""H11 tie rule (T5), sign (T6), ISO weeks (T9), weekly ranges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.functions.calendar import (REFERENCE_HOLIDAYS, days_to_nearest_holiday, derived_holidays,
                                          holiday_flags, weekly_dates)


@pytest.mark.parametrize("day, expected", [
    ("2010-05-28", -105), ("2011-01-21", 21), ("2012-01-20", 21), ("2013-01-18", 21),
    ("2011-05-27", -105), ("2012-05-25", -105), ("2013-05-24", -105),
    ("2010-02-12", 0), ("2010-02-05", 7), ("2010-02-19", -7),
])
def test_nearest_holiday_ties_and_sign(spark, day, expected):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "date date")
    got = df.select(days_to_nearest_holiday("date", REFERENCE_HOLIDAYS).alias("d")).first()["d"]
    assert got == expected


def test_iso_week_of_new_year(spark):
    df = spark.createDataFrame([(dt.date(2010, 1, 1),)], "date date")
    assert df.select(F.weekofyear("date")).first()[0] == 53


def test_derived_holidays_match_reference_weeks():
    d = dict()
    for name, day in derived_holidays(2010, 2012):
        d.setdefault(name, []).append(day)
    ref = dict()
    for name, day in REFERENCE_HOLIDAYS:
        if day < "2013":
            ref.setdefault(name, []).append(day)
    assert d == ref


def test_holiday_flags(spark):
    df = spark.createDataFrame([(dt.date(2011, 11, 25),), (dt.date(2011, 11, 18),)], "date date")
    rows = df.select("date", *[c.alias(k) for k, c in holiday_flags("date", REFERENCE_HOLIDAYS).items()]).orderBy("date").collect()
    assert rows[1]["is_thanksgiving"] == 1 and rows[0]["is_thanksgiving"] == 0
    assert rows[1]["is_christmas"] == 0


def test_weekly_dates_rolls_to_friday(spark):
    df = spark.createDataFrame([(dt.date(2010, 2, 1), dt.date(2010, 2, 26))], "a date, b date")
    out = df.select(weekly_dates(F.col("a"), F.col("b")).alias("d")).first()["d"]
    assert out == [dt.date(2010, 2, 5), dt.date(2010, 2, 12), dt.date(2010, 2, 19), dt.date(2010, 2, 26)]


def test_friday_of_week_for_any_day(spark):
    from panelcast.functions.calendar import friday_of_week
    days = [dt.date(2010, 2, 1) + dt.timedelta(days=i) for i in range(7)]  # Mon..Sun
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r[0] for r in df.select(friday_of_week("d")).collect()}
    assert got == {dt.date(2010, 2, 5)}
