"""Calendar expressions: weeks, holidays, proximity.

Holiday calendars are small literal parameters (as in the reference, a
list of dates), so proximity and flags are plain expressions over a literal
array: no join, no shuffle, nothing grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import schemas as S

# The reference holiday list, in its list order (grouped by
# holiday, then year). List order decides ties in nearest-holiday lookups.
REFERENCE_HOLIDAYS: list[tuple[str, str]] = [
    ("superbowl", "2010-02-12"), ("superbowl", "2011-02-11"),
    ("superbowl", "2012-02-10"), ("superbowl", "2013-02-08"),
    ("labor_day", "2010-09-10"), ("labor_day", "2011-09-09"),
    ("labor_day", "2012-09-07"), ("labor_day", "2013-09-06"),
    ("thanksgiving", "2010-11-26"), ("thanksgiving", "2011-11-25"),
    ("thanksgiving", "2012-11-23"), ("thanksgiving", "2013-11-29"),
    ("christmas", "2010-12-31"), ("christmas", "2011-12-30"),
    ("christmas", "2012-12-28"), ("christmas", "2013-12-27"),
]

# ISO weeks the reference holidays fall in (2010-2012), used to
# derive a calendar for any year range by rule.
HOLIDAY_ISO_WEEKS: list[tuple[str, int]] = [
    ("superbowl", 6), ("labor_day", 36), ("thanksgiving", 47), ("christmas", 52),
]

# The window the additive model spreads each holiday over.
HOLIDAY_LOWER_WINDOW = -7
HOLIDAY_UPPER_WINDOW = 0


def derived_holidays(first_year: int, last_year: int) -> list[tuple[str, str]]:
    """Friday of each holiday ISO week for every year, grouped by holiday then year."""
    out = []
    for name, week in HOLIDAY_ISO_WEEKS:
        for y in range(first_year, last_year + 1):
            out.append((name, dt.date.fromisocalendar(y, week, 5).isoformat()))
    return out


def friday_of_week(c: Column | str) -> Column:
    """Friday of the Monday-based week containing the timestamp/date."""
    return F.date_add(F.trunc(F.to_date(c), "week"), 4)


def calendar_parts(date: str = "date") -> dict[str, Column]:
    """H2: calendar year, month and ISO week number."""
    return {"year": F.year(date), "month": F.month(date), "week": F.weekofyear(date)}


def _date_array(holidays: list[tuple[str, str]]) -> Column:
    return F.array(*[F.lit(d).cast("date") for _, d in holidays])


def days_to_nearest_holiday(date: Column | str, holidays: list[tuple[str, str]]) -> Column:
    """Signed days (holiday - date) to the nearest holiday.

    Positive = upcoming, negative = passed (T6). Ties go to the first holiday
    in list order (T5): the minimum of (abs diff, list index, diff) structs.
    """
    d = F.col(date) if isinstance(date, str) else date
    hol = _date_array(holidays)
    idx = F.sequence(F.lit(0), F.lit(len(holidays) - 1))
    cand = F.arrays_zip(hol.alias("h"), idx.alias("i"))
    scored = F.transform(cand, lambda s: F.struct(
        F.abs(F.datediff(s["h"], d)).alias("a"), s["i"].alias("i"), F.datediff(s["h"], d).alias("s")))
    return F.array_min(scored)["s"]


def holiday_flags(date: str, holidays: list[tuple[str, str]],
                  prefix: str = "is_") -> dict[str, Column]:
    """One 0/1 flag per holiday name for exact-date membership."""
    names: list[str] = []
    for n, _ in holidays:
        if n not in names:
            names.append(n)
    return {f"{prefix}{n}": F.col(date).isin([F.lit(d).cast("date") for m, d in holidays if m == n]).cast("int")
            for n in names}


def holiday_frame(spark: SparkSession, holidays: list[tuple[str, str]],
                  lower: int = HOLIDAY_LOWER_WINDOW, upper: int = HOLIDAY_UPPER_WINDOW) -> DataFrame:
    """Holiday table ``(name, date, lower_window, upper_window)``; one row per listed date."""
    rows = [(n, dt.date.fromisoformat(d), lower, upper) for n, d in holidays]
    return spark.createDataFrame(rows, S.HOLIDAY)


def spread_holidays(cal: DataFrame) -> DataFrame:
    """One row per (name, day) for every offset in [lower_window, upper_window]."""
    return (cal.select("name", "date", F.explode(F.sequence("lower_window", "upper_window")).alias("offset"))
            .select("name", F.date_add("date", F.col("offset")).alias("ds"), "offset"))


def weekly_dates(start: Column, end: Column) -> Column:
    """Every Friday from the first Friday on/after ``start`` up to ``end``."""
    first = F.next_day(F.date_sub(start, 1), "Fri")
    return F.when(first <= end, F.sequence(first, end, F.expr("INTERVAL 7 DAYS"))).otherwise(
        F.array().cast("array<date>"))
