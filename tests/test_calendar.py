"""Calendar columns against Python's calendar, for every day of 2000-2030."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import functions as F

from chainfold.functions import calendar as C


def _week_of_month(d: dt.date, firstweekday: int) -> int:
    cal = calendar.Calendar(firstweekday=firstweekday)
    for i, week in enumerate(cal.monthdayscalendar(d.year, d.month), start=1):
        if d.day in week:
            return i
    raise AssertionError(d)


def test_week_conventions_all_days(spark):
    start = dt.date(2000, 1, 1)
    n = (dt.date(2030, 12, 31) - start).days + 1
    days = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    out = days.select(
        "d",
        C.week_of_month("d", "sunday").alias("sun"),
        C.week_of_month("d", "monday").alias("mon"),
        C.week_of_year("d").alias("iso"),
        C.year("d").alias("y"),
        C.month("d").alias("m"),
        C.day_of_month("d").alias("dom"),
        C.previous_day("d").alias("prev"),
    ).collect()
    assert len(out) == n == 11323
    differ = 0
    for r in out:
        d = r.d
        assert r.sun == _week_of_month(d, calendar.SUNDAY), d
        assert r.mon == _week_of_month(d, calendar.MONDAY), d
        assert r.iso == d.isocalendar()[1], d
        assert (r.y, r.m, r.dom) == (d.year, d.month, d.day)
        assert r.prev == d - dt.timedelta(days=1)
        differ += r.sun != r.mon
    # The two conventions disagree on a Sunday-started share of days.
    assert differ == 2708


def test_golden_day(spark):
    # A Saturday: week 4 of November 2024 in both conventions, ISO week 47.
    r = (
        spark.range(1)
        .select(C.parse_date(F.lit("2024-11-23")).alias("d"))
        .select(
            C.week_of_month("d", "sunday").alias("sun"),
            C.week_of_month("d", "monday").alias("mon"),
            C.week_of_year("d").alias("iso"),
        )
        .first()
    )
    assert (r.sun, r.mon, r.iso) == (4, 4, 47)


def test_sunday_differs(spark):
    # 2024-01-14 is a Sunday: it opens week 3 (Sunday start) but closes
    # week 2 (Monday start).
    r = spark.range(1).select(C.parse_date(F.lit("2024-01-14")).alias("d")).select(
        C.week_of_month("d", "sunday").alias("sun"), C.week_of_month("d", "monday").alias("mon")
    ).first()
    assert (r.sun, r.mon) == (3, 2)


def test_parse_and_split(spark):
    r = (
        spark.range(1)
        .select(F.lit("2024-11-23").alias("s"), F.lit("not a date").alias("bad"))
        .select(
            C.parse_date("s").alias("d"),
            C.parse_date("bad").alias("nd"),
            *C.date_string_parts(F.col("s")),
        )
        .first()
    )
    assert r[0] == dt.date(2024, 11, 23)
    assert r[1] is None
    assert (r[2], r[3]) == (2024, 11)
