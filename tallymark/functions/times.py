"""Time expressions. All timestamps are TIMESTAMP_NTZ and mean UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.contract import DAYS_OF_WEEK, TIMESTAMP_MICROS, TIMESTAMP_SECONDS


def ntz(value: str | dt.datetime | Column) -> Column:
    """A zone-free timestamp literal; independent of the session time zone."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def micros_text(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_MICROS)


def seconds_text(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_SECONDS)


def plus_micros(ts: Column, micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros.cast("bigint"), ts)


def plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("bigint"), ts)


def plus_hours(ts: Column, hours: Column | int) -> Column:
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    return F.timestamp_add("HOUR", hours.cast("bigint"), ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, truncated toward zero."""
    return F.timestamp_diff("SECOND", start, end)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def truncate_second(ts: Column) -> Column:
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def weekday(ts: Column) -> Column:
    """MON .. SUN."""
    return F.element_at(F.array(*[F.lit(d) for d in DAYS_OF_WEEK]), F.weekday(ts) + 1)


def nth_weekday(month: Column, nth: Column, dow: Column) -> Column:
    """Date of the nth given weekday (MON..SUN) in the month of ``month``.

    Beyond the month's last such weekday the last one is meant.
    """
    first = F.trunc(month, "MM")
    names = F.array(*[F.lit(d) for d in DAYS_OF_WEEK])
    lead = F.pmod(F.array_position(names, dow) - 1 - F.weekday(first), F.lit(7))
    day = lead + (nth - 1) * 7
    surplus = F.greatest(F.lit(0), F.floor((day - F.dayofmonth(F.last_day(first))) / 7) + 1)
    return F.date_add(first, (day - surplus * 7).cast("int"))


def month_back(anchor: Column, months: Column) -> Column:
    """First day of the month ``months`` before ``anchor``."""
    return F.add_months(F.trunc(anchor, "MM"), -months.cast("int"))
