"""Dates, months, times of day and microsecond timestamps (all UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_text(ts: Column) -> Column:
    """Time of day as ``HH:mm:ss.SSSSSS``."""
    return F.date_format(ts, "HH:mm:ss.SSSSSS")


def hour_of(time: Column) -> Column:
    return F.substring(time, 1, 2).cast("int")


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def weekday_label(weekday: Column) -> Column:
    """``1-Monday`` to ``7-Sunday`` for 0 to 6, so that labels sort in week order."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), weekday)  # this was a Monday
    return F.concat((weekday + 1).cast("string"), F.lit("-"), F.date_format(day, "EEEE"))


def to_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")
