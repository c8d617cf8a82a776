"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_now() -> Column:
    """The moment of the query as a UTC wall clock, whatever the session zone is."""
    since = F.unix_micros(F.current_timestamp())
    return F.timestamp_add("MICROSECOND", since, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def minute_boundaries(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed between two times.

    10:00:59 to 10:01:01 crosses one boundary although only two seconds pass.
    """
    days = F.datediff(end, start).cast("bigint")
    hours = F.hour(end) - F.hour(start)
    minutes = F.minute(end) - F.minute(start)
    return days * 1440 + hours * 60 + minutes


def half_open(column: str, start: date | datetime, end: date | datetime) -> Column:
    """``start <= column < end``; a plain range that Parquet can prune on."""

    def bound(value: date | datetime) -> Column:
        return F.lit(str(value)).cast("timestamp_ntz")

    return (F.col(column) >= bound(start)) & (F.col(column) < bound(end))


# The parts of a time, from coarse to fine.
TIME_PARTS = ("year", "month", "day", "hour", "minute")


def truncate(ts: Column, unit: str) -> Column:
    """Start of the year, month, day, hour or minute, without any time zone."""
    kept = TIME_PARTS.index(unit) + 1
    values = [F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts)]
    lowest = [1, 1, 1, 0, 0]
    parts = values[:kept] + [F.lit(v) for v in lowest[kept:]]
    return F.make_timestamp_ntz(*parts, F.lit(0))
