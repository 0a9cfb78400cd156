"""Date and time expressions. Nothing reads the wall clock: reference dates are parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day_first(col: Column) -> Column:
    """`dd-MM-yyyy`, else `MM-dd-yyyy`, else NULL. Ambiguous values are read day first."""
    return F.coalesce(
        F.try_to_timestamp(col, F.lit("dd-MM-yyyy")),
        F.try_to_timestamp(col, F.lit("MM-dd-yyyy")),
    ).cast("date")


def parse_instant(col: Column) -> Column:
    """ISO text to timestamp; unreadable text gives NULL."""
    return F.try_to_timestamp(col)


def to_utc(col: Column, zone: str) -> Column:
    return F.to_utc_timestamp(col, zone)


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def weekdays_before(col: Column) -> Column:
    """Number of Mondays to Fridays from Monday 1970-01-05 up to, not including, the date."""
    days = F.unix_date(col) - F.lit(4)
    weeks = F.floor(days / F.lit(7)).cast("int")
    return weeks * 5 + F.least(days - weeks * 7, F.lit(5))


def business_days(start: Column, end: Column) -> Column:
    """Working days in (start, end]: the arithmetic form needs no array of days per row."""
    return weekdays_before(F.date_add(end, 1)) - weekdays_before(F.date_add(start, 1))


def in_interval(day: Column, start: Column, end: Column) -> Column:
    """Half-open validity interval; a NULL end is open."""
    return (start <= day) & (end.isNull() | (day < end))


def seconds_between(end: Column, start: Column) -> Column:
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))
