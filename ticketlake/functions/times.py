"""Date parts, time of day and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketlake.functions.bands import time_parts


def second_of_day(time: Column) -> Column:
    """Seconds since midnight of a well-formed `H:m:s` clock time (00:00:00-23:59:59), else NULL."""
    hour, minute, second = time_parts(time)
    valid = hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    return F.when(valid, hour * 3600 + minute * 60 + second)


def at_time(date: Column, time: Column) -> Column:
    """Timestamp of a date plus a well-formed time of day, NULL when either is missing."""
    return F.timestamp_add("SECOND", second_of_day(time), date.cast("timestamp_ntz"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps as bigint."""
    return F.timestamp_diff("SECOND", start, end)


def mean_hours(seconds: Column) -> Column:
    """Average of whole seconds in hours, to two decimals.

    The sum stays an exact bigint until the last division, so the result does not depend on the
    order in which partitions are added up.
    """
    return F.round(F.sum(seconds) / F.count(seconds) / 3600, 2)
