"""Working time between two moments: interval arithmetic over a calendar, without a row for each day or hour."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketlake.functions.bands import WORKING_MINUTES

#: A Monday, from which weeks are counted.
MONDAY = dt.date(1970, 1, 5)


def free_days(holidays: DataFrame | Iterable) -> DataFrame:
    """`(first, before)`: one row with the first holiday on a weekday and prefix sums from there on.

    `before[i]` is the number of such holidays earlier than `first` plus i days; it ends a day after the
    last one. Repeated, null and weekend days count for nothing; without any holiday both are NULL. The
    row has an entry a day of the calendar's span, whatever the number of tickets.
    """
    if not isinstance(holidays, DataFrame):
        days = [(d if isinstance(d, dt.date) else dt.date.fromisoformat(d),) for d in holidays]
        holidays = SparkSession.active().createDataFrame(days, "day date")
    free = holidays.select(F.col(f"`{holidays.columns[0]}`").cast("date").alias("day")).filter(F.weekday("day") < 5).distinct()
    span = free.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).filter("lo IS NOT NULL").select(
        F.explode(F.sequence("lo", F.date_add("hi", 1))).alias("day"))
    marked = span.join(free.withColumn("free", F.lit(1)), "day", "left")
    earlier = F.sum(F.coalesce("free", F.lit(0))).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    counted = marked.select("day", F.coalesce(earlier, F.lit(0)).cast("int").alias("n"))
    return counted.agg(
        F.min("day").alias("first"),
        F.transform(F.array_sort(F.collect_list(F.struct("day", "n"))), lambda x: x["n"]).alias("before"))


def working_seconds(
    start: Column, end: Column, holidays: DataFrame | Iterable, minutes: tuple[int, int] = WORKING_MINUTES
) -> Column:
    """Seconds of working time from `start` to `end`, as bigint; negative if `end` is the earlier one.

    Working time is Monday to Friday between the two `minutes` of the day, except on holidays. Both
    moments are taken to the whole second. NULL if one is missing. Each side is one lookup in the prefix
    sums of the calendar and some arithmetic, however long the interval is: the calendar is a scalar
    subquery, so neither a join nor a shuffle touches the tickets.
    """
    calendar = free_days(holidays).select(F.struct("first", "before")).scalar()
    first, before = calendar["first"], calendar["before"]
    opening, length = minutes[0] * 60, (minutes[1] - minutes[0]) * 60

    def free_until(days: Column) -> Column:
        at = F.greatest(F.lit(0), F.least(days, F.size(before) - 1))
        return F.coalesce(F.get(before, at), F.lit(0))

    def since_monday(at: Column) -> Column:
        """Working seconds between `MONDAY` and a moment."""
        day = at.cast("date")
        days, since_first = F.date_diff(day, F.lit(MONDAY)), F.date_diff(day, first)
        weekday = F.pmod(days, F.lit(7))
        earlier = F.floor(days / 7) * 5 + F.least(weekday, F.lit(5)) - free_until(since_first)
        is_free = (weekday >= 5) | (free_until(since_first + 1) > free_until(since_first))
        second = F.hour(at) * 3600 + F.minute(at) * 60 + F.floor(F.second(at))
        today = F.when(is_free, 0).otherwise(F.greatest(F.lit(0), F.least(second - opening, F.lit(length))))
        return earlier * length + today

    return (since_monday(end) - since_monday(start)).cast("bigint")
