"""Working-hours and shift bands as native column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public holidays of the default calendar (year 2025 only; pass your own for others).
HOLIDAYS_2025 = (
    "2025-01-01", "2025-04-21", "2025-05-01", "2025-05-08", "2025-05-29", "2025-06-09",
    "2025-07-14", "2025-08-15", "2025-11-01", "2025-11-11", "2025-12-25",
)
# Labels.
UNKNOWN, INVALID, WORKING, OFF_HOURS = "Inconnu", "Invalide", "HO", "HNO"
SHIFTS = ("Shift 1", "Shift 2", "Shift 3")
# Bounds in minutes of the day, closed on the left and open on the right.
WORKING_MINUTES = (510, 1110)  # 08:30 to 18:30
SHIFT_MINUTES = (420, 900, 1380)  # 07:00, 15:00, 23:00


THREE_INTEGERS = r"^\s*[+-]?\d+\s*:\s*[+-]?\d+\s*:\s*[+-]?\d+\s*$"


def well_formed(time: Column) -> Column:
    """Whether a text is exactly three integers, `H:m:s`. Ranges are not checked."""
    return time.rlike(THREE_INTEGERS)


def time_parts(time: Column) -> list[Column]:
    """Hour, minute and second of a well-formed `H:m:s`; NULL for any other text.

    The pattern is tested before the parts are converted: a conversion that fails costs an
    exception, which a column full of malformed times would pay on every row.
    """
    parts = F.split(time, ":")
    return [F.when(well_formed(time), F.get(parts, F.lit(i)).try_cast("int")) for i in range(3)]


def minute_of_day(time: Column) -> Column:
    """`60 * H + m` of a well-formed `H:m:s`."""
    hour, minute, _ = time_parts(time)
    return hour.cast("bigint") * 60 + minute


def is_holiday(date: Column, holidays: DataFrame | Iterable) -> Column:
    """Membership in a calendar given as dates, or as a DataFrame whose first column is a date.

    A calendar holds at most one entry per day, so the DataFrame form becomes one small array in a
    scalar subquery: no join touches the tickets.
    """
    if isinstance(holidays, DataFrame):
        day = F.col(holidays.columns[0]).cast("date")
        return F.array_contains(holidays.agg(F.collect_set(day)).scalar(), date.cast("date"))
    days = [d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in holidays]
    return date.cast("date").isin(days) if days else F.lit(False)


def working_hours_band(
    date: Column, time: Column, holidays: DataFrame | Iterable
) -> Column:
    """`HO` / `HNO` band of a date and an `H:m:s` text.

    A missing input wins over everything, then holidays and weekends (whatever the time says), then
    a malformed time, then the clock. Seconds never move the border.
    """
    minute = minute_of_day(time)
    opening, closing = WORKING_MINUTES
    return (
        F.when(date.isNull() | time.isNull(), UNKNOWN)
        .when(is_holiday(date, holidays) | (F.weekday(date) >= 5), OFF_HOURS)
        .when(~well_formed(time), INVALID)
        .when((minute >= opening) & (minute < closing), WORKING)
        .otherwise(OFF_HOURS)
    )


def shift_band(time: Column) -> Column:
    """Shift of an `H:m:s` text: morning, afternoon, and everything else at night."""
    minute = minute_of_day(time)
    morning, afternoon, night = SHIFT_MINUTES
    return (
        F.when(time.isNull(), UNKNOWN)
        .when(~well_formed(time), INVALID)
        .when((minute >= morning) & (minute < afternoon), SHIFTS[0])
        .when((minute >= afternoon) & (minute < night), SHIFTS[1])
        .otherwise(SHIFTS[2])
    )
