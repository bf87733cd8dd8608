import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketlake.functions.bands import HOLIDAYS_2025, shift_band, working_hours_band
from ticketlake.functions.times import at_time, elapsed_seconds, second_of_day

WEEKDAY, SATURDAY, HOLIDAY = dt.date(2025, 1, 2), dt.date(2025, 1, 4), dt.date(2025, 5, 1)

HOURS_CASES = [
    (WEEKDAY, "08:29:59", "HNO"), (WEEKDAY, "08:30:00", "HO"), (WEEKDAY, "18:29:59", "HO"),
    (WEEKDAY, "18:30:00", "HNO"), (HOLIDAY, "10:00:00", "HNO"), (SATURDAY, "xx", "HNO"),
    (WEEKDAY, "08:30", "Invalide"), (WEEKDAY, "a:b:c", "Invalide"), (WEEKDAY, "25:00:00", "HNO"),
    (None, "10:00:00", "Inconnu"), (SATURDAY, None, "Inconnu"), (None, None, "Inconnu"),
    (WEEKDAY, "10:00:00:00", "Invalide"), (WEEKDAY, "", "Invalide"), (WEEKDAY, " 9: 5:+1", "HO"),
    (WEEKDAY, "9:5:1", "HO"), (WEEKDAY, "10:30:8.5", "Invalide"), (WEEKDAY, "1_0:00:00", "Invalide"),
    (WEEKDAY, "2147483647:59:59", "HNO"), (WEEKDAY, "99999999999:00:00", "HNO"), (WEEKDAY, "9:0:99999999999", "HO"), (WEEKDAY, "-1:00:00", "HNO"),
]
SHIFT_CASES = [
    ("06:59:59", "Shift 3"), ("07:00:00", "Shift 1"), ("14:59:59", "Shift 1"), ("15:00:00", "Shift 2"),
    ("22:59:59", "Shift 2"), ("23:00:00", "Shift 3"), (None, "Inconnu"), ("12", "Invalide"),
    ("1:2:3:4", "Invalide"), ("25:00:00", "Shift 3"),
]


def classify(spark, pairs, holidays=HOLIDAYS_2025):
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(pairs)], "i int, d date, t string")
    out = df.select("i", working_hours_band(F.col("d"), F.col("t"), holidays).alias("h"), shift_band(F.col("t")).alias("s"))
    return [(r.h, r.s) for r in out.orderBy("i").collect()]


def test_working_hours(spark):
    got = classify(spark, [(d, t) for d, t, _ in HOURS_CASES])
    assert [h for h, _ in got] == [band for _, _, band in HOURS_CASES]


def test_shift(spark):
    got = classify(spark, [(WEEKDAY, t) for t, _ in SHIFT_CASES])
    assert [s for _, s in got] == [band for _, band in SHIFT_CASES]


def test_calendar_frame_and_empty_calendar(spark):
    calendar = spark.createDataFrame([(WEEKDAY,), (WEEKDAY,), (None,)], "day date")
    assert classify(spark, [(WEEKDAY, "10:00:00"), (HOLIDAY, "10:00:00")], calendar) == [("HNO", "Shift 1"), ("HO", "Shift 1")]
    assert classify(spark, [(HOLIDAY, "10:00:00")], [])[0][0] == "HO"


def expected(date, time):
    """Brute force over the stated rule for two- or three-part integer times."""
    parts = None if time is None else time.split(":")
    valid = parts is not None and len(parts) == 3
    decimal = int(parts[0]) + int(parts[1]) / 60 if valid else None
    if date is None or time is None:
        hours = "Inconnu"
    elif date.isoformat() in HOLIDAYS_2025 or date.weekday() >= 5:
        hours = "HNO"
    elif not valid:
        hours = "Invalide"
    else:
        hours = "HO" if 8.5 <= decimal < 18.5 else "HNO"
    if time is None:
        return hours, "Inconnu"
    if not valid:
        return hours, "Invalide"
    return hours, "Shift 1" if 7 <= decimal < 15 else "Shift 2" if 15 <= decimal < 23 else "Shift 3"


times = st.one_of(
    st.none(),
    st.builds(lambda h, m, s: f"{h:02d}:{m:02d}:{s:02d}", st.integers(0, 30), st.integers(0, 99), st.integers(0, 59)),
    st.builds(lambda h, m: f"{h}:{m}", st.integers(0, 23), st.integers(0, 59)),
    st.sampled_from(["08:29:59", "08:30:00", "18:29:59", "18:30:00", "07:00:00", "15:00:00", "23:00:00"]),
)
dates = st.one_of(st.none(), st.dates(dt.date(2024, 12, 1), dt.date(2026, 1, 31)))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(dates, times), min_size=50, max_size=200))
def test_bands_match_brute_force(spark, pairs):
    assert classify(spark, pairs) == [expected(d, t) for d, t in pairs]


@pytest.mark.parametrize("text, seconds", [
    ("00:00:00", 0), ("23:59:59", 86399), ("24:00:00", None), ("08:30", None), ("a:b:c", None), (None, None),
    ("10:60:00", None), ("1:2:3", 3723),
])
def test_second_of_day(spark, text, seconds):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(second_of_day(F.col("t"))).first()[0] == seconds


def test_elapsed_over_midnight(spark):
    df = spark.createDataFrame([(WEEKDAY, "23:59:00", SATURDAY, "00:01:30")], "a date, ta string, b date, tb string")
    start, end = at_time(F.col("a"), F.col("ta")), at_time(F.col("b"), F.col("tb"))
    assert df.select(elapsed_seconds(start, end)).first()[0] == 86400 + 150
