"""Working time against a count of every second's day, and its plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ticketlake.functions.working_time import working_seconds

HOLIDAYS = [dt.date(2024, 5, 1), dt.date(2024, 5, 9), dt.date(2024, 5, 11), dt.date(2024, 12, 25), dt.date(2025, 1, 1)]


def by_day(start, end, holidays, opening=510, closing=1110):
    """Working seconds, day by day."""
    if start is None or end is None:
        return None
    if end < start:
        return -by_day(end, start, holidays, opening, closing)
    total, day = 0, start.date()
    while day <= end.date():
        if day.weekday() < 5 and day not in holidays:
            midnight = dt.datetime.combine(day, dt.time())
            lo = max(start, midnight + dt.timedelta(minutes=opening))
            hi = min(end, midnight + dt.timedelta(minutes=closing))
            total += max(0, int((hi - lo).total_seconds()))
        day += dt.timedelta(days=1)
    return total


def intervals(n=400):
    rng = random.Random(8)
    start = dt.datetime(2024, 4, 20)
    out = [(start + dt.timedelta(seconds=a), start + dt.timedelta(seconds=a + rng.choice([60, 90_000, 3_000_000, -200_000, 30_000_000])))
           for a in (rng.randrange(30_000_000) for _ in range(n))]
    edge = dt.datetime(2024, 5, 2, 8, 30)
    out += [(edge, edge.replace(hour=18)), (edge, edge.replace(hour=23)), (edge.replace(day=1), edge), (edge, edge),
            (None, edge), (edge, None), (dt.datetime(1950, 3, 3, 3), edge), (edge, dt.datetime(2090, 1, 1, 12))]
    return out


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("as_table", [False, True])
def test_equals_a_sum_over_days(spark, kind, as_table):
    rows = [(i, a, b) for i, (a, b) in enumerate(intervals())]
    df = spark.createDataFrame(rows, "i int, a timestamp_ntz, b timestamp_ntz")
    df = df.select("i", F.col("a").cast(kind), F.col("b").cast(kind))
    # repeated and missing days of a table count for nothing
    calendar = spark.createDataFrame([(d,) for d in HOLIDAYS * 2] + [(None,)], "d date") if as_table else HOLIDAYS
    found = {r.i: r.s for r in df.select("i", working_seconds(F.col("a"), F.col("b"), calendar).alias("s")).collect()}
    assert found == {i: by_day(a, b, HOLIDAYS) for i, a, b in rows}


def test_without_holidays_and_with_other_hours(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(intervals(60))]
    df = spark.createDataFrame(rows, "i int, a timestamp_ntz, b timestamp_ntz")
    found = {r.i: r.s for r in df.select("i", working_seconds(F.col("a"), F.col("b"), [], (0, 1440)).alias("s")).collect()}
    assert found == {i: by_day(a, b, [], 0, 1440) for i, a, b in rows}


def test_tickets_meet_no_join_and_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, *intervals(1)[0])], "i int, a timestamp_ntz, b timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path).select("i", working_seconds(F.col("a"), F.col("b"), HOLIDAYS).alias("s"))
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    outer = "\n".join(line for line in lines if not line.lstrip().startswith(":"))  # the rest belongs to subqueries
    assert "Scan parquet" in outer
    assert "Generate" not in outer and "Join" not in outer and "Exchange" not in outer
