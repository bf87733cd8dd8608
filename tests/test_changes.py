"""What a merge changes, and totals that follow from it."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ticketlake import schemas
from ticketlake.operators.incremental import deltas, folded
from ticketlake.operators.upsert import changed_rows, merge_changes, upsert
from ticketlake.session import scratch_path
from ticketlake.sources import tables

ROW = "k string, g string, at int, v string"
TARGET = [("a", "x", 1, "old"), ("b", None, 5, "old"), ("c", "x", 1, "same"), (None, None, 1, "null key"), ("d", "y", None, "old")]
UPDATES = [("a", "x", 2, "new"), ("a", "x", 1, "older"), ("b", None, 3, "too old"), ("c", "x", 1, "same"), ("e", "z", 1, "first"),
           ("e", "z", 1, "first"), (None, None, 2, "null key"), ("d", "y", None, "new"), ("d", None, 1, "other key")]


def frames(spark):
    return spark.createDataFrame(TARGET, ROW), spark.createDataFrame(UPDATES, ROW)


@pytest.mark.parametrize("keep_newer", [True, False])
def test_changes_lead_from_the_target_to_the_merged_table(spark, keep_newer):
    target, updates = frames(spark)
    how = {"latest_by": ["at"], "keep_newer": keep_newer}
    merged = upsert(target, updates, ["k", "g"], **how)
    changes = merge_changes(target, updates, ["k", "g"], **how)
    before = rows(changes.filter("op = 'update'").select("before.*"))
    after = rows(changed_rows(changes))
    unchanged = [r for r in rows(target) if r not in before]
    assert sorted(unchanged + after, key=str) == sorted(rows(merged), key=str)
    assert ("c", "x", 1, "same") not in after and len(after) == (5 if keep_newer else 6)
    assert changes.filter("op = 'insert'").select("before").first()[0] is None
    assert changes.columns == ["k", "g", "op", "before", "after"]


def test_changes_of_an_insert_only_merge_and_of_empty_sides(spark):
    target, updates = frames(spark)
    assert rows(merge_changes(target, updates, ["k", "g"], []).select("k", "op")) == [("d", "insert"), ("e", "insert")]
    assert merge_changes(target, updates.limit(0), ["k", "g"]).count() == 0
    assert merge_changes(target.limit(0), updates, ["k", "g"]).filter("op = 'insert'").count() == 7


def test_a_stored_merge_tells_its_changes(spark):
    target, updates = frames(spark)
    path, feed = scratch_path(spark, "t"), scratch_path(spark, "changes")
    tables.overwrite_path(target, path, tables.Layout(["k"], 3))
    for i in range(2):
        tables.upsert_table(spark, path, updates, ["k", "g"], latest_by=["at"], changes_to=f"{feed}/{i}")
    found = [spark.read.parquet(f"{feed}/{i}") for i in range(2)]
    want = merge_changes(target, updates, ["k", "g"], latest_by=["at"])
    assert rows(found[0].select("op", "after.*")) == rows(want.select("op", "after.*"))
    assert found[1].count() == 0  # the same extract again changes nothing
    with pytest.raises(ValueError, match="null-safe"):
        tables.upsert_table(spark, path, updates, ["k"], null_safe=False, changes_to=f"{feed}/3")


def test_totals_follow_the_changes_and_read_no_unchanged_row(spark):
    """Counts, sums and a condition over three random loads equal those of the merged table."""
    schema = schemas.schema(("k", schemas.I), ("state", schemas.S), ("hours", schemas.I))
    by, sums = {"state": lambda r: r["state"]}, {"hours": lambda r: r["hours"]}
    table, totals, closed = spark.createDataFrame([], schema), None, None
    for seed in range(3):
        load = spark.range(60).select(
            (F.col("id") * 7 % (40 + 10 * seed)).cast("int").alias("k"),
            F.when((F.col("id") + seed) % 4 > 0, F.concat(F.lit("s"), (F.col("id") * (seed + 1)) % 3)).alias("state"),
            F.when((F.col("id") + seed) % 5 > 0, F.col("id")).cast("int").alias("hours"))
        changes = spark.createDataFrame(merge_changes(table, load, ["k"]).collect(), merge_changes(table, load, ["k"]).schema)
        table = spark.createDataFrame(upsert(table, load, ["k"]).collect(), schema)
        totals = folded(totals, deltas(changes, by, sums), ["state"])
        closed = folded(closed, deltas(changes, {}, sums, lambda r: r["state"] == "s1"), [])
        want = table.groupBy("state").agg(F.count("*").alias("n"), F.coalesce(F.sum("hours"), F.lit(0)).alias("hours"))
        assert rows(totals) == rows(want)
        of_s1 = table.filter("state = 's1'").agg(F.count("*").alias("n"), F.coalesce(F.sum("hours"), F.lit(0)))
        assert rows(closed) == rows(of_s1.filter("n > 0"))  # a group without rows goes
        plan = totals._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan  # totals and changes are all it reads
