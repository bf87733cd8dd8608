"""Rows split into good and bad ones in one pass."""

from collections import Counter

from pyspark.sql import types as T

from ticketlake.sources import readers

SCHEMA = T.StructType().add("id", T.IntegerType()).add("day", T.DateType()).add("note", T.StringType())
RULES = {"no id": "id IS NULL", "old": "day < DATE '2000-01-01'", "never known": "CAST(NULL AS boolean)"}


def extract(spark, tmp_path, lines):
    path = tmp_path / "x.csv"
    path.write_text("\n".join(["id,day,note", *lines]) + "\n")
    return readers.read_csv(spark, str(path), SCHEMA, keep_corrupt=True)


def test_all_rows_are_on_one_side(spark, tmp_path):
    lines = ["1,2024-01-01,a", "1,2024-01-01,a", "x,2024-01-01,b", "2,31/12/2024,c", "3,1999-01-01,d", ",1999-01-01,e", "4,,f"]
    split = readers.quarantine(extract(spark, tmp_path, lines), RULES, str(tmp_path / "q"))
    assert split.good.columns == ["id", "day", "note"]
    assert Counter(r.note for r in split.good.collect()) == {"a": 2, "f": 1}
    bad = {r.note: (r._reasons, r[readers.CORRUPT]) for r in split.bad.collect()}
    assert bad == {
        "b": (["malformed", "no id"], lines[2]), "c": (["malformed"], lines[3]), "d": (["old"], None),
        "e": (["no id", "old"], None)}
    assert split.counts == {"rows": 7, "bad": 4, "malformed": 2, "no id": 2, "old": 2, "never known": 0}
    # a repeated load replaces what it wrote
    again = readers.quarantine(extract(spark, tmp_path, lines[:3]), RULES, str(tmp_path / "q"))
    assert (again.good.count(), again.bad.count()) == (2, 1)


def test_empty_extract_and_no_rules(spark, tmp_path):
    split = readers.quarantine(extract(spark, tmp_path, []), RULES, str(tmp_path / "q"))
    assert (split.good.count(), split.bad.count(), split.counts["rows"]) == (0, 0, 0)
    plain = spark.createDataFrame([(1, "a"), (None, "b")], "id int, `a.b` string")
    split = readers.quarantine(plain, {}, str(tmp_path / "r"))
    assert (split.good.count(), split.bad.count(), split.counts) == (2, 0, {"rows": 2, "bad": 0})


def test_the_source_is_scanned_once(spark, tmp_path):
    df = extract(spark, tmp_path, [f"{i},2024-01-01,n" for i in range(50)])
    judged = readers.judged(df, RULES)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan
    split = readers.quarantine(df, RULES, str(tmp_path / "q"))
    bad = split.bad._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bad" in bad and "FileScan csv" not in bad
