import collections
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from ticketlake import schemas
from ticketlake.operators import clean, dims, facts, quality
from ticketlake.operators.keys import global_row_number
from ticketlake.operators.latest import latest_per_key
from ticketlake.operators.upsert import upsert
from ticketlake.session import scratch_path
from ticketlake.sources import readers, tables
from ticketlake.plans.jobs import latest_at

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


# --- cleaning and reading -----------------------------------------------------------------------------
def test_rename_ignores_unknown_names(spark):
    df = spark.createDataFrame([(1,)], "`Numéro` int")
    assert clean.rename_columns(df, {"Numéro": "Numero", "Absent": "X"}).columns == ["Numero"]


def test_predicates_and_order(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 2), ("b", 0)], "k string, v int")
    assert rows(clean.filter_eq(df, "k", "a")) == [("a", None), ("a", 1)]
    assert rows(clean.keep_closed(df, ["k", "v"])) == [("a", 1), ("b", 0)]
    assert [tuple(r) for r in clean.ordered(df, ["k", "v"]).collect()] == [(None, 2), ("a", None), ("a", 1), ("b", 0)]
    assert [tuple(r) for r in clean.top_n(df, ["v"], 2).collect()] == [("a", None), ("b", 0)]


def test_csv_binds_by_position_and_keeps_bad_rows(spark):
    folder = scratch_path(spark, "csv")
    text = "anything;really\n2025-01-02;Shift 1\nbad;Shift 2\n2025-01-02 08:30:00;Shift 3\n"
    spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.text(folder)
    schema = schemas.schema(("Ouvert", schemas.D), ("Plage_horaire", schemas.S))
    read = readers.read_csv(spark, folder, schema, sep=";", keep_corrupt=True)
    got = {r.Plage_horaire: (r.Ouvert, r._corrupt_record is not None) for r in read.collect()}
    day = dt.date(2025, 1, 2)
    assert got == {"Shift 1": (day, False), "Shift 2": (None, True), "Shift 3": (day, False)}


def test_silver_columns(spark):
    deploy = spark.createDataFrame([], schemas.DEPLOYMENTS_CSV)
    request = spark.createDataFrame([], schemas.REQUESTS_CSV)
    assert set(clean.clean_deployments(deploy, []).columns) == set(schemas.DEPLOYMENTS_SILVER.names)
    assert set(clean.clean_requests(request).columns) == set(schemas.REQUESTS_SILVER.names)


def test_catalog_table(spark):
    tables.create_catalog_table(spark, "tl_requests", schemas.REQUESTS_SILVER)
    tables.create_catalog_table(spark, "tl_requests", schemas.REQUESTS_SILVER)
    read = readers.read_table(spark, "tl_requests")
    assert read.schema.names == schemas.REQUESTS_SILVER.names and read.count() == 0
    spark.sql("DROP TABLE tl_requests")


# --- quality ------------------------------------------------------------------------------------------
DATA = [("a", 1, None), ("a", 1, None), ("a", 2, "x"), (None, 1, ""), (None, 1, "")]


def frame(spark, data=DATA):
    return spark.createDataFrame(data, "k string, v int, t string")


def test_counts(spark):
    df = frame(spark)
    assert rows(quality.null_counts(df)) == [(2, 0, 2)]
    assert rows(quality.null_or_empty_counts(df)) == [(2, 0, 4)]
    assert rows(quality.duplicate_report(df)) == [(5, 3, 2, "2 duplicates")]
    assert rows(quality.duplicate_report(df.distinct())) == [(3, 3, 0, "none")]
    assert rows(quality.cardinality(df, "k")) == [(2,)]
    assert rows(quality.value_counts(df, ["k"])) == [(None, 2), ("a", 3)]
    assert rows(quality.required(df, ["k", "v", "t"])) == [("k", 2), ("t", 2)]
    assert rows(quality.profile(df)) == [(5, 2, 0, 2, 0, 2)]


def test_counts_of_an_empty_frame_are_zero(spark):
    empty = frame(spark, [])
    assert rows(quality.null_counts(empty)) == [(0, 0, 0)]
    assert rows(quality.duplicate_count(empty)) == [(0, 0, 0)]
    assert rows(quality.cardinality(empty, "k")) == [(0,)]


def test_duplicate_groups(spark):
    df = frame(spark)
    assert rows(quality.duplicate_keys(df, ["k", "v"])) == [(None, 1, 2), ("a", 1, 2)]
    assert rows(quality.duplicate_rows(df, ["k", "v"])) == [("a", 1, None, 2)] * 2
    assert len(rows(quality.dedup(df))) == 3
    assert rows(quality.dedup_keys(df, ["k"], [F.desc("v")])) == [(None, 1, ""), ("a", 2, "x")]


def test_assert_not_null(spark):
    good = frame(spark).filter("k IS NOT NULL")
    assert quality.assert_not_null(good, ["k"]).count() == 3
    with pytest.raises(Exception, match="required column k"):
        quality.assert_not_null(frame(spark), ["k"]).collect()


# --- keys and dimensions --------------------------------------------------------------------------------
@few
@given(labels=st.sets(st.one_of(st.none(), st.text("abcAé ", max_size=4)), max_size=60), buckets=st.sampled_from([2, 5, 256]))
def test_row_numbers_are_dense_and_in_order(spark, labels, buckets):
    df = spark.createDataFrame([(label,) for label in labels], "lab string")
    got = global_row_number(df, F.col("lab"), "n", buckets).collect()
    order = sorted(labels, key=lambda v: (v is not None, (v or "").encode()))
    assert sorted((r.n, r.lab) for r in got) == list(enumerate(order, 1))


def dim(spark, labels, existing=None):
    members = spark.createDataFrame([(label,) for label in labels], "lab string").distinct()
    return dims.extend_dim(members, existing, "lab", "id")


def test_keys_survive_later_loads(spark):
    first = dim(spark, ["b", "a", None, "b"])
    assert rows(first) == [(1, None), (2, "a"), (3, "b")]
    second = dim(spark, ["c", None, "aa", "b"], first)
    assert rows(second) == [(1, None), (2, "a"), (3, "b"), (4, "aa"), (5, "c")]
    assert rows(dim(spark, ["c", None, "aa", "b"], second)) == rows(second)


def test_null_safe_choice_of_new_members(spark):
    known = spark.createDataFrame([("a",), (None,)], "lab string")
    incoming = spark.createDataFrame([("a",), ("b",), (None,)], "lab string")
    assert rows(dims.new_members(incoming, known, "lab")) == [("b",)]
    assert rows(dims.new_members(incoming, known, "lab", null_safe=False)) == [(None,), ("b",)]


def test_group_types(spark):
    lookup = spark.createDataFrame([("g1", "Exploitation"), ("g1", "Supervision"), ("g2", "Supervision")], "label string, type string")
    groups = spark.createDataFrame([("g1",), ("g2",), ("g3",), (None,)], "Groupe_affectation string")
    assert rows(dims.group_type(groups, lookup)) == [
        (None, "Autre"), ("g1", "Exploitation"), ("g2", "Supervision"), ("g3", "Autre")]
    first = dims.dim_group(groups.filter("Groupe_affectation IS NULL OR Groupe_affectation <> 'g3'"), lookup)
    assert rows(first) == [(1, None, "Autre"), (2, "g1", "Exploitation"), (3, "g2", "Supervision")]
    revised = spark.createDataFrame([("g1", "Supervision")], "label string, type string")
    assert rows(dims.dim_group(groups, revised, first)) == [
        (1, None, "Autre"), (2, "g1", "Supervision"), (3, "g2", "Autre"), (4, "g3", "Autre")]


def test_date_dim_takes_the_earliest_good_time(spark):
    day = [dt.date(2025, 3, d) for d in (1, 2, 3)]
    df = spark.createDataFrame(
        [(day[0], "10:00:05"), (day[0], "09:59:00"), (day[0], "xx"), (day[1], "25:00:00"), (day[1], None), (day[2], "00:00:00")],
        "d date, t string")
    assert rows(dims.date_dim_from_date(df, "d", "t")) == [
        (day[0], 1, 3, 2025, 9, 59, 0), (day[1], 2, 3, 2025, None, None, None), (day[2], 3, 3, 2025, 0, 0, 0)]


def test_star_lookup_keeps_unmatched_rows(spark):
    fact = spark.createDataFrame([("n1", "a"), ("n2", "zz"), ("n3", None)], "n string, lab string")
    known = spark.createDataFrame([(1, "a"), (2, None)], "id long, lab string")
    got = facts.star_lookup(fact, {"d": known}, [facts.Lookup("d", "lab", "lab", "id")], ["n"])
    assert rows(got) == [("n1", 1), ("n2", None), ("n3", None)]


# --- upsert -----------------------------------------------------------------------------------------------
UPSERT_SCHEMA = "k string, at int, v string"


def merged_by_hand(target, updates, update_cols, null_safe=True):
    state = {row[0]: list(row) for row in target}
    best = {}
    for row in updates:
        rank = (row[1] if row[1] is not None else -1)
        old = best.get(row[0])
        if old is None or rank > old[0] or (rank == old[0] and (row[2] is not None, row[2] or "") < old[1]):
            best[row[0]] = (rank, (row[2] is not None, row[2] or ""), row)
    for key, (_, _, row) in best.items():
        if key in state:
            for i, name in enumerate(["k", "at", "v"]):
                if name in update_cols:
                    state[key][i] = row[i]
        else:
            state[key] = list(row)
    return collections.Counter(tuple(r) for r in state.values())


keys = st.one_of(st.none(), st.sampled_from("abcdefg"))
record = st.tuples(keys, st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from("xyz")))


@few
@given(target=st.lists(record, max_size=8, unique_by=lambda r: r[0]), updates=st.lists(record, max_size=25),
       cols=st.sampled_from([["at", "v"], ["v"], []]))
def test_upsert_matches_brute_force_and_is_idempotent(spark, target, updates, cols):
    t = spark.createDataFrame(target, UPSERT_SCHEMA)
    u = spark.createDataFrame(updates, UPSERT_SCHEMA)
    want = merged_by_hand(target, updates, cols)
    once = upsert(t, u, ["k"], cols, latest_by=["at"])
    assert collections.Counter(map(tuple, once.collect())) == want
    twice = upsert(once, u, ["k"], cols, latest_by=["at"])
    assert collections.Counter(map(tuple, twice.collect())) == want


def test_upsert_without_null_safety_inserts_every_null_key(spark):
    t = spark.createDataFrame([(None, 1, "x"), ("a", 1, "x")], UPSERT_SCHEMA)
    u = spark.createDataFrame([(None, 2, "y"), (None, 2, "y"), ("a", 2, "y")], UPSERT_SCHEMA)
    assert rows(upsert(t, u, ["k"], latest_by=["at"], null_safe=False)) == [
        (None, 1, "x"), (None, 2, "y"), (None, 2, "y"), ("a", 2, "y")]


def test_upsert_maps_columns_and_keeps_newer_rows(spark):
    t = spark.createDataFrame([("a", 5, "old"), ("b", 1, "old")], UPSERT_SCHEMA)
    u = spark.createDataFrame([("a", 4, "new"), ("b", 2, "new"), ("c", 3, "new")], "key string, at int, w string")
    got = upsert(t, u, [("k", "key")], {"v": "w", "at": "at"}, {"v": "w"}, latest_by=["at"], keep_newer=True)
    assert rows(got) == [("a", 5, "old"), ("b", 2, "new"), ("c", None, "new")]


def test_latest_row_by_real_time(spark):
    """Unpadded times compare as times, malformed ones are oldest, on both sides of a merge."""
    schema = "k string, d date, t string, v string"
    day = dt.date(2025, 1, 2)
    u = spark.createDataFrame([("a", day, "9:05:00", "old"), ("a", day, "10:00:00", "new"), ("a", day, "ab:cd:ef", "bad"),
                               ("b", day, "bad", "later date"), ("b", dt.date(2025, 1, 1), None, "earlier"),
                               ("c", day, "9:00:00", "late"), ("d", day, "25:00:00", "bad")], schema)
    order = latest_at("d", "t")
    assert dict(rows(latest_per_key(u, ["k"], order), "k", "v")) == {
        "a": "new", "b": "later date", "c": "late", "d": "bad"}
    t = spark.createDataFrame([("a", day, "10:00:01", "kept"), ("b", day, "bad", "tie"), ("c", day, "xx", "broken"),
                               ("d", day, "1:00:00", "kept")], schema)
    merged = upsert(t, u, ["k"], latest_by=order, keep_newer=True)
    assert dict(rows(merged, "k", "v")) == {"a": "kept", "b": "later date", "c": "late", "d": "kept"}


def test_latest_row_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), (None, None, "x"), (None, 3, "x")], UPSERT_SCHEMA)
    assert rows(latest_per_key(df, ["k"], ["at"])) == [(None, 3, "x"), ("a", 2, "y")]


# --- tables -------------------------------------------------------------------------------------------------
def test_overwrite_reads_the_table_it_replaces_and_changes_its_schema(spark):
    path = scratch_path(spark, "t")
    tables.overwrite_path(spark.createDataFrame([("a", 1), ("a", 1)], "k string, v int"), path)
    tables.overwrite_path(tables.read_path(spark, path).dropDuplicates(), path)
    assert rows(tables.read_path(spark, path)) == [("a", 1)]
    tables.rename_overwrite(spark, path, {"k": "key"})
    assert tables.read_path(spark, path).columns == ["key", "v"]
    tables.overwrite_path(tables.read_path(spark, path).filter("v > 5"), path)
    assert tables.read_path(spark, path).columns == ["key", "v"] and tables.read_path(spark, path).count() == 0


def test_a_lost_job_leaves_the_table_as_it_was(spark):
    path = scratch_path(spark, "t")
    tables.overwrite_path(spark.createDataFrame([("a", 1)], "k string, v int"), path, tables.Layout(["k"], 4))
    broken = spark.createDataFrame([("a", 2), ("b", 0)], "k string, v int").withColumn(
        "v", F.when(F.col("v") > 0, F.col("v")).otherwise(F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_path(broken, path, tables.Layout(["k"], 4))
    assert rows(tables.read_path(spark, path)) == [("a", 1)]
    tables.upsert_table(spark, path, spark.createDataFrame([("b", 3)], "k string, v int"), ["k"])
    assert rows(tables.read_path(spark, path)) == [("a", 1), ("b", 3)]


def test_stored_upsert_equals_the_function(spark):
    t = spark.createDataFrame([(None, 1, "x")] + [(f"k{i}", i % 3, "x") for i in range(40)], UPSERT_SCHEMA)
    u = spark.createDataFrame([(None, 2, "y")] + [(f"k{i}", i % 5, "y") for i in range(30, 60)] * 2, UPSERT_SCHEMA)
    path = scratch_path(spark, "t")
    tables.overwrite_path(t, path, tables.Layout(["k"], 8))
    tables.upsert_table(spark, path, u, ["k"], latest_by=["at"])
    want = rows(upsert(t, u, ["k"], latest_by=["at"]))
    assert rows(tables.read_path(spark, path)) == want
    tables.upsert_table(spark, path, u, ["k"], [], latest_by=["at"])
    assert rows(tables.read_path(spark, path)) == want
    # a catalog that has lost the table finds it again in its folder
    schema, layout = tables._definition(spark, path)
    spark.sql(f"DROP TABLE {tables.table_name(path)}")
    with pytest.raises(FileNotFoundError):
        tables.read_path(spark, path)
    tables.ensure_table(spark, path, schema, layout)
    assert rows(tables.read_path(spark, path)) == want


def test_ages_are_compared_in_the_types_of_the_table(spark):
    """Stored as `timestamp`, updated by `timestamp_ntz`, texts and a newer or an older moment."""
    target = spark.sql("SELECT 'a' AS k, TIMESTAMP '2025-01-02 08:00:00' AS at, 'old' AS v")
    for kind, moment, want in [("TIMESTAMP_NTZ", "2025-01-02 09:00:00", "new"), ("TIMESTAMP_NTZ", "2025-01-02 07:00:00", "old"),
                               ("STRING", "2025-01-02 10:00:00", "new"), ("STRING", "2025-01-02 1:00:00", "old")]:
        update = spark.sql(f"SELECT 'a' AS k, CAST('{moment}' AS {kind}) AS at, 'new' AS v")
        merged = upsert(target, update, ["k"], latest_by=["at"], keep_newer=True)
        assert merged.schema["at"].dataType == target.schema["at"].dataType and merged.first()["v"] == want


def test_bucket_key_must_be_part_of_the_merge_key(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([("a", 1, "x")], UPSERT_SCHEMA)
    tables.overwrite_path(df, path, tables.Layout(["k"], 4))
    with pytest.raises(ValueError, match="not part of the merge key"):
        tables.upsert_table(spark, path, df, ["at"])


def test_a_row_that_changes_its_period_moves(spark):
    """Merging by key alone finds the old row in whatever period it lives."""
    path = scratch_path(spark, "t")
    schema = schemas.schema(("k", schemas.S), ("d", schemas.D), ("v", schemas.I))
    day = dt.date(2025, 1, 1)
    start = [(f"k{i}", day + dt.timedelta(days=40 * i), 0) for i in range(6)] + [("none", None, 0)]
    tables.ensure_table(spark, path, schema, tables.Layout(["k"], 2, "d", 30))
    tables.upsert_table(spark, path, spark.createDataFrame(start, schema), ["k"])
    moved = [("k0", day + dt.timedelta(days=200), 1), ("none", day, 1), ("new", None, 1)]
    for _ in range(2):
        tables.upsert_table(spark, path, spark.createDataFrame(moved, schema), ["k"])
        want = {**{r[0]: r for r in start}, **{r[0]: r for r in moved}}
        assert rows(tables.read_path(spark, path)) == rows(spark.createDataFrame(list(want.values()), schema))
    tables.upsert_table(spark, path, spark.createDataFrame(moved + [("k9", day, 5)], schema), ["k"], [])
    assert tables.read_path(spark, path).count() == 9
    kept = spark.createDataFrame([("k1", day, 7)], schema)
    tables.upsert_table(spark, path, kept, ["k"], ["v"])  # the date stays, so the row stays in place
    assert tables.read_path(spark, path).filter("k = 'k1'").first()[1:] == (day + dt.timedelta(days=40), 7)
