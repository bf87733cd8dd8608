"""The physical plans that make the operators hold at scale."""

import bisect
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ticketlake import schemas
from ticketlake.functions.bands import shift_band, working_hours_band
from ticketlake.operators import clean, dims, facts, quality
from ticketlake.operators.keys import SAMPLES_PER_RANGE, global_row_number
from ticketlake.operators.latest import latest_per_key
from ticketlake.plans import fixtures as fx
from ticketlake.plans import star
from ticketlake.plans.queries import QUERIES
from ticketlake.session import scratch_path
from ticketlake.sources import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan AQE ended with after running the query."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k.replace("__", "."), None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key.replace("__", "."), value)
    try:
        yield
    finally:
        for key, value in old.items():
            name = key.replace("__", ".")
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


SMALL_SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
}


def hot(spark, n=60000):
    """A third of all rows on one key."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("payload"), F.col("id").alias("at"))


def test_no_registered_query_leaves_the_jvm_or_crosses_tables(spark, sf):
    for name, query in QUERIES.items():
        text = plan(query(spark, sf))
        for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoop"):
            assert node not in text, (name, node)


def test_duplicate_rows_split_a_hot_key(spark):
    with settings(spark, **SMALL_SKEW):
        result = quality.duplicate_rows(hot(spark), ["k"])
        text = final_plan(result)
    assert "skew=true" in text and "Window" not in text
    assert result.count() == 20001  # and the row whose own id is 7


def test_star_lookup_splits_a_hot_label_beyond_the_broadcast_limit(spark):
    rows = hot(spark).select(F.col("k").cast("string").alias("lab"), "payload")
    dim = spark.range(0, 60000, 1, 8).select(F.col("id").cast("string").alias("lab"), F.col("id").alias("ID"))
    with settings(spark, **SMALL_SKEW):
        result = facts.star_lookup(rows, {"d": dim}, [facts.Lookup("d", "lab", "lab", "ID")], ["payload"])
        text = final_plan(result)
    assert "skew=true" in text
    assert result.count() == 60000


def test_latest_row_prunes_a_hot_key_before_the_shuffle(spark):
    text = plan(latest_per_key(hot(spark), ["k"], ["at"]))
    assert "Partial" in text[text.index("Exchange"):] and "WindowGroupLimit" in text


def test_star_lookup_of_stored_dims_does_not_shuffle_the_fact(spark, sf):
    fact, _ = star.incident_star(spark, sf)
    text = plan(fact)
    assert text.count("BroadcastHashJoin") == 8  # two joins of the source view, six lookups
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


def stage_reads(spark) -> dict[int, int]:
    """Rows read from files by each recent stage."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(
        None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {stages.apply(i).stageId(): stages.apply(i).inputRecords() for i in range(stages.size())}


def test_key_assignment_reads_its_source_once_and_gathers_no_labels(spark, sf):
    orders = fx.table(spark, sf, "orders")
    members = orders.select(F.col("o_custkey").cast("string").alias("lab")).distinct()
    latest = max(stage_reads(spark), default=-1)
    keyed = dims.extend_dim(members, None, "lab", "id").collect()
    assert sum(n for stage, n in stage_reads(spark).items() if stage > latest) == orders.count()
    assert len(keyed) == members.count()
    text = plan(dims.extend_dim(members, None, "lab", "id"))
    # one task only ever sees the take of the sample and one partial list per map task of range sizes
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert f"TakeOrderedAndProject(limit={ranges * SAMPLES_PER_RANGE}" in text
    assert all("partial_collect_list" in rest[:400] for rest in text.split("Exchange SinglePartition")[1:])
    assert "Join" not in text and "Filter (" not in text


@pytest.mark.parametrize("partitions", [5, 40])
def test_key_ranges_follow_the_partition_setting(spark, partitions):
    with settings(spark, **{"spark.sql.shuffle.partitions": str(partitions)}):
        labels = spark.range(30_000).select(F.md5(F.col("id").cast("string")).alias("lab"))
        keyed = global_row_number(labels, F.col("lab"), "n")
        assert f"TakeOrderedAndProject(limit={partitions * SAMPLES_PER_RANGE}" in plan(keyed)
        sample = labels.orderBy(F.md5(F.to_json(F.struct(F.col("lab").alias("__order")))), "lab").limit(partitions * SAMPLES_PER_RANGE)
        cuts = sorted(r.lab for r in sample.collect())
        cuts = [cuts[int(i * len(cuts) / partitions)] for i in range(1, partitions)]
        sizes = [0] * partitions
        for r in labels.collect():
            sizes[bisect.bisect_right(cuts, r.lab)] += 1
        assert max(sizes) < 2 * 30_000 / partitions
        assert [r.n for r in keyed.orderBy("lab").collect()] == list(range(1, 30_001))


def test_filters_and_columns_reach_the_scan(spark, sf):
    dim = dims.distinct_members(fx.table(spark, sf, "orders"), "o_orderpriority")
    assert "ReadSchema: struct<o_orderpriority:string>" in plan(dim)
    filtered = clean.filter_eq(fx.table(spark, sf, "orders"), "o_orderstatus", "F").select("o_orderkey")
    text = plan(filtered)
    assert "EqualTo(o_orderstatus,F)" in text and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_bands_stay_in_generated_code(spark, sf):
    df = fx.deployments_raw(spark, sf).select(
        working_hours_band(F.col("Ouvert"), F.col("Ovrt_h"), fx.HOLIDAYS).alias("a"), shift_band(F.col("Ovrt_h")).alias("b"))
    assert "*(1) Project" in final_plan(df)


def test_top_n_is_a_bounded_take(spark, sf):
    assert "TakeOrderedAndProject" in plan(clean.top_n(fx.table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 5))


def test_duplicate_count_combines_before_the_shuffle(spark, sf):
    text = plan(quality.duplicate_count(fx.shift(spark, sf)))
    assert text.count("partial_count") >= 2


def test_upsert_rewrites_only_touched_periods(spark, sf):
    rows = fx.incidents(spark, sf)
    path = scratch_path(spark, "periods")
    tables.ensure_table(spark, path, rows.schema, tables.Layout(["Numero"], 2, "Ouvert", 200))
    tables.upsert_table(spark, path, rows, ["Numero"], latest_by=["Mis_a_jour"])
    before = set(tables.read_path(spark, path).inputFiles())
    one = rows.orderBy("Numero").limit(1).withColumn("Etat", F.lit("changed"))
    tables.upsert_table(spark, path, one, ["Numero"], latest_by=["Mis_a_jour"])
    after = set(tables.read_path(spark, path).inputFiles())
    assert {f.split("/")[-2] for f in before - after} == {f.split("/")[-2] for f in after - before}
    assert len({f.split("/")[-2] for f in after - before}) == 1 and before & after
    stored = tables.read_path(spark, path)
    assert stored.count() == rows.count() and stored.filter("Etat = 'changed'").count() == 1


def test_a_date_filter_prunes_periods(spark, sf):
    rows = fx.incidents(spark, sf)
    path = scratch_path(spark, "periods")
    tables.ensure_table(spark, path, rows.schema, tables.Layout(["Numero"], 2, "Ouvert", 30))
    tables.upsert_table(spark, path, rows, ["Numero"])
    first, last = rows.agg(F.min("Ouvert"), F.max("Ouvert")).first()
    middle = rows.filter(F.col("Ouvert") >= F.lit(first + (last - first) / 2)).agg(F.min("Ouvert")).first()[0].date()
    for since, until in [(middle, None), (None, middle), (middle, middle)]:
        found = tables.read_path(spark, path, since, until)
        own = F.col("Ouvert").cast("date")
        want = rows.filter((own >= F.lit(since or first.date())) & (own <= F.lit(until or last.date())))
        assert found.count() == want.count() > 0
        text = plan(found)
        filters = text[text.index("PartitionFilters: ["):].split("]")[0]
        assert tables.PERIOD in filters
    assert len(found.inputFiles()) < len(tables.read_path(spark, path).inputFiles()) / 4


@pytest.mark.parametrize("buckets", [3, 16])
def test_a_merge_shuffles_the_updates_only(spark, sf, buckets, monkeypatch):
    rows = fx.incidents(spark, sf)
    path = scratch_path(spark, "buckets")
    tables.ensure_table(spark, path, rows.schema, tables.Layout(["Numero"], buckets, "Ouvert", 400))
    tables.upsert_table(spark, path, rows, schemas.INCIDENT_KEYS)
    plans, replace = [], tables._replace
    monkeypatch.setattr(tables, "_replace", lambda df, *how: (plans.append(plan(df)), replace(df, *how)))
    tables.upsert_table(spark, path, rows.withColumn("Etat", F.lit("Clos")), schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES)
    assert plans[0].count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plans[0]
    assert f"SelectedBucketsCount: {buckets} out of {buckets}" in plans[0]
    assert tables.read_path(spark, path).filter("Etat = 'Clos'").count() == rows.count()
