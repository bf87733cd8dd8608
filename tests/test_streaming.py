import pytest
from pyspark.sql import functions as F

from conftest import rows
from ticketlake import schemas
from ticketlake.operators.upsert import upsert
from ticketlake.plans import fixtures as fx
from ticketlake.plans.queries import without_zone
from ticketlake.plans.stream_queries import BATCHES, arriving, files_a_batch, stream_upsert_once, zoned
from ticketlake.session import scratch_path, settings
from ticketlake.sources import readers, tables
from ticketlake.streaming import tickets


def test_upsert_stream_equals_batch_and_skips_a_repeated_batch(spark, sf):
    first, second = fx.incident_loads(spark, sf)
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "silver", "ckpt"))
    tables.ensure_table(spark, path, schemas.INCIDENTS_SILVER, tables.Layout(["Numero"], 2))
    arriving(first, src, files=1)
    arriving(second, src, files=2)
    stream = readers.stream_tickets(spark, src, schemas.INCIDENTS_SILVER, max_files=1)
    writer = tickets.upsert_stream(stream, path, ["Numero"], ckpt, latest_by=["Mis_a_jour"])
    tickets.run_available(writer)
    want = rows(upsert(first, second, ["Numero"], latest_by=["Mis_a_jour"]))
    assert rows(without_zone(tables.read_path(spark, path))) == want

    # the same stream again without its progress: every batch is delivered a second time
    replay = readers.stream_tickets(spark, src, schemas.INCIDENTS_SILVER, max_files=1)
    again = tickets.upsert_stream(replay, path, ["Numero"], scratch_path(spark, "ckpt"), latest_by=["Mis_a_jour"])
    tickets.run_available(again)
    assert rows(without_zone(tables.read_path(spark, path))) == want


def test_an_older_update_never_wins(spark):
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "t", "ckpt"))
    schema = schemas.schema(("k", schemas.S), ("at", schemas.I), ("v", schemas.S))
    tables.ensure_table(spark, path, schema, tables.Layout(["k"]))
    for at, v in [(5, "new"), (3, "late"), (6, "newest")]:
        spark.createDataFrame([("a", at, v)], schema).coalesce(1).write.mode("append").parquet(src)
        stream = readers.stream_tickets(spark, src, schema)
        tickets.run_available(tickets.upsert_stream(stream, path, ["k"], ckpt, latest_by=["at"]))
        assert tables.read_path(spark, path).first()["at"] == max(at, 5)


@pytest.mark.parametrize("max_files", [None, 1])
def test_live_counts_do_not_depend_on_the_batches(spark, sf, max_files):
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "counts", "ckpt"))
    events = zoned(fx.table(spark, sf, "events").select("ts", "event_type"))
    arriving(events, src, files=3)
    stream = readers.stream_tickets(spark, src, events.schema, max_files=max_files)
    tickets.run_available(tickets.live_counts(stream, path, "ts", "1 day", ["event_type"], ckpt))
    batch = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    want = rows(batch.select("w.start", "w.end", "event_type", "n"))
    assert rows(tables.read_path(spark, path)) == want
    # late rows arrive with the next run and are added
    arriving(events.limit(7), src, files=1)
    tickets.run_available(tickets.live_counts(
        readers.stream_tickets(spark, src, events.schema, max_files=max_files), path, "ts", "1 day", ["event_type"], ckpt))
    assert tables.read_path(spark, path).agg(F.sum("n")).first()[0] == events.count() + 7


@pytest.mark.parametrize("max_files", [None, 1])
def test_one_alert_per_ticket_whatever_the_batches(spark, max_files):
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "alerts", "ckpt"))
    limits = spark.createDataFrame([("P1", 1), ("P2", 1000)], "priority string, hours int")
    day = "2025-01-02 "
    data = [
        ("T1", "P1", day + "08:00:00", day + "09:00:00"),  # exactly the limit: no breach
        ("T1", "P1", day + "08:00:00", day + "10:00:00"),
        ("T1", "P1", day + "08:00:00", day + "09:00:01"),  # the earliest breach arrives late
        ("T2", "P2", day + "08:00:00", day + "12:00:00"),  # long limit
        ("T3", "P1", day + "08:00:00", day + "12:00:00"),
        ("T4", None, day + "08:00:00", day + "12:00:00"),
        ("T1", "P1", "2024-01-02 08:00:00", "2024-01-02 08:30:00"),  # far behind, no breach
    ]
    for row in data:
        frame = spark.createDataFrame([row], "Numero string, Priorite string, Ouvert string, Mis_a_jour string")
        frame.select("Numero", "Priorite", F.col("Ouvert").cast("timestamp"), F.col("Mis_a_jour").cast("timestamp")) \
            .coalesce(1).write.mode("append").parquet(src)
    schema = schemas.schema(("Numero", schemas.S), ("Priorite", schemas.S), ("Ouvert", schemas.TS), ("Mis_a_jour", schemas.TS))
    stream = readers.stream_tickets(spark, src, schema, max_files=max_files)
    tickets.run_available(tickets.sla_alerts(stream, path, limits, ckpt))
    assert rows(tables.read_path(spark, path).select("Numero", "age_seconds")) == [("T1", 3601), ("T3", 14400)]


EVENT = schemas.schema(("id", schemas.S), ("ts", schemas.TS), ("arrived", schemas.TS), ("kind", schemas.S))


def deliver(spark, src, *events):
    """One file of events `(id, event hour, arrival hour, kind)` of a day."""
    def at(hour):
        return None if hour is None else f"2025-03-04 {int(hour):02d}:{round(hour % 1 * 60):02d}:00"

    data = [(i, at(ts), at(arrived), kind) for i, ts, arrived, kind in events]
    frame = spark.createDataFrame(data, "id string, ts string, arrived string, kind string")
    frame.select("id", F.col("ts").cast("timestamp"), F.col("arrived").cast("timestamp"), "kind").coalesce(1) \
        .write.mode("append").parquet(src)


@pytest.mark.parametrize("max_files", [None, 1])
def test_windows_count_timely_rows_and_the_late_table_holds_the_others(spark, max_files):
    src, path, late, ckpt = (scratch_path(spark, p) for p in ("arrivals", "counts", "late", "ckpt"))
    files = [
        [("a", 1.0, 1.1, "x"), ("b", 1.5, 1.6, "x"), ("c", 1.2, 1.7, "y")],
        [("d", 5.0, 5.1, "x"), ("e", 1.9, 5.2, "x")],  # e is more than two hours old
        [("f", 3.6, 5.5, None), ("g", 9.0, 5.6, "x"), ("h", None, 5.7, "x"), ("i", 4.0, None, "x")],  # g lies ahead
        [("j", 7.0, 7.1, "y"), ("k", 5.2, 7.15, "x")],  # k is late but timely
    ]
    seen = []
    for file in files:
        deliver(spark, src, *file)
        stream = readers.stream_tickets(spark, src, EVENT, max_files=max_files)
        for writer in tickets.window_counts(stream, path, late, "ts", "arrived", "1 hour", ["kind"], "2 hours", ckpt):
            query = writer.trigger(availableNow=True).start()
            query.awaitTermination()
            seen += [p for p in query.recentProgress]
    found = {(r.window_start.hour, r.kind): r.n for r in tables.read_path(spark, path).collect()}
    assert found == {(1, "x"): 2, (1, "y"): 1, (5, "x"): 2, (3, None): 1, (7, "y"): 1}
    assert {r.id for r in spark.read.schema(EVENT).parquet(late).collect()} == {"e", "g", "h", "i"}
    states = [s for p in seen for s in p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0  # nothing vanishes
    assert states[-1]["numRowsTotal"] <= 3  # closed windows are forgotten


def test_a_batch_writes_only_the_windows_it_changed(spark):
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "counts", "ckpt"))
    schema = schemas.schema(("ts", schemas.TS))
    files = {}
    for moments in (["2025-03-04 01:00:00", "2025-06-05 01:00:00"], ["2025-06-06 01:30:00"]):
        spark.createDataFrame([(m,) for m in moments], "ts string").select(F.col("ts").cast("timestamp")) \
            .coalesce(1).write.mode("append").parquet(src)
        stream = readers.stream_tickets(spark, src, schema)
        tickets.run_available(tickets.live_counts(stream, path, "ts", "1 hour", [], ckpt))
        before, files = files, set(tables.read_path(spark, path).inputFiles())
    assert len(before) == 2 and len(files) == 2 and len(before & files) == 1
    assert tables.read_path(spark, path).agg(F.sum("n"), F.count("*")).first() == (3, 3)


def test_redelivered_events_change_neither_the_table_nor_the_merges(spark):
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "t", "ckpt"))
    tables.ensure_table(spark, path, EVENT, tables.Layout(["id"], 2))
    merged, states = [], []
    for hour in range(6):
        own = [(f"e{hour}_{i}", float(hour), hour + 0.1, "x") for i in range(5)]
        again = [(f"e{hour - 1}_{i}", hour - 1.0, hour - 0.9, "x") for i in range(5)] if hour else []
        deliver(spark, src, *own, *again, *own[:2])
        stream = tickets.once(readers.stream_tickets(spark, src, EVENT), ["id", "ts"], "arrived", "1 hour")

        def merge(batch, batch_id):
            found = batch.collect()  # once: a second run of the batch would count its state twice
            merged.append(len(found))
            tables.upsert_table(spark, path, spark.createDataFrame(found, EVENT), ["id"], latest_by=["ts"], keep_newer=True)

        query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        query.awaitTermination()
        states += [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert [n for n in merged if n] == [5] * 6
    assert tables.read_path(spark, path).count() == 30
    assert max(states) <= 20  # the keys of the horizon, not of the stream


TICKET = schemas.schema(("Numero", schemas.S), ("Priorite", schemas.S), ("Ouvert", schemas.TS), ("Mis_a_jour", schemas.TS), ("Etat", schemas.S))


def test_a_breach_needs_no_update(spark):
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "breaches", "ckpt"))
    limits = spark.createDataFrame([("P1", 2), ("P2", 5)], "priority string, hours int")
    day = "2025-01-02 "
    batches = [
        [("silent", "P1", 8, 8, "open"), ("closed", "P1", 8, 8, "open"), ("reopened", "P1", 8, 8, "open"), (None, "P1", 8, 8, "open"),
         ("raised", "P2", 8, 8, "open"), ("unknown", "P9", 8, 8, "open"), ("swapped", "P1", 8, 9.5, "closed"), ("no state", "P1", 8, 8, None)],
        [("closed", "P1", 8, 10, "closed"), ("reopened", "P1", 8, 9, "closed"), ("reopened", "P1", 8, 9.5, "open"),
         ("raised", "P1", 8, 9, "open"), ("swapped", "P1", 8, 8, "open")],
        [("clock", "P2", 11.5, 11.5, "open")],
        [("closed", "P1", 8, 11.6, "closed"), ("silent", "P1", 8, 11.6, "closed"), ("found late", "P1", 8, 11.6, "open"),
         ("closed late", "P1", 8, 11.7, "closed")],
    ]
    found = []
    for batch in batches:
        data = [(n, p, *(day + f"{int(h):02d}:{round(h % 1 * 60):02d}:00" for h in (o, m)), s) for n, p, o, m, s in batch]
        frame = spark.createDataFrame(data, "Numero string, Priorite string, Ouvert string, Mis_a_jour string, Etat string")
        frame.withColumns({c: F.col(c).cast("timestamp") for c in ("Ouvert", "Mis_a_jour")}).coalesce(1).write.mode("append").parquet(src)
        stream = readers.stream_tickets(spark, src, TICKET)
        tickets.run_available(tickets.breach_alerts(stream, path, limits, ["closed"], "1 hour", ckpt))
        found.append({r.Numero: str(r.breached_at)[11:16] for r in tables.read_path(spark, path).collect()} if tables.table_exists(spark, path) else {})
    overdue = {"silent": "10:00", "reopened": "10:00", "raised": "10:00", "no state": "10:00"}
    assert found == [{}, {}, overdue, {**overdue, "found late": "10:00"}]


@pytest.mark.parametrize("files", [8, 200, 211])
def test_an_arrival_of_any_number_of_files_is_read_in_as_many_batches(spark, files):
    with settings(spark, {"spark.sql.shuffle.partitions": str(files)}):
        assert -(-files // files_a_batch(spark)) == BATCHES


def test_a_merge_takes_several_batches_and_later_ones_win(spark, monkeypatch):
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "t", "ckpt"))
    schema = schemas.schema(("k", schemas.I), ("at", schemas.I), ("v", schemas.I))
    tables.ensure_table(spark, path, schema, tables.Layout(["k"], 2))
    merges, upsert_table = [], tables.upsert_table
    monkeypatch.setattr(tables, "upsert_table", lambda *a, **k: merges.append(1) or upsert_table(*a, **k))
    for v in range(10):  # in order of arrival; one key is always as late as before, one gets older
        data = [(k, 0, v) for k in range(100)] + [(1000, -v, v), (1001 + v, 0, v)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
    stream = readers.stream_tickets(spark, src, schema, max_files=1)
    tickets.run_available(tickets.upsert_stream(stream, path, ["k"], ckpt, latest_by=["at"]))
    found = {r.k: r.v for r in tables.read_path(spark, path).collect()}
    assert found == {**{k: 9 for k in range(100)}, 1000: 0, **{1001 + v: v for v in range(10)}}
    assert 1 <= len(merges) <= 8
    assert not tables.stored_bytes(spark, f"{ckpt}/waiting")


def test_breaches_are_timed_by_groups_of_tickets(spark):
    """The keys of the state, hence the calls of Python, do not grow with the tickets."""
    src, ckpt = scratch_path(spark, "arrivals"), scratch_path(spark, "ckpt")
    limits = spark.createDataFrame([("P1", 2)], "priority string, hours int")
    day = F.lit("2025-01-02 08:00:00").cast("timestamp")
    many = spark.range(500).select(
        F.concat(F.lit("T"), "id").alias("Numero"), F.lit("P1").alias("Priorite"), F.timestamp_add("HOUR", (F.col("id") % 3).cast("int"), day).alias("Ouvert"))
    rows_ = many.withColumn("Mis_a_jour", F.col("Ouvert")).withColumn("Etat", F.lit("open"))
    rows_.coalesce(1).write.mode("append").parquet(src)
    clock = rows_.limit(1).withColumn("Numero", F.lit("clock")).withColumn("Ouvert", F.timestamp_add("MINUTE", F.lit(210), day))
    clock.withColumn("Mis_a_jour", F.col("Ouvert")).coalesce(1).write.mode("append").parquet(src)
    found = []
    stream = tickets.sla_breaches(readers.stream_tickets(spark, src, TICKET, max_files=1), limits, ["closed"], "0 seconds", groups=3)
    query = stream.writeStream.foreachBatch(lambda batch, i: found.extend(batch.collect())).option("checkpointLocation", ckpt) \
        .trigger(availableNow=True).start()
    query.awaitTermination()
    sizes = [s["customMetrics"] for p in query.recentProgress for s in p["stateOperators"]]
    assert {r.Numero for r in found} == {f"T{i}" for i in range(500) if i % 3 < 2} and len(found) == 334
    assert max(s["numRegisteredTimers"] for s in sizes) <= 4  # the groups', not the tickets'


def test_a_redelivered_extract_costs_no_merge(spark, sf, monkeypatch):
    merges, upsert_table = [], tables.upsert_table
    monkeypatch.setattr(tables, "upsert_table", lambda *a, **k: merges.append(1) or upsert_table(*a, **k))
    stream_upsert_once(spark, sf)
    assert len(merges) == 2  # each of two extracts once, though both came twice
