"""The streaming operators as queries: files arrive, the stream drains them, the result is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.plans import fixtures as fx
from ticketlake.plans.queries import query, upsert_sql, without_zone
from ticketlake import schemas
from ticketlake.session import ROCKSDB_STATE, scratch_path, settings, shuffle_partitions, table_buckets
from ticketlake.sources import readers, tables
from ticketlake.streaming import tickets

#: Micro-batches that one arrival is read in.
BATCHES = 4
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def zoned(df: DataFrame) -> DataFrame:
    """Wall-clock timestamps as session-zone timestamps, which watermarks need."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain})


def arriving(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write rows as newly arrived files in no order; returns them in their arrival schema.

    As many files as the session has shuffle partitions, unless a test asks for fewer.
    """
    rows = zoned(df)
    files = files or shuffle_partitions(df.sparkSession)
    rows.repartition(files).write.mode("append").parquet(path)
    return rows


def files_a_batch(spark: SparkSession) -> int:
    """The rate limit that reads an arrival in `BATCHES` micro-batches, however many files it has."""
    return -(-shuffle_partitions(spark) // BATCHES)


def drained(stream: DataFrame, columns: list[str]) -> DataFrame:
    """Run an append-mode stream over what is there and read the sink."""
    spark = stream.sparkSession
    sink = scratch_path(spark, "sink")
    writer = stream.writeStream.format("parquet").option("path", sink).option(
        "checkpointLocation", scratch_path(spark, "ckpt"))
    tickets.run_available(writer)
    return without_zone(spark.read.schema(stream.schema).parquet(sink)).select(*columns)


@query("stream_tickets", "SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_tickets(spark, sf):
    src = scratch_path(spark, "arrivals")
    rows = arriving(fx.table(spark, sf, "events").select(*EVENT_COLUMNS), src)
    stream = readers.stream_tickets(spark, src, rows.schema, max_files=files_a_batch(spark))
    return drained(stream, EVENT_COLUMNS).groupBy("event_type").agg(F.count("*").alias("n"))


@query("stream_ingest", f"SELECT {', '.join(EVENT_COLUMNS)} FROM events")
def stream_ingest(spark, sf):
    """Two arrivals, each drained by its own run of the same stream."""
    src, dst, ckpt = (scratch_path(spark, p) for p in ("arrivals", "bronze", "ckpt"))
    events = fx.table(spark, sf, "events").select(*EVENT_COLUMNS)
    for half in (events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")):
        rows = arriving(half, src)
        tickets.run_available(tickets.ingest_stream(spark, src, rows.schema, dst, ckpt, max_files=files_a_batch(spark)))
    return without_zone(spark.read.schema(rows.schema).parquet(dst)).select(*EVENT_COLUMNS)


@query("stream_upsert", upsert_sql(
    "v_load1", "v_load2", ["Numero"], schemas.INCIDENTS_CSV.names, schemas.INCIDENTS_CSV.names, ["Mis_a_jour"]))
def stream_upsert(spark, sf):
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "silver", "ckpt"))
    tables.ensure_table(spark, path, schemas.INCIDENTS_SILVER, tables.Layout(["Numero"], table_buckets(spark)))
    for load in fx.incident_loads(spark, sf):
        arriving(load, src)
        stream = readers.stream_tickets(spark, src, schemas.INCIDENTS_SILVER, max_files=files_a_batch(spark))
        tickets.run_available(
            tickets.upsert_stream(stream, path, ["Numero"], ckpt, latest_by=["Mis_a_jour"]))
    return without_zone(tables.read_path(spark, path))


@query("stream_live_counts", """
    SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start,
           date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
    FROM events GROUP BY ALL""")
def stream_live_counts(spark, sf):
    """All events, over several micro-batches of unordered files; open windows are included."""
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "counts", "ckpt"))
    rows = arriving(fx.table(spark, sf, "events").select(*EVENT_COLUMNS), src)
    stream = readers.stream_tickets(spark, src, rows.schema, max_files=files_a_batch(spark))
    tickets.run_available(tickets.live_counts(stream, path, "ts", "1 hour", ["event_type"], ckpt))
    return without_zone(tables.read_path(spark, path))


@query("stream_sla_alerts", """
    SELECT Numero, Priorite, hours, Ouvert, Mis_a_jour, date_sub('second', Ouvert, Mis_a_jour) AS age_seconds
    FROM (SELECT * FROM v_load1 UNION ALL SELECT * FROM v_load2)
    JOIN v_sla ON Priorite = priority WHERE date_sub('second', Ouvert, Mis_a_jour) > hours * 3600
    QUALIFY row_number() OVER (PARTITION BY Numero ORDER BY Mis_a_jour) = 1""")
def stream_sla_alerts(spark, sf):
    """Tickets that are delivered several times raise one alert, that of their earliest breach."""
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "alerts", "ckpt"))
    first, second = fx.incident_loads(spark, sf)
    arriving(first.unionByName(second), src)
    stream = readers.stream_tickets(spark, src, schemas.INCIDENTS_SILVER, max_files=files_a_batch(spark))
    tickets.run_available(tickets.sla_alerts(stream, path, fx.sla_limits(spark), ckpt, table_buckets(spark)))
    return without_zone(tables.read_path(spark, path))


_ARRIVED = "ts + to_hours((event_id % 80)::INTEGER)"
_TIMELY = "event_id % 80 <= 48"


def _stamped(spark, sf) -> DataFrame:
    """Events with the moment they arrived, up to 79 hours after they happened."""
    late = F.timestamp_add("HOUR", (F.col("event_id") % 80).cast("int"), F.col("ts"))
    return fx.table(spark, sf, "events").select("event_id", "ts", "event_type", late.alias("arrived"))


def _run_window_counts(spark, sf) -> tuple[str, str, DataFrame]:
    """Two arrivals, in order; windows count what came within two days, the rest is kept as late."""
    src, path, late, ckpt = (scratch_path(spark, p) for p in ("arrivals", "counts", "late", "ckpt"))
    with settings(spark, ROCKSDB_STATE):
        for part in in_order_of_time(_stamped(spark, sf), "arrived", 2):
            rows = arriving(part, src)
            stream = readers.stream_tickets(spark, src, rows.schema)
            for writer in tickets.window_counts(stream, path, late, "ts", "arrived", "1 day", ["event_type"], "48 hours", ckpt):
                tickets.run_available(writer)
    return path, late, rows


@query("stream_window_counts", f"""
    SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
           event_type, count(*) AS n FROM events WHERE {_TIMELY} GROUP BY ALL""")
def stream_window_counts(spark, sf):
    return without_zone(tables.read_path(spark, _run_window_counts(spark, sf)[0]))


@query("stream_late_rows", f"SELECT event_id, ts, event_type, {_ARRIVED} AS arrived FROM events WHERE NOT {_TIMELY}")
def stream_late_rows(spark, sf):
    _, late, rows = _run_window_counts(spark, sf)
    return without_zone(spark.read.schema(rows.schema).parquet(late)).select("event_id", "ts", "event_type", "arrived")


@query("stream_upsert_once", f"""
    SELECT *, 1 AS merges FROM ({upsert_sql('v_load1', 'v_load2', ['Numero'], schemas.INCIDENTS_CSV.names, schemas.INCIDENTS_CSV.names, ['Mis_a_jour'])})
    WHERE Numero NOT IN (SELECT Numero FROM v_load1 INTERSECT SELECT Numero FROM v_load2)
    UNION ALL SELECT *, 2 FROM ({upsert_sql('v_load1', 'v_load2', ['Numero'], schemas.INCIDENTS_CSV.names, schemas.INCIDENTS_CSV.names, ['Mis_a_jour'])})
    WHERE Numero IN (SELECT Numero FROM v_load1 INTERSECT SELECT Numero FROM v_load2)""")
def stream_upsert_once(spark, sf):
    """Each extract is delivered twice, by two runs; every ticket is merged once for each extract it is in."""
    src, path, seen, ckpt = (scratch_path(spark, p) for p in ("arrivals", "silver", "merges", "ckpt"))
    schema = schemas.schema(*[(f.name, f.dataType) for f in schemas.INCIDENTS_SILVER], ("arrived", schemas.TS))
    tables.ensure_table(spark, path, schemas.INCIDENTS_SILVER, tables.Layout(["Numero"], table_buckets(spark)))

    def merge(batch: DataFrame, batch_id: int) -> None:
        with tables.staged(batch) as rows:
            if rows.isEmpty():  # all of it was redelivered
                return
            rows.select("Numero").distinct().write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
            tables.upsert_table(rows.sparkSession, path, rows, ["Numero"], latest_by=["Mis_a_jour"], keep_newer=True)

    with settings(spark, ROCKSDB_STATE):
        for day, load in enumerate(fx.incident_loads(spark, sf), 1):
            stamped = load.withColumn("arrived", F.lit(f"2024-02-{day:02d} 06:00:00").cast("timestamp"))
            for _ in range(2):
                arriving(stamped.select(*schema.names), src)
                stream = tickets.once(readers.stream_tickets(spark, src, schema), schema.names, "arrived", "12 hours")
                tickets.run_available(stream.writeStream.foreachBatch(merge).option("checkpointLocation", ckpt))
    merges = spark.read.schema("Numero string").parquet(seen).groupBy("Numero").agg(F.count("*").cast("int").alias("merges"))
    return without_zone(tables.read_path(spark, path)).join(merges, "Numero")


def in_order_of_time(df: DataFrame, at: str, slices: int) -> list[DataFrame]:
    """The rows in consecutive, equally long slices of time."""
    first, last = df.agg(F.min(at), F.max(at)).first()
    step = (last - first) / slices
    cuts = [first + step * i for i in range(1, slices)]
    lows, highs = [None, *cuts], [*cuts, None]
    return [
        df.filter((F.lit(True) if low is None else F.col(at) >= low) & (F.lit(True) if high is None else F.col(at) < high))
        for low, high in zip(lows, highs)
    ]


BREACH_DELAY = 2  # days
_BREACH_EVENTS = """(SELECT Numero, Priorite, Ouvert, Ouvert AS moment, 'En cours' AS Etat FROM v_incidents
    UNION ALL SELECT Numero, Priorite, Ouvert, Mis_a_jour, Etat FROM v_incidents WHERE Etat IN ('Clos', 'Résolu'))"""


@query("stream_sla_breach_timer", f"""
    SELECT Numero, Priorite, hours, Ouvert, Ouvert + to_hours(hours) AS breached_at
    FROM (SELECT DISTINCT Numero, Priorite, Ouvert FROM {_BREACH_EVENTS}) t JOIN v_sla s ON Priorite = s.priority
    WHERE Ouvert + to_hours(hours) < (SELECT max(moment) - INTERVAL {BREACH_DELAY} DAY FROM {_BREACH_EVENTS})
      AND NOT EXISTS (SELECT 1 FROM {_BREACH_EVENTS} e WHERE e.Numero = t.Numero AND e.Etat IN ('Clos', 'Résolu')
                      AND e.moment <= t.Ouvert + to_hours(s.hours))""")
def stream_sla_breach_timer(spark, sf):
    """Every ticket is heard of when it opens and, if it was closed, when it closes; most are silent between."""
    src, path, ckpt = (scratch_path(spark, p) for p in ("arrivals", "breaches", "ckpt"))
    tickets_ = fx.incidents(spark, sf).select("Numero", "Priorite", "Ouvert", "Mis_a_jour", "Etat")
    opened = tickets_.withColumn("Mis_a_jour", F.col("Ouvert")).withColumn("Etat", F.lit(fx.OPEN_STATES[0]))
    events = opened.unionByName(tickets_.filter(F.col("Etat").isin(*fx.CLOSED_STATES)))
    with settings(spark, ROCKSDB_STATE):
        for part in in_order_of_time(events, "Mis_a_jour", 2):
            rows = arriving(part, src)
            stream = readers.stream_tickets(spark, src, rows.schema)
            tickets.run_available(tickets.breach_alerts(
                stream, path, fx.sla_limits(spark), fx.CLOSED_STATES, f"{BREACH_DELAY} days", ckpt, table_buckets(spark)))
    return without_zone(tables.read_path(spark, path))
