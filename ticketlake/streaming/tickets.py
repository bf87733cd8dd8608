"""Ticket streams: ingest, near-real-time upsert, live counts, SLA alerts and breaches.

Two columns say when: an event's own time, and its arrival, stamped when it was landed. Arrivals ascend
from file to file (but for a stated disorder), event times need not. Whether a row is late is decided by
its own two times, so the answer does not depend on how files fall into batches, and what a watermark
would drop unseen is routed to a table of late rows instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ticketlake.functions.times import elapsed_seconds
from ticketlake.operators.latest import latest_per_key
from ticketlake.operators.upsert import Key, key_pairs, reduce_updates
from ticketlake.sources import tables
from ticketlake.sources.readers import stream_tickets


#: Days of windows that a stored table of counts keeps in one partition.
WINDOW_PERIOD_DAYS = 7
#: Micro-batches wait for their merge until they have this share of the table's bytes.
LAG = 1.0
#: Groups of tickets that share a timer; a task holds one group at a time.
GROUPS = 4096
#: The column that tells waiting batches apart, later ones having greater numbers.
BATCH = "stream_batch"


def ingest_stream(
    spark: SparkSession, src: str, schema: T.StructType, dst: str, checkpoint: str,
    max_files: int | None = None,
) -> DataStreamWriter:
    """Append arriving ticket events to a bronze folder, once each, partitioned by arrival date."""
    stream = stream_tickets(spark, src, schema, max_files=max_files)
    return (
        stream.withColumn("_load_date", F.current_date())
        .writeStream.format("parquet").outputMode("append")
        .option("path", dst).option("checkpointLocation", checkpoint)
        .partitionBy("_load_date")
    )


def _merged(
    stream: DataFrame, path: str, checkpoint: str, merge: Callable[[DataFrame], None], lag: float
) -> DataStreamWriter:
    """A writer whose micro-batches wait beside the checkpoint and are merged into a table several at a time.

    A merge rewrites what it touches, which may be the whole table, so a merge of every batch would cost
    batches times table. Waiting batches are merged once they have `lag` times the table's bytes, hence
    each row is rewritten a few times, and by `run_available` at the end of a run; 0 merges every batch.
    A batch that is delivered again takes its own place, and a lost run leaves its batches to the next.
    """
    spark, waiting = stream.sparkSession, f"{checkpoint.rstrip('/')}/waiting"
    schema = T.StructType([*stream.schema.fields, T.StructField(BATCH, T.LongType())])

    def merge_waiting() -> None:
        if tables.stored_bytes(spark, waiting):
            merge(spark.read.schema(schema).parquet(waiting))
            tables.remove(spark, waiting)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{waiting}/{BATCH}={batch_id}")
        if tables.stored_bytes(spark, waiting) >= lag * tables.stored_bytes(spark, path):
            merge_waiting()

    writer = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    writer.merge_waiting = merge_waiting
    return writer


def upsert_stream(
    stream: DataFrame, path: str, keys: Sequence[Key], checkpoint: str, *, latest_by: Sequence[str],
    update_cols=None, insert_cols=None, lag: float = LAG,
) -> DataStreamWriter:
    """Merge a stream into a stored table, which trails it by what waits (see `_merged`).

    Waiting batches are reduced to the latest row per key, of equally late ones that of the later batch,
    and an older row never replaces a newer one, so a batch that is delivered again after a failure
    changes nothing.
    """
    def merge(rows: DataFrame) -> None:
        latest = reduce_updates(rows, [s for _, s in key_pairs(keys)], [*latest_by, BATCH]).drop(BATCH)
        tables.upsert_table(
            rows.sparkSession, path, latest, keys, update_cols, insert_cols, latest_by=latest_by, keep_newer=True,
            reduced=True)

    return _merged(stream, path, checkpoint, merge, lag)


def live_counts(
    stream: DataFrame, path: str, ts: str, width: str, by: Sequence[str], checkpoint: str, lag: float = LAG
) -> DataStreamWriter:
    """Keep a stored table of rows per tumbling window and group, however late rows come.

    The counts live in state, one for each window and group as in the table. Each micro-batch gives the
    whole counts of the windows that it changed and no others, and the latest of the waiting ones are
    merged (see `_merged`). So open windows show, a batch that is delivered again changes nothing, and the
    result does not depend on how files fall into batches. `window_counts` is the form whose state forgets
    old windows.
    """
    apply = _merge_counts(path, by)

    def merge(rows: DataFrame) -> None:
        apply(latest_per_key(rows, ["window_start", "window_end", *by], [BATCH]).drop(BATCH), 0)

    return _merged(_counted(stream, ts, width, by), path, checkpoint, merge, lag).outputMode("update")


def _counted(stream: DataFrame, ts: str, width: str, by: Sequence[str]) -> DataFrame:
    return stream.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n")


def _merge_counts(path: str, by: Sequence[str]):
    keys = ["window_start", "window_end", *by]

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables.ensure_table(spark, path, batch.schema, tables.Layout(["window_start"], 1, "window_start", WINDOW_PERIOD_DAYS))
        tables.upsert_table(spark, path, batch, keys, reduced=True)

    return merge


def sla_alerts(
    stream: DataFrame, path: str, limits: DataFrame, checkpoint: str, buckets: int = 4, lag: float = LAG
) -> DataStreamWriter:
    """Keep a stored table of alerts: one row per ticket whose age exceeds the limit of its priority.

    `limits` is a static `(priority, hours)` table. A ticket keeps its earliest breach, in whatever
    order its updates arrive, and never alerts again; the table trails the stream by what waits (see
    `_merged`). The age is that of an update; `sla_breaches` also finds tickets that nobody updates.
    """
    age = elapsed_seconds(F.col("Ouvert"), F.col("Mis_a_jour"))
    earliest = [-F.unix_micros(F.col("Mis_a_jour").cast("timestamp"))]
    late = stream.join(limits, F.col("Priorite") == F.col("priority"), "inner").filter(age > F.col("hours") * 3600)
    alerts = late.select("Numero", "Priorite", "hours", "Ouvert", "Mis_a_jour", age.alias("age_seconds"))

    def merge(rows: DataFrame) -> None:
        spark = rows.sparkSession
        tables.ensure_table(spark, path, alerts.schema, tables.Layout(["Numero"], buckets, "Ouvert"))
        first = reduce_updates(rows, ["Numero"], [*earliest, BATCH]).drop(BATCH)
        tables.upsert_table(spark, path, first, ["Numero"], latest_by=earliest, keep_newer=True, reduced=True)

    return _merged(alerts, path, checkpoint, merge, lag)


def once(stream: DataFrame, keys: Sequence[str], arrival: str, horizon: str) -> DataFrame:
    """Each event once, though its source delivers it again within `horizon` of its first arrival.

    `keys` tell events apart (an event's number, or all its columns). What is remembered are the keys of
    the last `horizon` by arrival, so the state does not grow with the stream. A row without an arrival
    passes: it cannot be placed, and a merge takes it twice without harm.
    """
    placed = stream.filter(F.col(arrival).isNotNull()).withWatermark(arrival, horizon)
    return placed.dropDuplicatesWithinWatermark(list(keys))


def split_late(stream: DataFrame, ts: str, arrival: str, delay: str) -> tuple[DataFrame, DataFrame]:
    """Rows that arrived within `delay` of their event time, and all others.

    The others are older, lie after their own arrival, or lack one of the two times.
    """
    age = F.col(arrival) - F.col(ts)
    timely = F.coalesce((age >= F.expr("INTERVAL 0 SECOND")) & (age <= F.expr(f"INTERVAL {delay}")), F.lit(False))
    return stream.filter(timely), stream.filter(~timely)


def window_counts(
    stream: DataFrame, path: str, late_path: str, ts: str, arrival: str, width: str, by: Sequence[str],
    delay: str, checkpoint: str, disorder: str = "0 seconds",
) -> list[DataStreamWriter]:
    """Rows per tumbling window and group, kept in state, and a table of the rows that came too late.

    Two writers, for one run each. A window is counted while it can still change: its state is dropped
    once the watermark, `delay` and the arrivals' `disorder` behind the latest event, has passed it, and
    a timely row is never behind that. A batch writes the windows that it changed, with their whole
    counts, so a batch that is delivered again changes nothing. Late rows are appended as they are.
    """
    timely, late = split_late(stream, ts, arrival, delay)
    marked = timely.withWatermark(ts, f"{_seconds(stream.sparkSession, delay, disorder)} seconds")
    counts = _counted(marked, ts, width, by).writeStream.outputMode("update").foreachBatch(_merge_counts(path, by))
    return [
        counts.option("checkpointLocation", f"{checkpoint}/counts"),
        late.writeStream.format("parquet").outputMode("append").option("path", late_path)
        .option("checkpointLocation", f"{checkpoint}/late"),
    ]


def _seconds(spark: SparkSession, *intervals: str) -> int:
    """Seconds of intervals of days, hours and smaller units together."""
    whole = " + ".join(f"INTERVAL {i}" for i in intervals)
    return int(spark.sql(f"SELECT CAST({whole} AS INTERVAL SECOND)").first()[0].total_seconds())


def breach_timer():
    """The keyed state behind `sla_breaches`: the latest states of a group of tickets, and a timer at their first limit.

    Tickets are kept by groups, because a call of Python, a frame and a message to the store for each
    single ticket would cost milliseconds. The class is made here, so that it travels to the workers by
    value and they need no copy of this library.
    """
    from pyspark.sql.streaming import StatefulProcessor

    class BreachTimer(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getListState(
                "waiting", "number string, priority string, hours int, opened bigint, deadline bigint, at bigint, closed boolean")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            waiting, overdue = {state[0]: state for state in self.waiting.get()}, {}
            before = self.first(waiting)
            arrived = pd.concat(list(rows)).sort_values(["at", "closed"])
            columns = ["Numero", "priority", "hours", "opened", "deadline", "at", "closed"]
            for event in zip(*[arrived[c].tolist() for c in columns]):
                number, deadline, at, closed = event[0], event[4], event[5], event[6]
                known = waiting.get(number)
                if known is None and at > deadline:
                    if not closed:
                        overdue.setdefault(number, event)  # heard of first after its limit
                elif known is None or known[5] <= at <= known[4]:
                    waiting[number] = event
            self.keep(waiting)
            now = self.first(waiting)
            if now != before:
                if before is not None:
                    self.handle.deleteTimer(before + 1)
                if now is not None:
                    self.handle.registerTimer(now + 1)
            yield from self.breaches([event for number, event in overdue.items() if number not in waiting])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            watermark = timerValues.getCurrentWatermarkInMs()
            states = list(self.waiting.get())
            waiting = {state[0]: state for state in states if state[4] >= watermark}
            self.keep(waiting)
            if waiting:
                self.handle.registerTimer(self.first(waiting) + 1)
            yield from self.breaches([state for state in states if state[4] < watermark and not state[6]])

        @staticmethod
        def first(waiting):
            return min((state[4] for state in waiting.values()), default=None)

        def keep(self, waiting) -> None:
            if waiting:
                self.waiting.put(list(waiting.values()))
            else:
                self.waiting.clear()

        @staticmethod
        def breaches(found):
            import pandas as pd

            if found:
                yield pd.DataFrame([state[:5] for state in found], columns=["Numero", "priority", "hours", "opened", "deadline"])

        def close(self) -> None:
            pass

    return BreachTimer()


def sla_breaches(
    stream: DataFrame, limits: DataFrame, closed: Sequence[str], delay: str = "1 hour", groups: int = GROUPS
) -> DataFrame:
    """Tickets that were open at their limit, also if nobody has touched them since they were opened.

    `limits` is a static `(priority, hours)` table. A ticket's latest state waits with a timer at its
    opening plus the limit of its priority; once the watermark, `delay` behind the latest change of any
    ticket, is past that moment, an open ticket is a breach and its state goes. A close up to the limit
    cancels it, a reopening brings it back, and states may arrive in any order within `delay`. A ticket
    first heard of after its limit is a breach at once, if it is open. Later events of a ticket may say
    so again, so a sink keeps one alert of each (`breach_alerts`). Rows without a number, one of the
    times or a limit take no part. Tickets are dealt over `groups` by a hash of their number.
    """
    moment = F.unix_millis("Ouvert")
    events = (
        stream.filter("Numero IS NOT NULL AND Ouvert IS NOT NULL AND Mis_a_jour IS NOT NULL")
        .withWatermark("Mis_a_jour", delay)
        .join(limits.filter("hours IS NOT NULL"), F.col("Priorite") == F.col("priority"))
        .select(
            "Numero", "Mis_a_jour", "priority", F.col("hours").cast("int").alias("hours"), moment.alias("opened"),
            (moment + F.col("hours").cast("long") * 3_600_000).alias("deadline"), F.unix_millis("Mis_a_jour").alias("at"),
            F.coalesce(F.col("Etat").isin(*closed), F.lit(False)).alias("closed"),
            F.pmod(F.xxhash64("Numero"), F.lit(groups)).alias("ticket_group"))
    )
    found = events.groupBy("ticket_group").transformWithStateInPandas(
        breach_timer(), "Numero string, priority string, hours int, opened bigint, deadline bigint", "Append", "EventTime")
    return found.select(
        "Numero", F.col("priority").alias("Priorite"), "hours", F.timestamp_millis("opened").alias("Ouvert"),
        F.timestamp_millis("deadline").alias("breached_at"))


def breach_alerts(
    stream: DataFrame, path: str, limits: DataFrame, closed: Sequence[str], delay: str, checkpoint: str,
    buckets: int = 4,
) -> DataStreamWriter:
    """Keep a stored table of `sla_breaches`: one row for each ticket, the first breach heard of."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables.ensure_table(spark, path, batch.schema, tables.Layout(["Numero"], buckets, "Ouvert"))
        tables.upsert_table(spark, path, batch, ["Numero"], [])

    return (
        sla_breaches(stream, limits, closed, delay).writeStream.outputMode("append").foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
    )


def run_available(writer: DataStreamWriter) -> None:
    """Process what has arrived so far and merge what waits, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()
    merge_waiting = getattr(writer, "merge_waiting", None)
    if merge_waiting is not None:
        merge_waiting()
