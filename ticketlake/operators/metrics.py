"""Gold metrics over the facts.

Every metric groups the fact by surrogate key first and looks labels up afterwards, so only the
small grouped result meets the dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.functions.times import at_time, elapsed_seconds, mean_hours
from ticketlake.operators.keys import global_row_number
from ticketlake.session import scratch_path

Dims = Mapping[str, DataFrame]


def _label(grouped: DataFrame, dim: DataFrame, id_col: str, *labels: str) -> DataFrame:
    """Attach dimension labels to a grouped result; a NULL key keeps NULL labels."""
    names = dim.select(F.col(id_col).alias("__id"), *labels)
    return grouped.join(names, F.col(id_col) == F.col("__id"), "left").drop("__id", id_col)


def resolution_seconds() -> Column:
    """Seconds from opening to last update of an incident."""
    return elapsed_seconds(F.col("Ouvert"), F.col("Mis_a_jour"))


def _in_states(fact: DataFrame, dims: Dims, states: Sequence[str]) -> DataFrame:
    """Tickets whose current state is one of `states`."""
    wanted = dims["etat"].filter(F.col("Etat").isin(list(states))).select("ID_Etat")
    return fact.join(wanted, "ID_Etat", "left_semi")


def kpi_state_counts(fact: DataFrame, dims: Dims) -> DataFrame:
    """Tickets per state, with the overall total beside each."""
    counts = fact.groupBy("ID_Etat").agg(F.count("*").alias("tickets"))
    total = F.sum("tickets").over(Window.partitionBy())  # over one row per state
    return _label(counts, dims["etat"], "ID_Etat", "Etat").select(
        "Etat", "tickets", total.alias("total_tickets")
    )


def kpi_escalation(
    fact: DataFrame, dims: Dims, escalated: str = "Exploitation", treated: str = "Supervision"
) -> DataFrame:
    """Escalated and treated tickets by type of the current group, and the escalated share."""
    counts = fact.groupBy("ID_Groupe_affectation").agg(F.count("*").alias("n"))
    typed = _label(counts, dims["groupe"], "ID_Groupe_affectation", "Type_Groupe")

    def of_type(label: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("Type_Groupe") == label, F.col("n"))), F.lit(0))

    return typed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tickets"),
        of_type(escalated).alias("escalated"),
        of_type(treated).alias("treated"),
    ).withColumn("escalation_rate", F.round(F.try_divide("escalated", "tickets"), 4))


def kpi_mttr(fact: DataFrame, dims: Dims, closed: Sequence[str]) -> DataFrame:
    """Mean time to resolve in hours over closed tickets."""
    return _in_states(fact, dims, closed).agg(
        F.count("*").alias("closed_tickets"), mean_hours(resolution_seconds()).alias("mttr_hours")
    )


def kpi_mttr_month(fact: DataFrame, dims: Dims, closed: Sequence[str], seconds: Column | None = None) -> DataFrame:
    """Mean time to resolve by opening year and month; `seconds` is another measure of it than real time."""
    seconds = resolution_seconds() if seconds is None else seconds
    return (
        _in_states(fact, dims, closed)
        .groupBy(F.year("Ouvert").alias("annee"), F.month("Ouvert").alias("mois"))
        .agg(F.count("*").alias("closed_tickets"), mean_hours(seconds).alias("mttr_hours"))
    )


def kpi_priority(fact: DataFrame, dims: Dims) -> DataFrame:
    """Tickets per priority."""
    counts = fact.groupBy("ID_Priorite").agg(F.count("*").alias("tickets"))
    return _label(counts, dims["priorite"], "ID_Priorite", "Priorite")


def kpi_team_load(fact: DataFrame, dims: Dims, open_states: Sequence[str]) -> DataFrame:
    """Tickets and open tickets per assignment group."""
    counts = fact.groupBy("ID_Groupe_affectation", "ID_Etat").agg(F.count("*").alias("n"))
    stated = _label(counts, dims["etat"], "ID_Etat", "Etat")
    is_open = F.col("Etat").isin(list(open_states))
    load = stated.groupBy("ID_Groupe_affectation").agg(
        F.sum("n").alias("tickets"),
        F.coalesce(F.sum(F.when(is_open, F.col("n"))), F.lit(0)).alias("open_tickets"),
    )
    return _label(load, dims["groupe"], "ID_Groupe_affectation", "Groupe_affectation")


def kpi_assignee_load(fact: DataFrame, bridge: DataFrame) -> DataFrame:
    """Tickets per assignee through the ticket-assignee bridge, whose rows are distinct.

    Tickets without an assignee count under a NULL name.
    """
    return (
        fact.select("Numero").join(bridge, "Numero", "left")
        .groupBy("Affecte").agg(F.count("*").alias("tickets"))
    )


def kpi_trend(
    fact: DataFrame, dims: Dims, closed: Sequence[str], open_states: Sequence[str]
) -> DataFrame:
    """Per month: tickets opened in it, tickets closed in it, and those opened in it still in progress.

    A closed ticket was closed when it was last updated. The fact is read once: each ticket counts in
    its opening month and in that of its last update, by state, before the labels are looked up.
    """
    def month(moment: str) -> Column:
        return F.trunc(F.col(moment).cast("date"), "month")

    moments = F.array(
        F.struct(month("Ouvert").alias("month"), F.lit(True).alias("opening")),
        F.struct(month("Mis_a_jour").alias("month"), F.lit(False).alias("opening")))
    counts = (
        fact.select("ID_Etat", F.inline(moments))
        .groupBy("month", "opening", "ID_Etat").agg(F.count("*").alias("n"))
    )
    stated = _label(counts, dims["etat"], "ID_Etat", "Etat")

    def of(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    is_closed, is_open = (F.coalesce(F.col("Etat").isin(list(s)), F.lit(False)) for s in (closed, open_states))
    # a month in which tickets that are still open were updated is no month of its own
    return stated.filter(F.col("opening") | is_closed).groupBy("month").agg(
        of(F.col("opening")).alias("opened"), of(~F.col("opening")).alias("closed"),
        of(F.col("opening") & is_open).alias("in_progress"))


def _both(deployments: DataFrame, requests: DataFrame) -> DataFrame:
    """Both facts with one opening date and one duration in seconds."""
    return deployments.select(
        "ID_Type", F.col("Ouvert").alias("opened"), deployment_seconds().alias("seconds")
    ).unionByName(
        requests.select("ID_Type", F.col("Cree").alias("opened"), F.col("Task_Duration").alias("seconds"))
    )


def deployment_seconds() -> Column:
    """Seconds from opening to last update of a deployment; NULL without two well-formed times."""
    return elapsed_seconds(
        at_time(F.col("Ouvert"), F.col("Ovrt_h")), at_time(F.col("Mis_a_jour"), F.col("Mis_h"))
    )


def kpi_type_totals(deployments: DataFrame, requests: DataFrame, dims: Dims) -> DataFrame:
    """Tickets per type over both facts, with the overall total beside each."""
    both = deployments.select("ID_Type").unionByName(requests.select("ID_Type"))
    counts = both.groupBy("ID_Type").agg(F.count("*").alias("tickets"))
    total = F.sum("tickets").over(Window.partitionBy())  # over one row per type
    return _label(counts, dims["type"], "ID_Type", "Type").select(
        "Type", "tickets", total.alias("total_tickets")
    )


def kpi_duration_type(deployments: DataFrame, requests: DataFrame, dims: Dims) -> DataFrame:
    """Mean duration in hours per type."""
    means = _both(deployments, requests).groupBy("ID_Type").agg(
        F.count("seconds").alias("measured"), mean_hours(F.col("seconds")).alias("mean_hours")
    )
    return _label(means, dims["type"], "ID_Type", "Type")


def kpi_type_trend(deployments: DataFrame, requests: DataFrame, dims: Dims) -> DataFrame:
    """Tickets per opening month and type."""
    counts = (
        _both(deployments, requests)
        .groupBy(F.trunc("opened", "month").alias("month"), "ID_Type")
        .agg(F.count("*").alias("tickets"))
    )
    return _label(counts, dims["type"], "ID_Type", "Type")


def kpi_band_load(*parts: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """Tickets per collaborator and time band over several facts, each with its two dimensions."""
    def one(fact: DataFrame, collaborators: DataFrame, bands: DataFrame) -> DataFrame:
        counts = fact.groupBy("ID_Collaborateur", "ID_Plage_Horaires").agg(F.count("*").alias("tickets"))
        named = _label(counts, collaborators, "ID_Collaborateur", "Collaborateur")
        return _label(named, bands, "ID_Plage_Horaires", "Plages_horaires")

    both = reduce(DataFrame.unionByName, [one(*part) for part in parts])
    return both.groupBy("Collaborateur", "Plages_horaires").agg(F.sum("tickets").alias("tickets"))


def kpi_band_share(fact: DataFrame, bands: DataFrame) -> DataFrame:
    """Tickets per time band and its share of all tickets."""
    counts = fact.groupBy("ID_Plage_Horaires").agg(F.count("*").alias("tickets"))
    total = F.sum("tickets").over(Window.partitionBy())  # over one row per band
    return _label(counts, bands, "ID_Plage_Horaires", "Plages_horaires").withColumn(
        "share", F.round(F.col("tickets") / total, 4)
    )


def kpi_collab_rank(*parts: tuple[DataFrame, DataFrame, Column]) -> DataFrame:
    """Collaborators by ticket count (most first), then mean duration (shortest first), then name.

    Each part is a fact, its collaborators and its duration in seconds. Names are unique, so the rank
    is a row number and needs no one-task sort either. The numbering uses its rows three times, so the
    loads, one row a collaborator, are written to the shared scratch folder first.
    """
    def one(fact: DataFrame, collaborators: DataFrame, seconds: Column) -> DataFrame:
        load = fact.groupBy("ID_Collaborateur").agg(
            F.count("*").alias("tickets"), F.sum(seconds).alias("seconds"), F.count(seconds).alias("measured"))
        return _label(load, collaborators, "ID_Collaborateur", "Collaborateur")

    named = reduce(DataFrame.unionByName, [one(*part) for part in parts]).groupBy("Collaborateur").agg(
        F.sum("tickets").alias("tickets"),
        F.round(F.try_divide(F.sum("seconds"), F.sum("measured")) / 3600, 2).alias("mean_hours"))
    path = scratch_path(named.sparkSession, "loads")
    named.write.parquet(path)
    stored = named.sparkSession.read.schema(named.schema).parquet(path)
    order = F.struct(-F.col("tickets"), F.col("mean_hours"), F.col("Collaborateur"))
    return global_row_number(stored, order, name="rank")


def kpi_sla(
    fact: DataFrame, dims: Dims, limits: DataFrame, closed: Sequence[str], seconds: Column | None = None
) -> DataFrame:
    """Share of closed tickets resolved within the limit of their priority.

    `limits` is `(priority, hours)`; it is resolved to keys before it meets the fact. A priority
    without a limit, and tickets without a priority, have a row of their own without a share. `seconds`
    is another measure of the time to resolve than real time.
    """
    seconds = resolution_seconds() if seconds is None else seconds
    allowed = dims["priorite"].join(limits, F.col("Priorite") == F.col("priority"), "left").select(
        "ID_Priorite", F.col("Priorite").alias("label"), (F.col("hours") * 3600).alias("limit_s")
    )
    timed = _in_states(fact, dims, closed).join(allowed, "ID_Priorite", "left")
    return (
        timed.groupBy(F.col("label").alias("priority"))
        .agg(
            F.count("*").alias("closed_tickets"),
            F.count_if(seconds <= F.col("limit_s")).alias("within_limit"),
            F.count("limit_s").alias("limited"),
        )
        .withColumn("compliance", F.round(F.try_divide("within_limit", "limited"), 4)).drop("limited")
    )


def kpi_long_running(fact: DataFrame, k: int = 20, seconds: Column | None = None) -> DataFrame:
    """The `k` tickets with the longest time between opening and last update, or by other `seconds`."""
    seconds = resolution_seconds() if seconds is None else seconds
    return (
        fact.select("Numero", "Ouvert", "Mis_a_jour", seconds.alias("seconds"))
        .orderBy(F.col("seconds").desc_nulls_last(), "Numero")
        .limit(k)
    )
