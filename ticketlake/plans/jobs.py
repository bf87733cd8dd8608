"""The batch jobs: bronze extracts to silver tables, silver tables to the gold star schema.

Tables live under one root folder, `<root>/silver/<name>` and `<root>/gold/<name>`. Every job can run
again on the same or a later extract: silver and facts are merged by key, dimension keys never move.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake import schemas
from ticketlake.functions.times import at_time
from ticketlake.operators import clean, dims, facts
from ticketlake.operators.upsert import Key
from ticketlake.plans import star
from ticketlake.sources import tables

# Silver and fact tables: hash buckets per period. Raise the buckets with the size of a table, so that
# one bucket of one period stays within some gigabytes.
BUCKETS, PERIOD_DAYS = 64, 30


def latest_at(date: str, time: str) -> list[Column]:
    """Order of two states of a ticket: by the moment of the change, then by its date.

    Times of day are texts that need not be padded; a malformed one counts as oldest.
    """
    return [at_time(F.col(date), F.col(time)), F.col(date)]


def silver_path(root: str, name: str) -> str:
    return f"{root}/silver/{name}"


def gold_path(root: str, name: str) -> str:
    return f"{root}/gold/{name}"


def silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    return tables.read_path(spark, silver_path(root, name))


def gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    return tables.read_path(spark, gold_path(root, name))


def _merge(
    path: str, schema: T.StructType, updates: DataFrame, keys: Sequence[Key], update_cols,
    latest_by: Sequence[Column | str] = (), layout: tables.Layout = tables.Layout(),
    changes_to: str | None = None,
) -> None:
    spark = updates.sparkSession
    tables.ensure_table(spark, path, schema, layout)
    tables.upsert_table(
        spark, path, updates, keys, update_cols, latest_by=latest_by, keep_newer=bool(latest_by),
        changes_to=changes_to)


# --- silver -------------------------------------------------------------------------------------------
def load_incidents(
    bronze: DataFrame, root: str, buckets: int = BUCKETS, days: int = PERIOD_DAYS, changes_to: str | None = None,
) -> None:
    """Merge an incident extract; several rows of one ticket in it leave the latest.

    `changes_to` names a folder for what the merge changes; `changed_rows` of it is all that the next
    gold load needs.
    """
    _merge(
        silver_path(root, "supervision_silver"), schemas.INCIDENTS_SILVER, bronze,
        schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, ["Mis_a_jour"],
        tables.Layout(["Numero"], buckets, "Ouvert", days), changes_to,
    )


def load_shift(bronze: DataFrame, root: str) -> None:
    """Shift reference table: insert what is new, once; nothing stored is rewritten."""
    _merge(silver_path(root, "Dim_Shift"), schemas.SHIFT_SILVER, bronze, ["Ouvert", "Plage_horaire"], [])


def load_assignees(bronze: DataFrame, root: str, buckets: int = BUCKETS) -> None:
    """Ticket-assignee bridge, insert only."""
    _merge(
        silver_path(root, "Dim_Collaborateur"), schemas.ASSIGNEE_SILVER, clean.clean_assignees(bronze),
        ["Numero", "Affecte"], [], layout=tables.Layout(["Numero"], buckets),
    )


def load_deployments(
    bronze: DataFrame, root: str, holidays: DataFrame | Iterable,
    buckets: int = BUCKETS, days: int = PERIOD_DAYS, changes_to: str | None = None,
) -> None:
    """Clean, classify and merge a deployment extract."""
    _merge(
        silver_path(root, "MEP_silver"), schemas.DEPLOYMENTS_SILVER,
        clean.clean_deployments(bronze, holidays), schemas.DEPLOYMENT_KEYS, schemas.DEPLOYMENT_UPDATES,
        latest_at("Mis_a_jour", "Mis_h"), tables.Layout(["Numero"], buckets, "Ouvert", days), changes_to,
    )


def load_requests(
    bronze: DataFrame, root: str, buckets: int = BUCKETS, days: int = PERIOD_DAYS, changes_to: str | None = None,
) -> None:
    """Clean, classify and merge a request extract; open requests are left out."""
    _merge(
        silver_path(root, "demandes_silver"), schemas.REQUESTS_SILVER, clean.clean_requests(bronze),
        schemas.REQUEST_KEYS, schemas.REQUEST_UPDATES, latest_at("Ferme", "Ferme_h"),
        tables.Layout(["Numero"], buckets, "Cree", days), changes_to,
    )


# --- gold ---------------------------------------------------------------------------------------------
def refresh_value_dim(source: DataFrame, root: str, spec: star.ValueDim) -> None:
    """Append the labels a dimension does not have yet. A run without any writes nothing."""
    _refresh(dims.distinct_members(source, spec.column, spec.label), root, spec.name, spec.label, spec.id_col)


def _refresh(members: DataFrame, root: str, name: str, label: str, id_col: str) -> None:
    """Stage the new labels, so that numbering them reads the silver table only once."""
    spark, path = members.sparkSession, gold_path(root, name)
    tables.ensure_table(spark, path, schemas.value_dim_schema(id_col, label))
    existing = tables.read_path(spark, path)
    with tables.staged(dims.new_members(members, existing, label)) as fresh:
        if not fresh.isEmpty():
            tables.append_path(dims.assign_keys(fresh, existing, label, id_col), path)


def refresh_group_dim(source: DataFrame, root: str, lookup: DataFrame) -> None:
    """Typed group dimension: stable keys, types refreshed from the lookup."""
    spark, path = source.sparkSession, gold_path(root, "groupe")
    tables.ensure_table(spark, path, schemas.GROUP_DIM)
    with tables.staged(dims.distinct_members(source, "Groupe_affectation")) as members:
        tables.overwrite_path(dims.dim_group(members, lookup, tables.read_path(spark, path)), path)


def refresh_type_dim(sources: Sequence[DataFrame], root: str) -> None:
    """Ticket types shared by deployments and requests."""
    _refresh(dims.union_members(sources, "Type"), root, "type", "Type", "ID_Type")


def refresh_date_dim(source: DataFrame, root: str, spec: star.DateDim) -> None:
    """Insert new dates. A timestamp fixes its parts, so known ones stay as they are; a date with a
    time of day beside it takes an earlier time than the one it has."""
    schema = schemas.date_dim_schema(spec.date, source.schema[spec.date].dataType)
    path, members = gold_path(root, spec.name), star.date_dim(source, spec)
    if spec.time is None:
        _merge(path, schema, members, [spec.date], [])
    else:
        earliest = -(F.col("Heure") * 3600 + F.col("Minute") * 60 + F.col("Seconde"))
        _merge(path, schema, members, [spec.date], schemas.DATE_PARTS, [earliest])


def _dim_loads(source: DataFrame, root: str, dates, values) -> list[Callable[[], None]]:
    return [partial(refresh_date_dim, source, root, spec) for spec in dates] + [
        partial(refresh_value_dim, source, root, spec) for spec in values
    ]


def load_incident_gold(
    spark: SparkSession, root: str, group_lookup: DataFrame, changed: DataFrame | None = None,
    buckets: int = BUCKETS, days: int = PERIOD_DAYS,
) -> None:
    """Incident dimensions, then the fact. `changed` limits the load to rows new since the last one (`changed_rows`)."""
    source = silver(spark, root, "supervision_silver") if changed is None else changed
    star.together(
        *_dim_loads(source, root, star.INCIDENT_DATES, star.INCIDENT_DIMS),
        lambda: refresh_group_dim(source, root, group_lookup),
    )
    found = {look.dim: gold(spark, root, look.dim) for look in facts.INCIDENT_LOOKUPS}
    _merge(
        gold_path(root, "factSupervision_gold"), schemas.INCIDENTS_FACT,
        facts.fact_incidents(source, found), ["Numero"], None, ["Mis_a_jour"],
        tables.Layout(["Numero"], buckets, "Ouvert", days),
    )


def load_deployment_request_gold(
    spark: SparkSession, root: str, changed_deployments: DataFrame | None = None,
    changed_requests: DataFrame | None = None, buckets: int = BUCKETS, days: int = PERIOD_DAYS,
) -> None:
    """Deployment and request dimensions, the shared type dimension, then both facts.

    The changed rows, cleaned as silver has them, limit the load to what is new since the last one.
    """
    deployments = silver(spark, root, "MEP_silver") if changed_deployments is None else changed_deployments
    requests = silver(spark, root, "demandes_silver") if changed_requests is None else changed_requests
    star.together(
        *_dim_loads(deployments, root, star.DEPLOYMENT_DATES, star.DEPLOYMENT_DIMS),
        *_dim_loads(requests, root, star.REQUEST_DATES, star.REQUEST_DIMS),
        lambda: refresh_type_dim([requests, deployments], root),
    )
    found = {
        look.dim: gold(spark, root, look.dim)
        for look in facts.DEPLOYMENT_LOOKUPS + facts.REQUEST_LOOKUPS
    }
    star.together(
        lambda: _merge(
            gold_path(root, "factMep_gold"), schemas.DEPLOYMENTS_FACT,
            facts.fact_deployments(deployments, found), ["Numero"], None, latest_at("Mis_a_jour", "Mis_h"),
            tables.Layout(["Numero"], buckets, "Ouvert", days),
        ),
        lambda: _merge(
            gold_path(root, "factDemande_gold"), schemas.REQUESTS_FACT,
            facts.fact_requests(requests, found), ["Numero"], None, latest_at("Ferme", "Ferme_h"),
            tables.Layout(["Numero"], buckets, "Cree", days),
        ),
    )


def register_views(spark: SparkSession, root: str, layer: str, names: Iterable[str]) -> None:
    """Temporary views over stored tables, for `spark.sql`."""
    for name in names:
        tables.read_path(spark, f"{root}/{layer}/{name}").createOrReplaceTempView(name)
