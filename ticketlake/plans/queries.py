"""Every operator as a query over the test tables, next to the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake import schemas
from ticketlake.functions.bands import shift_band, well_formed, working_hours_band
from ticketlake.functions.times import elapsed_seconds
from ticketlake.functions.working_time import working_seconds
from ticketlake.operators import clean, dims, facts, metrics, profiles, quality
from ticketlake.operators.incremental import deltas, folded
from ticketlake.operators.keys import max_id
from ticketlake.operators.upsert import changed_rows, merge_changes, upsert
from ticketlake.plans import fixtures as fx
from ticketlake.plans import jobs, star
from ticketlake.plans.oracle_views import hours_band_sql, shift_sql, with_views
from ticketlake.session import scratch_path, table_buckets
from ticketlake.sources import readers, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = with_views(sql)


def query(name: str, sql: str | None):
    def register(function: Query) -> Query:
        add(name, function, sql)
        return function

    return register


def as_csv(df: DataFrame, sep: str = ",") -> str:
    """The rows as a CSV extract with a header, in the scratch folder."""
    path = scratch_path(df.sparkSession, "csv")
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


def without_zone(df: DataFrame) -> DataFrame:
    """Session-zone timestamps as the wall-clock values they were read from."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


# --- sources and sinks ------------------------------------------------------------------------------
INCIDENT_COLUMNS = ", ".join(schemas.INCIDENTS_CSV.names)


@query("scan_incidents", f"SELECT {INCIDENT_COLUMNS} FROM v_incidents")
def scan_incidents(spark, sf):
    return without_zone(readers.read_csv(spark, as_csv(fx.incidents(spark, sf)), schemas.INCIDENTS_CSV))


@query("scan_shift", "SELECT Ouvert, Plage_horaire FROM v_shift")
def scan_shift(spark, sf):
    return without_zone(readers.read_csv(spark, as_csv(fx.shift(spark, sf)), schemas.SHIFT_CSV))


@query("scan_assignee", 'SELECT Numero AS "Numéro", Affecte AS "Affecté à" FROM v_assignee')
def scan_assignee(spark, sf):
    return readers.read_csv(spark, as_csv(fx.assignee(spark, sf)), schemas.ASSIGNEE_CSV)


DEPLOY_CSV_SQL = """
    SELECT Numero AS "Numéro", Ouvert, Mis_a_jour AS "Mis à jour", 'SOC' AS "Société", 'P1' AS "Priorité",
           Description_breve AS "Description brève", 'GRP' AS "Groupe d'affectation", Etat AS "État",
           Ouvert_par AS "Ouvert par", 'CAT' AS "Catégorie", 'EXT' AS "N° de ticket externe", Ovrt_h, Mis_h
    FROM v_deploy_raw"""


@query("scan_deployments", DEPLOY_CSV_SQL)
def scan_deployments(spark, sf):
    extract = as_csv(fx.deployments_csv(fx.deployments_raw(spark, sf)), sep=";")
    return readers.read_csv(spark, extract, schemas.DEPLOYMENTS_CSV, sep=";")


@query("scan_requests", """
    SELECT Cree AS "Créé", Ferme AS "Fermé", Numero AS "Numéro", Description_breve AS "Description brève",
           'GRP' AS "Groupe d'affectation", Affecte_a AS "Affecté à", Task_Duration AS "Task Duration",
           Cree_h AS "Créé_h", Ferme_h AS "Fermé_h" FROM v_request_raw""")
def scan_requests(spark, sf):
    extract = as_csv(fx.requests_csv(fx.requests_raw(spark, sf)))
    return readers.read_csv(spark, extract, schemas.REQUESTS_CSV)


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("scan_path", f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def scan_path(spark, sf):
    """A Parquet file by its path alone."""
    return without_zone(readers.read_path(spark, f"{sf}/orders.parquet")).select(*ORDER_COLUMNS)


@query("scan_format", "SELECT Numero, Affecte FROM v_assignee")
def scan_format(spark, sf):
    """A folder by an explicit format."""
    path = scratch_path(spark, "orc")
    fx.assignee(spark, sf).write.orc(path)
    return readers.read_path(spark, path, "orc").select("Numero", "Affecte")


@query("scan_table", "SELECT Etat, count(*) AS tickets FROM v_incidents GROUP BY Etat")
def scan_table(spark, sf):
    """A catalog table: created, filled, read by name and grouped through SQL."""
    name = f"supervision_{uuid.uuid4().hex}"
    tables.create_catalog_table(spark, name, schemas.INCIDENTS_SILVER, scratch_path(spark, "catalog"))
    fx.incidents(spark, sf).select(*schemas.INCIDENTS_SILVER.names).write.insertInto(name)
    return spark.sql("SELECT Etat, count(*) AS tickets FROM {t} GROUP BY Etat", t=readers.read_table(spark, name))


@query("sql_preview", f"SELECT {INCIDENT_COLUMNS} FROM v_incidents ORDER BY Ouvert NULLS FIRST, Numero NULLS FIRST LIMIT 1000")
def sql_preview(spark, sf):
    return readers.preview(fx.incidents(spark, sf), ["Ouvert", "Numero"], 1000)


@query("land_bronze", f"""
    SELECT {INCIDENT_COLUMNS}, load_at AS _loaded_at, 'extract' AS _source, load_at::DATE AS _load_date,
           strftime(load_at, '%H%M%S') AS _load_run
    FROM v_load1, (SELECT TIMESTAMP '2024-02-01 06:00:00' AS load_at)
    UNION ALL
    SELECT {INCIDENT_COLUMNS}, load_at, 'extract', load_at::DATE, strftime(load_at, '%H%M%S')
    FROM v_load2, (SELECT TIMESTAMP '2024-02-02 06:30:00' AS load_at)""")
def land_bronze(spark, sf):
    path = scratch_path(spark, "bronze")
    first, second = fx.incident_loads(spark, sf)
    readers.land_bronze(first, dt.datetime(2024, 2, 1, 6), path, "extract")
    readers.land_bronze(second, dt.datetime(2024, 2, 2, 6, 30), path, "extract")
    return readers.land_bronze(second, dt.datetime(2024, 2, 2, 6, 30), path, "extract")  # repeated


@query("rename_overwrite", """
    SELECT row_number() OVER (ORDER BY Ouvert_par NULLS FIRST) AS ID_Collaborateur, Ouvert_par AS Collaborateur
    FROM (SELECT DISTINCT Ouvert_par FROM v_deploy_raw)""")
def rename_overwrite(spark, sf):
    path = scratch_path(spark, "dim")
    members = dims.distinct_members(fx.deployments_raw(spark, sf), "Ouvert_par")
    tables.overwrite_path(dims.extend_dim(members, None, "Ouvert_par", "ID_Collaborateur"), path)
    tables.rename_overwrite(spark, path, {"Ouvert_par": "Collaborateur"})
    return tables.read_path(spark, path)


# --- projections and predicates -----------------------------------------------------------------------
@query("clean_rename", """
    SELECT Numero, Ouvert, Mis_a_jour, 'SOC' AS Societe, 'P1' AS Priorite, Description_breve,
           'GRP' AS Groupe_affectation, Etat, Ouvert_par, 'CAT' AS Categorie,
           'EXT' AS Numero_ticket_externe, Ovrt_h, Mis_h FROM v_deploy_raw""")
def clean_rename(spark, sf):
    bronze = fx.deployments_csv(fx.deployments_raw(spark, sf))
    return clean.rename_columns(bronze, {**schemas.DEPLOYMENT_RENAMES, "Description": "Description"})


@query("clean_drop", """
    SELECT Numero, Ouvert, Mis_a_jour, Description_breve, Etat, Ouvert_par, Ovrt_h, Mis_h FROM v_deploy_raw""")
def clean_drop(spark, sf):
    return clean.drop_columns(clean_rename(spark, sf), schemas.DEPLOYMENT_DROPS)


@query("clean_deployments", "SELECT * FROM v_deploy")
def clean_deployments(spark, sf):
    return clean.clean_deployments(fx.deployments_csv(fx.deployments_raw(spark, sf)), fx.HOLIDAYS)


@query("clean_requests", "SELECT * FROM v_request")
def clean_requests(spark, sf):
    return clean.clean_requests(fx.requests_csv(fx.requests_raw(spark, sf)))


add("tag_type", lambda s, sf: clean.tag_type(fx.deployments_raw(s, sf), schemas.DEPLOYMENT_TYPE),
    "SELECT *, 'Mise en production' AS Type FROM v_deploy_raw")
add("filter_closed", lambda s, sf: clean.keep_closed(fx.requests_raw(s, sf), ["Ferme", "Ferme_h"]),
    "SELECT * FROM v_request_raw WHERE Ferme IS NOT NULL AND Ferme_h IS NOT NULL")


@query("count_by_type", """
    SELECT count(*) AS rows FROM (SELECT Type FROM v_deploy UNION ALL SELECT Type FROM v_request)
    WHERE Type = 'Mise en production'""")
def count_by_type(spark, sf):
    both = fx.deployments(spark, sf).select("Type").unionByName(fx.requests(spark, sf).select("Type"))
    return quality.row_count(clean.filter_eq(both, "Type", schemas.DEPLOYMENT_TYPE))


@query("hno_rows", """
    SELECT Ouvert, Ovrt_h, Plages_horaires FROM v_deploy WHERE Plages_horaires = 'HNO'
    ORDER BY Ouvert NULLS FIRST, Ovrt_h NULLS FIRST""")
def hno_rows(spark, sf):
    off = clean.filter_eq(fx.deployments(spark, sf), "Plages_horaires", "HNO")
    return clean.ordered(off.select("Ouvert", "Ovrt_h", "Plages_horaires"), ["Ouvert", "Ovrt_h"])


@query("bad_dates", """
    SELECT count(*) AS rows, count(*) FILTER (event_id % 17 = 0) AS bad_rows,
           count(*) FILTER (event_id % 17 = 0) AS null_dates
    FROM events WHERE event_type IN ('error', 'purchase', 'signup')""")
def bad_dates(spark, sf):
    read = readers.read_csv(spark, _mixed_extract(spark, sf), schemas.DEPLOYMENTS_CSV, keep_corrupt=True)
    return read.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(readers.CORRUPT).isNotNull()).alias("bad_rows"),
        F.count_if(F.col("Ouvert").isNull()).alias("null_dates"),
    )


def _mixed_extract(spark, sf) -> str:
    """Deployments as CSV, whose opening date is now and then in another format."""
    raw = fx.deployments_raw(spark, sf)
    number = F.substring("Numero", 4, 18).cast("bigint")
    mixed = F.when(number % 17 == 0, F.date_format("Ouvert", "dd/MM/yyyy")).otherwise(F.col("Ouvert").cast("string"))
    return as_csv(fx.deployments_csv(raw.withColumn("Ouvert", mixed)))


def _quarantined(spark, sf) -> readers.Quarantine:
    extract = readers.read_csv(spark, _mixed_extract(spark, sf), schemas.DEPLOYMENTS_CSV, keep_corrupt=True)
    number, _, updated, *_, clock, _ = schemas.DEPLOYMENTS_CSV.names
    rules = {
        "no time": F.col(f"`{clock}`").isNull(), "bad time": ~well_formed(F.col(f"`{clock}`")),
        "not updated": F.col(f"`{updated}`").isNull() | F.col(f"`{number}`").isNull(),
    }
    return readers.quarantine(extract, rules, scratch_path(spark, "quarantine"))


_QUARANTINE_SQL = """(SELECT Numero, concat_ws(',', CASE WHEN substr(Numero, 4)::BIGINT % 17 = 0 THEN 'malformed' END,
        CASE WHEN Ovrt_h IS NULL THEN 'no time' END,
        CASE WHEN NOT regexp_matches(Ovrt_h, '^[0-9]+:[0-9]+:[0-9]+$') THEN 'bad time' END) AS reasons FROM v_deploy_raw)"""


@query("scan_quarantine", f"SELECT Numero, reasons, reasons = '' AS good FROM {_QUARANTINE_SQL}")
def scan_quarantine(spark, sf):
    """Every row of the extract, from the side it was written to."""
    split, number = _quarantined(spark, sf), F.col(f"`{schemas.DEPLOYMENTS_CSV.names[0]}`").alias("Numero")
    bad = split.bad.select(number, F.array_join("_reasons", ",").alias("reasons"), F.lit(False).alias("good"))
    return split.good.select(number, F.lit("").alias("reasons"), F.lit(True).alias("good")).unionByName(bad)


@query("scan_quarantine_counts", f"""
    SELECT unnest(['rows', 'bad', 'malformed', 'no time', 'bad time', 'not updated']) AS what,
           unnest([count(*), count(*) FILTER (reasons <> ''), count(*) FILTER (contains(reasons, 'malformed')),
                   count(*) FILTER (contains(reasons, 'no time')), count(*) FILTER (contains(reasons, 'bad time')), 0]) AS n
    FROM {_QUARANTINE_SQL}""")
def scan_quarantine_counts(spark, sf):
    """What was observed while the rows were written."""
    return spark.createDataFrame(list(_quarantined(spark, sf).counts.items()), "what string, n long")


# --- data quality -------------------------------------------------------------------------------------
def _counts_sql(condition: str, view: str, columns) -> str:
    return "SELECT " + ", ".join(
        f"count(*) FILTER ({condition.format(c=c)}) AS {c}" for c in columns
    ) + f" FROM {view}"


REQUEST_RAW_COLUMNS = [
    "Cree", "Ferme", "Numero", "Description_breve", "Affecte_a", "Task_Duration", "Cree_h", "Ferme_h",
]
REQUEST_TEXT = ["Numero", "Description_breve", "Affecte_a", "Cree_h", "Ferme_h"]
add("dq_null_counts", lambda s, sf: quality.null_counts(fx.incidents(s, sf)),
    _counts_sql("{c} IS NULL", "v_incidents", schemas.INCIDENTS_CSV.names))
_BLANKED = "* REPLACE (CASE WHEN substr(Numero, 5)::BIGINT % 19 = 0 THEN '' ELSE Affecte_a END AS Affecte_a)"


@query("dq_null_or_empty", _counts_sql(
    "{c} IS NULL OR {c}::VARCHAR = ''", f"(SELECT {_BLANKED} FROM v_request_raw)", REQUEST_RAW_COLUMNS))
def dq_null_or_empty(spark, sf):
    raw = fx.requests_raw(spark, sf)
    blank = F.when(F.substring("Numero", 5, 18).cast("bigint") % 19 == 0, "").otherwise(F.col("Affecte_a"))
    return quality.null_or_empty_counts(raw.withColumn("Affecte_a", blank))


add("dq_row_count", lambda s, sf: quality.row_count(fx.incidents(s, sf)),
    "SELECT count(*) AS rows FROM v_incidents")
DUPLICATES_SQL = """
    SELECT count(*) AS total, (SELECT count(*) FROM (SELECT DISTINCT * FROM v_shift)) AS distinct_rows,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v_shift)) AS duplicates FROM v_shift"""
add("dq_duplicate_count", lambda s, sf: quality.duplicate_count(fx.shift(s, sf)), DUPLICATES_SQL)
add("dq_duplicate_verdict", lambda s, sf: quality.duplicate_report(fx.shift(s, sf)), f"""
    SELECT *, CASE WHEN duplicates = 0 THEN 'none' ELSE duplicates::VARCHAR || ' duplicates' END AS verdict
    FROM ({DUPLICATES_SQL})""")
LINE_KEYS = ["l_orderkey", "l_linenumber"]
add("dq_duplicate_keys", lambda s, sf: quality.duplicate_keys(fx.table(s, sf, "lineitem"), LINE_KEYS), """
    SELECT l_orderkey, l_linenumber, count(*) AS nb FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
add("dq_duplicate_rows", lambda s, sf: quality.duplicate_rows(fx.table(s, sf, "lineitem"), LINE_KEYS), """
    SELECT * FROM lineitem JOIN (SELECT l_orderkey, l_linenumber, count(*) AS nb FROM lineitem
        GROUP BY ALL HAVING count(*) > 1) USING (l_orderkey, l_linenumber)""")
add("dedup_full", lambda s, sf: quality.dedup(fx.shift(s, sf)), "SELECT DISTINCT * FROM v_shift")
add("dedup_keys",
    lambda s, sf: quality.dedup_keys(fx.table(s, sf, "lineitem"), LINE_KEYS, [F.col("l_shipdate").desc()]), """
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                 l_tax, l_returnflag, l_linestatus) = 1""")
add("dq_cardinality", lambda s, sf: quality.cardinality(fx.incidents(s, sf), "Groupe_affectation"),
    "SELECT count(*) AS n_distinct FROM (SELECT DISTINCT Groupe_affectation FROM v_incidents)")
add("dq_distinct_values", lambda s, sf: quality.distinct_values(fx.incidents(s, sf), "Categorie"),
    "SELECT DISTINCT Categorie FROM v_incidents")
add("dq_value_counts", lambda s, sf: quality.value_counts(fx.deployments(s, sf), ["Plages_horaires"]),
    "SELECT Plages_horaires, count(*) AS n FROM v_deploy GROUP BY ALL")
add("dq_required", lambda s, sf: quality.required(fx.incidents(s, sf), schemas.INCIDENTS_CSV.names),
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null FROM v_incidents"
        for c in schemas.INCIDENTS_CSV.names) + ") WHERE n_null > 0")
_PROFILED = ["Numero", "Affecte"]
add("dq_profile", lambda s, sf: quality.profile(fx.assignee(s, sf)),
    "SELECT count(*) AS rows, " + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}_null, count(*) FILTER ({c} = '') AS {c}_empty" for c in _PROFILED)
    + " FROM v_assignee")


# --- profiles kept up to date from states by load ------------------------------------------------------
_COUNTED = ["Etat", "Priorite", "Groupe_affectation"]
_ALL_LOADS = "(SELECT * FROM v_load1 UNION ALL SELECT * FROM v_load2)"


def _kept_profile(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Two extracts profiled one by one; the second is delivered twice."""
    path = scratch_path(spark, "profile")
    first, second = fx.incident_loads(spark, sf)
    for name, load in (("first", first), ("second", second), ("second", second)):
        profiles.keep_load(load, path, name, _COUNTED)
    return profiles.kept_profile(spark, path)


def _shown_sql(column: str) -> str:
    return f"CASE typeof({column}) WHEN 'VARCHAR' THEN {column}::VARCHAR ELSE strftime(TRY_CAST({column} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END"


@query("dq_profile_merged", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS n_null,
        count(*) FILTER ({c}::VARCHAR = '') AS n_empty, {_shown_sql(f'min({c})')} AS least,
        {_shown_sql(f'max({c})')} AS greatest FROM {_ALL_LOADS}""" for c in schemas.INCIDENTS_CSV.names))
def dq_profile_merged(spark, sf):
    """The exact columns; the estimates of distinct values are tested against their error."""
    return _kept_profile(spark, sf)[0].drop("distinct_estimate")


@query("dq_value_counts_merged", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c}::VARCHAR AS value, count(*) AS n FROM {_ALL_LOADS} GROUP BY ALL""" for c in _COUNTED))
def dq_value_counts_merged(spark, sf):
    return _kept_profile(spark, sf)[1]


# --- classifiers --------------------------------------------------------------------------------------
add("band_ho_hno",
    lambda s, sf: fx.deployments_raw(s, sf).select(
        "Numero", "Ouvert", "Ovrt_h",
        working_hours_band(F.col("Ouvert"), F.col("Ovrt_h"), fx.HOLIDAYS).alias("band")),
    f"SELECT Numero, Ouvert, Ovrt_h, {hours_band_sql('Ouvert', 'Ovrt_h')} AS band FROM v_deploy_raw")
add("band_shift",
    lambda s, sf: fx.deployments_raw(s, sf).select(
        "Numero", "Ovrt_h", shift_band(F.col("Ovrt_h")).alias("band")),
    f"SELECT Numero, Ovrt_h, {shift_sql('Ovrt_h')} AS band FROM v_deploy_raw")
add("group_type",
    lambda s, sf: dims.group_type(
        fx.incidents(s, sf).select("Numero", "Groupe_affectation"), fx.group_types(s)), """
    SELECT Numero, Groupe_affectation, coalesce(type, 'Autre') AS Type_Groupe
    FROM v_incidents LEFT JOIN v_group_types ON Groupe_affectation = label""")

# --- dimensions ---------------------------------------------------------------------------------------
_TS_PARTS = ", ".join(
    f"{part}({{c}})::INTEGER AS {name}" for part, name in
    [("day", "Jour"), ("month", "Mois"), ("year", "Annee"), ("hour", "Heure"), ("minute", "Minute"),
     ("second", "Seconde")])
for _name, _column in [("dim_date_open", "Ouvert"), ("dim_date_update", "Mis_a_jour")]:
    add(_name, lambda s, sf, c=_column: dims.date_dim_from_ts(fx.incidents(s, sf), c),
        f"SELECT DISTINCT {_column}, {_TS_PARTS.format(c=_column)} FROM v_incidents")


def _date_dim_sql(view: str, date: str, time: str) -> str:
    part = [f"TRY_CAST(string_split({time}, ':')[{i}] AS INTEGER)" for i in (1, 2, 3)]
    clock = (
        f"CASE WHEN len(string_split({time}, ':')) = 3 AND {part[0]} BETWEEN 0 AND 23 AND {part[1]} BETWEEN 0"
        f" AND 59 AND {part[2]} BETWEEN 0 AND 59 THEN {part[0]} * 3600 + {part[1]} * 60 + {part[2]} END"
    )
    return f"""
        SELECT {date}, day({date})::INTEGER AS Jour, month({date})::INTEGER AS Mois, year({date})::INTEGER AS Annee,
               (sec // 3600)::INTEGER AS Heure, (sec % 3600 // 60)::INTEGER AS Minute, (sec % 60)::INTEGER AS Seconde
        FROM (SELECT {date}, min({clock}) AS sec FROM {view} GROUP BY ALL)"""


for _name, _source, _view, _date, _time in [
    ("dim_date_deploy", fx.deployments_raw, "v_deploy_raw", "Ouvert", "Ovrt_h"),
    ("dim_date_deploy_update", fx.deployments_raw, "v_deploy_raw", "Mis_a_jour", "Mis_h"),
    ("dim_date_request", fx.requests, "v_request", "Cree", "Cree_h"),
    ("dim_date_request_close", fx.requests, "v_request", "Ferme", "Ferme_h"),
]:
    add(_name, lambda s, sf, src=_source, d=_date, t=_time: dims.date_dim_from_date(src(s, sf), d, t),
        _date_dim_sql(_view, _date, _time))

add("dim_members", lambda s, sf: dims.distinct_members(fx.incidents(s, sf), "Groupe_affectation"),
    "SELECT DISTINCT Groupe_affectation FROM v_incidents")


def dim_sql(view: str, column: str, label: str, id_col: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY {label} NULLS FIRST) AS {id_col}, {label}
        FROM (SELECT DISTINCT {column} AS {label} FROM {view})"""


def incremental_sql(first: str, second: str, column: str, label: str, id_col: str) -> str:
    return f"""WITH old AS ({dim_sql(first, column, label, id_col)})
        SELECT {id_col}, {label} FROM old UNION ALL
        SELECT (SELECT coalesce(max({id_col}), 0) FROM old) + row_number() OVER (ORDER BY {label} NULLS FIRST), {label}
        FROM (SELECT DISTINCT {column} AS {label} FROM {second}) AS new
        WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.{label} IS NOT DISTINCT FROM new.{label})"""


def _loads(kind: str, spark, sf) -> tuple[DataFrame, DataFrame]:
    if kind == "incidents":
        return fx.incident_loads(spark, sf)
    silver = fx.deployments(spark, sf) if kind == "deployments" else fx.requests(spark, sf)
    start = 4 if kind == "deployments" else 5
    return fx.events_split(silver, F.substring("Numero", start, 18).cast("bigint"))


_LOAD_VIEWS = {
    "incidents": ("v_load1", "v_load2"),
    "deployments": tuple(f"(SELECT * FROM v_deploy WHERE substr(Numero, 4)::BIGINT % 10 {c})" for c in ("< 7", ">= 5")),
    "requests": tuple(f"(SELECT * FROM v_request WHERE substr(Numero, 5)::BIGINT % 10 {c})" for c in ("< 7", ">= 5")),
}


def stored(df: DataFrame) -> DataFrame:
    """A frame written as a table and read back, the way the next load finds it."""
    path = scratch_path(df.sparkSession, "table")
    tables.overwrite_path(df, path)
    return tables.read_path(df.sparkSession, path)


def incremental(spark, sf, kind: str, spec: star.ValueDim) -> DataFrame:
    first, second = _loads(kind, spark, sf)
    return star.value_dim(second, spec, existing=stored(star.value_dim(first, spec)))


_GROUP = star.ValueDim("groupe", "Groupe_affectation", "Groupe_affectation", "ID_Groupe_affectation")
_INC = {spec.name: spec for spec in star.INCIDENT_DIMS}
_DEP = {spec.name: spec for spec in star.DEPLOYMENT_DIMS}
_REQ = {spec.name: spec for spec in star.REQUEST_DIMS}
VALUE_DIMS = [
    ("dim_company", "incidents", _INC["societe"]), ("dim_category", "incidents", _INC["categorie"]),
    ("dim_state", "incidents", _INC["etat"]), ("dim_priority", "incidents", _INC["priorite"]),
    ("dim_group", "incidents", _GROUP), ("dim_opener", "incidents", _INC["ouvert_par"]),
    ("dim_description", "deployments", _DEP["description"]),
    ("dim_collaborator", "deployments", _DEP["collaborateur"]),
    ("dim_band", "deployments", _DEP["plage_horaires"]),
    ("dim_description_request", "requests", _REQ["description_d"]),
    ("dim_collaborator_request", "requests", _REQ["collaborateur_d"]),
    ("dim_band_request", "requests", _REQ["plage_horaires_d"]),
]
_SILVER = {"incidents": fx.incidents, "deployments": fx.deployments, "requests": fx.requests}
_VIEW = {"incidents": "v_incidents", "deployments": "v_deploy", "requests": "v_request"}
for _name, _kind, _spec in VALUE_DIMS:
    add(_name, lambda s, sf, k=_kind, sp=_spec: star.value_dim(_SILVER[k](s, sf), sp),
        dim_sql(_VIEW[_kind], _spec.column, _spec.label, _spec.id_col))
    add(f"{_name}_incremental", lambda s, sf, k=_kind, sp=_spec: incremental(s, sf, k, sp),
        incremental_sql(*_LOAD_VIEWS[_kind], _spec.column, _spec.label, _spec.id_col))


@query("dim_new_members", """
    SELECT DISTINCT Ouvert_par FROM v_load2 WHERE Ouvert_par NOT IN (SELECT Ouvert_par FROM v_load1)""")
def dim_new_members(spark, sf):
    first, second = fx.incident_loads(spark, sf)
    known = star.value_dim(first, _INC["ouvert_par"])
    return dims.new_members(dims.distinct_members(second, "Ouvert_par"), known, "Ouvert_par")


add("dim_max_id", lambda s, sf: max_id(star.value_dim(fx.incidents(s, sf), _INC["ouvert_par"]), "ID_Ouvert_par"),
    "SELECT count(DISTINCT Ouvert_par) AS max_id FROM v_incidents")
add("dim_group_typed",
    lambda s, sf: dims.dim_group(
        dims.distinct_members(fx.incidents(s, sf), "Groupe_affectation"), fx.group_types(s)), f"""
    SELECT ID_Groupe_affectation, Groupe_affectation, coalesce(type, 'Autre') AS Type_Groupe
    FROM ({dim_sql('v_incidents', 'Groupe_affectation', 'Groupe_affectation', 'ID_Groupe_affectation')})
    LEFT JOIN v_group_types ON Groupe_affectation = label""")
add("dim_type",
    lambda s, sf: dims.extend_dim(
        dims.union_members([fx.requests(s, sf), fx.deployments(s, sf)], "Type"), None, "Type", "ID_Type"),
    dim_sql("(SELECT Type FROM v_request UNION SELECT Type FROM v_deploy)", "Type", "Type", "ID_Type"))


@query("dim_shift", "SELECT DISTINCT * FROM v_shift")
def dim_shift(spark, sf):
    """Reference table: loaded, merged twice, deduplicated and written over itself."""
    path = scratch_path(spark, "shift")
    keys = ["Ouvert", "Plage_horaire"]
    rows = fx.shift(spark, sf)
    layout = tables.Layout(keys, 4)
    tables.ensure_table(spark, path, rows.schema, layout)
    tables.upsert_table(spark, path, rows, keys, update_cols=[])
    tables.upsert_table(spark, path, rows, keys, update_cols=[])
    tables.overwrite_path(quality.dedup(tables.read_path(spark, path)), path, layout)
    return tables.read_path(spark, path)


@query("bridge_assignee", "SELECT DISTINCT Numero, Affecte FROM v_assignee")
def bridge_assignee(spark, sf):
    """Ticket-assignee bridge after two overlapping insert-only loads."""
    rows = clean.clean_assignees(fx.assignee(spark, sf).toDF(*schemas.ASSIGNEE_CSV.names))
    number = F.substring("Numero", 4, 18).cast("bigint")
    first, second = fx.events_split(rows, number)
    target = quality.dedup(first)
    return upsert(target, second, ["Numero", "Affecte"], update_cols=[])


# --- upserts --------------------------------------------------------------------------------------------
def upsert_sql(target: str, updates: str, keys, update_cols, columns, latest=()) -> str:
    """Full outer join on null-safe keys after reducing the updates to the latest row per key."""
    rest = [c for c in columns if c not in keys]
    order = [f"{c} DESC NULLS LAST" for c in latest] + [f"{c} NULLS FIRST" for c in rest]
    match = " AND ".join(f"t.{k} IS NOT DISTINCT FROM u.{k}" for k in keys)
    picks = ", ".join(
        f"CASE WHEN t.t_here IS NULL THEN u.{c}"
        + (f" WHEN u.u_here IS NOT NULL THEN u.{c}" if c in update_cols else "")
        + f" ELSE t.{c} END AS {c}" for c in columns)
    return f"""SELECT {picks} FROM (SELECT *, 1 AS t_here FROM {target}) t FULL OUTER JOIN
        (SELECT *, 1 AS u_here FROM {updates} QUALIFY row_number() OVER (
            PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) = 1) u ON {match}"""


@query("upsert_update_insert", upsert_sql(
    "v_load1", "v_load2", schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, schemas.INCIDENTS_CSV.names,
    ["Mis_a_jour"]))
def upsert_update_insert(spark, sf):
    first, second = fx.incident_loads(spark, sf)
    return upsert(first, second, schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, latest_by=["Mis_a_jour"])


@query("upsert_stored", upsert_sql(
    "v_load1", "v_load2", schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, schemas.INCIDENTS_CSV.names,
    ["Mis_a_jour"]))
def upsert_stored(spark, sf):
    """The same through a stored table: first load, second load, second load again."""
    first, second = fx.incident_loads(spark, sf)
    path = scratch_path(spark, "silver")
    layout = tables.Layout(["Numero"], buckets=2, period="Ouvert", days=365)
    tables.ensure_table(spark, path, first.schema, layout)
    for load in (first, second, second):
        tables.upsert_table(
            spark, path, load, schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, latest_by=["Mis_a_jour"])
    return tables.read_path(spark, path)


_CHANGED = [c for c in schemas.INCIDENTS_CSV.names if c not in schemas.INCIDENT_KEYS]


@query("upsert_changes", f"""
    SELECT coalesce(t.Numero, u.Numero) AS Numero, coalesce(t.Groupe_affectation, u.Groupe_affectation) AS Groupe_affectation,
           CASE WHEN t.here IS NULL THEN 'insert' ELSE 'update' END AS op, t.Etat AS state_before, t.Mis_a_jour AS changed_before,
           u.Etat AS state_after, u.Mis_a_jour AS changed_after
    FROM (SELECT * FROM v_load2 QUALIFY row_number() OVER (PARTITION BY {', '.join(schemas.INCIDENT_KEYS)} ORDER BY
          Mis_a_jour DESC NULLS LAST, {', '.join(f'{c} NULLS FIRST' for c in _CHANGED)}) = 1) u
    LEFT JOIN (SELECT *, 1 AS here FROM v_load1) t ON {' AND '.join(f't.{k} IS NOT DISTINCT FROM u.{k}' for k in schemas.INCIDENT_KEYS)}
    WHERE t.here IS NULL OR {' OR '.join(f't.{c} IS DISTINCT FROM u.{c}' for c in schemas.INCIDENT_UPDATES)}""")
def upsert_changes(spark, sf):
    """What the second extract changes in silver: told by the function, row by row."""
    first, second = fx.incident_loads(spark, sf)
    changes = merge_changes(first, second, schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, latest_by=["Mis_a_jour"])
    return changes.select(
        "after.Numero", "after.Groupe_affectation", "op", F.col("before.Etat").alias("state_before"),
        F.col("before.Mis_a_jour").alias("changed_before"), F.col("after.Etat").alias("state_after"),
        F.col("after.Mis_a_jour").alias("changed_after"))


@query("upsert_deployments", upsert_sql(
    _LOAD_VIEWS["deployments"][0],
    f"(SELECT * REPLACE ('Clos' AS Etat) FROM {_LOAD_VIEWS['deployments'][1]})",
    schemas.DEPLOYMENT_KEYS, schemas.DEPLOYMENT_UPDATES, schemas.DEPLOYMENTS_SILVER.names))
def upsert_deployments(spark, sf):
    first, second = _loads("deployments", spark, sf)
    return upsert(first, second.withColumn("Etat", F.lit("Clos")), schemas.DEPLOYMENT_KEYS, schemas.DEPLOYMENT_UPDATES)


@query("upsert_requests", upsert_sql(
    _LOAD_VIEWS["requests"][0],
    f"(SELECT * REPLACE ((Cree + 1)::DATE AS Cree, '12:00:00' AS Cree_h) FROM {_LOAD_VIEWS['requests'][1]})",
    schemas.REQUEST_KEYS, schemas.REQUEST_UPDATES, schemas.REQUESTS_SILVER.names))
def upsert_requests(spark, sf):
    """Matching requests keep their creation date but take the new time of day."""
    first, second = _loads("requests", spark, sf)
    moved = second.withColumns({"Cree": F.date_add("Cree", 1), "Cree_h": F.lit("12:00:00")})
    return upsert(first, moved, schemas.REQUEST_KEYS, schemas.REQUEST_UPDATES)


_FACT_SQL_IDS = [
    ("societe", "Societe", "ID_Societe"), ("priorite", "Priorite", "ID_Priorite"),
    ("groupe", "Groupe_affectation", "ID_Groupe_affectation"), ("etat", "Etat", "ID_Etat"),
    ("ouvert_par", "Ouvert_par", "ID_Ouvert_par"), ("categorie", "Categorie", "ID_Categorie"),
]


def fact_sql(view: str, members: str, attrs, ids) -> str:
    """Star lookup by label; a NULL label keeps a NULL key. `ids` is `(alias, column, key)`."""
    joins = " ".join(
        f"LEFT JOIN ({dim_sql(members, column, 'lab_' + alias, key)}) {alias} ON f.{column} = {alias}.lab_{alias}"
        for alias, column, key in ids)
    keys = ", ".join(f"{alias}.{key}" for alias, _, key in ids)
    return f"SELECT {', '.join('f.' + a for a in attrs)}, {keys} FROM {view} f {joins}"


@query("upsert_fact", f"""WITH old_fact AS ({fact_sql('v_load1', 'v_incidents', facts.INCIDENT_ATTRS, _FACT_SQL_IDS)}),
    new_fact AS ({fact_sql('v_load2', 'v_incidents', facts.INCIDENT_ATTRS, _FACT_SQL_IDS)}) """ + upsert_sql(
    "old_fact", "new_fact", ["Numero"], schemas.INCIDENTS_FACT.names[1:], schemas.INCIDENTS_FACT.names, ["Mis_a_jour"]))
def upsert_fact(spark, sf):
    """Fact upsert by ticket number; a reassigned ticket arrives twice and its later row wins."""
    found = star.stored_dims(spark, sf, *[look.dim for look in facts.INCIDENT_LOOKUPS])
    first, second = fx.incident_loads(spark, sf)
    return upsert(
        facts.fact_incidents(first, found), facts.fact_incidents(second, found), ["Numero"],
        latest_by=["Mis_a_jour"])


_STATES = [("9:05:00", "A"), ("10:00:00", "B"), ("ab:cd:ef", "C"), ("25:00:00", "D")]
_STATES_SQL = "(VALUES ('9:05:00', 'A'), ('10:00:00', 'B'), ('ab:cd:ef', 'C'), ('25:00:00', 'D')) AS s(moment, note)"


def _clock_seconds(time: str) -> str:
    """Second of the day of a well-formed time in SQL, else NULL."""
    h, m, s = (f"TRY_CAST(string_split({time}, ':')[{i}] AS INTEGER)" for i in (1, 2, 3))
    return (f"CASE WHEN len(string_split({time}, ':')) = 3 AND {h} BETWEEN 0 AND 23 AND {m} BETWEEN 0 AND 59"
            f" AND {s} BETWEEN 0 AND 59 THEN {h} * 3600 + {m} * 60 + {s} END")


def _in_states(df: DataFrame, time: str, note: str) -> DataFrame:
    """Every ticket four times: unpadded, later, malformed and out of range, in this text order."""
    states = F.array(*[F.struct(F.lit(t).alias("at"), F.lit(n).alias("note")) for t, n in _STATES])
    return df.withColumn("__s", F.explode(states)).withColumns({time: F.col("__s.at"), note: F.col("__s.note")}).drop("__s")


def timed_upsert_sql(target: str, updates: str, keys, columns, date: str, time: str) -> str:
    """Upsert in which the latest state by real time wins, a stored one included."""
    rest = [c for c in columns if c not in keys]

    def age(side: str) -> str:
        moment = f"epoch({side}{date}::TIMESTAMP) + {_clock_seconds(side + time)}"
        return f"coalesce({moment}, -1e18), coalesce({side}{date}, DATE '0001-01-01')"

    order = ", ".join([f"coalesce(epoch({date}::TIMESTAMP) + {_clock_seconds(time)}, -1e18) DESC", f"{date} DESC NULLS LAST"]
                      + [f"{c} NULLS FIRST" for c in rest])
    match = " AND ".join(f"t.{k} IS NOT DISTINCT FROM u.{k}" for k in keys)
    inner = ", ".join([f"t.{c} AS t_{c}" for c in columns] + [f"u.{c} AS u_{c}" for c in columns])
    picks = ", ".join(f"CASE WHEN newer THEN u_{c} ELSE t_{c} END AS {c}" for c in columns)
    return f"""SELECT {picks} FROM (SELECT {inner},
        t.here IS NULL OR (u.here IS NOT NULL AND ({age('u.')}) >= ({age('t.')})) AS newer
        FROM (SELECT *, 1 AS here FROM {target}) t FULL OUTER JOIN
        (SELECT *, 1 AS here FROM {updates} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1) u
        ON {match})"""


def _timed_views(kind: str, date: str, time: str, note: str) -> tuple[str, str]:
    first, second = _LOAD_VIEWS[kind]
    return first, f"(SELECT d.* REPLACE (s.moment AS {time}, s.note AS {note}) FROM {second} d CROSS JOIN {_STATES_SQL})"


def _dims_view(view: str, second: str) -> str:
    return f"(SELECT * FROM {view} UNION ALL SELECT * FROM {second})"


@query("upsert_timed_deployments", timed_upsert_sql(
    *_timed_views("deployments", "Mis_a_jour", "Mis_h", "Etat"), schemas.DEPLOYMENT_KEYS,
    schemas.DEPLOYMENTS_SILVER.names, "Mis_a_jour", "Mis_h"))
def upsert_timed_deployments(spark, sf):
    """Silver merge: of unpadded, malformed and stored times the latest real one wins."""
    first, second = _loads("deployments", spark, sf)
    return upsert(first, _in_states(second, "Mis_h", "Etat"), schemas.DEPLOYMENT_KEYS,
                  latest_by=jobs.latest_at("Mis_a_jour", "Mis_h"), keep_newer=True)


@query("upsert_fact_deployments", f"""WITH old_fact AS (
    SELECT {', '.join(facts.DEPLOYMENT_ATTRS)} FROM {_LOAD_VIEWS['deployments'][0]}),
    new_fact AS (SELECT {', '.join(facts.DEPLOYMENT_ATTRS)} FROM {_timed_views('deployments', 'Mis_a_jour', 'Mis_h', 'Etat')[1]})
    """ + timed_upsert_sql("old_fact", "new_fact", ["Numero"], facts.DEPLOYMENT_ATTRS, "Mis_a_jour", "Mis_h"))
def upsert_fact_deployments(spark, sf):
    """Fact merge by ticket number; the keys follow the row that wins, its attributes are compared."""
    found = star.stored_dims(spark, sf, *[look.dim for look in facts.DEPLOYMENT_LOOKUPS])
    first, second = _loads("deployments", spark, sf)
    later = facts.fact_deployments(_in_states(second, "Mis_h", "Etat"), found)
    return upsert(facts.fact_deployments(first, found), later, ["Numero"],
                  latest_by=jobs.latest_at("Mis_a_jour", "Mis_h"), keep_newer=True).select(*facts.DEPLOYMENT_ATTRS)


@query("upsert_fact_requests", f"""WITH old_fact AS (
    SELECT {', '.join(facts.REQUEST_ATTRS)} FROM {_LOAD_VIEWS['requests'][0]}),
    new_fact AS (SELECT {', '.join(facts.REQUEST_ATTRS)} FROM {_timed_views('requests', 'Ferme', 'Ferme_h', 'Cree_h')[1]})
    """ + timed_upsert_sql("old_fact", "new_fact", ["Numero"], facts.REQUEST_ATTRS, "Ferme", "Ferme_h"))
def upsert_fact_requests(spark, sf):
    found = star.stored_dims(spark, sf, *[look.dim for look in facts.REQUEST_LOOKUPS])
    first, second = _loads("requests", spark, sf)
    later = facts.fact_requests(_in_states(second, "Ferme_h", "Cree_h"), found)
    return upsert(facts.fact_requests(first, found), later, ["Numero"],
                  latest_by=jobs.latest_at("Ferme", "Ferme_h"), keep_newer=True).select(*facts.REQUEST_ATTRS)


@query("upsert_insert_only", "SELECT DISTINCT * FROM v_shift")
def upsert_insert_only(spark, sf):
    rows = fx.shift(spark, sf)
    early = F.hour("Ouvert") < 12
    return upsert(quality.dedup(rows.filter(early)), rows, ["Ouvert", "Plage_horaire"], update_cols=[])


@query("upsert_attr", f"""WITH old AS ({dim_sql('v_load1', 'Groupe_affectation', 'Groupe_affectation', 'ID_Groupe_affectation')}),
    merged AS ({incremental_sql('v_load1', 'v_load2', 'Groupe_affectation', 'Groupe_affectation', 'ID_Groupe_affectation').replace('WITH old AS', 'WITH old_again AS').replace('old.', 'old_again.').replace('FROM old', 'FROM old_again')})
    SELECT ID_Groupe_affectation, Groupe_affectation, coalesce(r.type, 'Autre') AS Type_Groupe
    FROM merged LEFT JOIN v_group_types_revised r ON Groupe_affectation = r.label""")
def upsert_attr(spark, sf):
    """Typed groups after a second load with a revised lookup: keys stay, types follow."""
    first, second = fx.incident_loads(spark, sf)
    old = dims.dim_group(dims.distinct_members(first, "Groupe_affectation"), fx.group_types(spark))
    members = dims.union_members([first, second], "Groupe_affectation")
    return dims.dim_group(members, fx.group_types(spark, fx.GROUP_TYPES_REVISED), stored(old))


@query("upsert_renamed_key", incremental_sql(
    *_LOAD_VIEWS["deployments"], "Ouvert_par", "Collaborateur", "ID_Collaborateur"))
def upsert_renamed_key(spark, sf):
    """Insert-only upsert whose key has another name in the updates."""
    first, second = _loads("deployments", spark, sf)
    known = stored(star.value_dim(first, _DEP["collaborateur"]))
    members = dims.distinct_members(second, "Ouvert_par")
    fresh = dims.new_members(
        members, known.withColumnRenamed("Collaborateur", "Ouvert_par"), "Ouvert_par")
    keyed = dims.assign_keys(fresh, known, "Ouvert_par", "ID_Collaborateur")
    return upsert(known, keyed, [("Collaborateur", "Ouvert_par")], update_cols=[])


# --- facts ------------------------------------------------------------------------------------------------
add("fact_incidents", lambda s, sf: star.incident_star(s, sf)[0],
    fact_sql("v_incidents", "v_incidents", facts.INCIDENT_ATTRS, _FACT_SQL_IDS))
_TYPE_MEMBERS = "(SELECT Type FROM v_request UNION ALL SELECT Type FROM v_deploy)"


def _typed_fact_sql(view: str, attrs, ids) -> str:
    body = fact_sql(view, view, attrs, ids)
    head, tail = body.split(f" FROM {view} f ", 1)
    return f"""{head}, ty.ID_Type FROM {view} f {tail}
        LEFT JOIN ({dim_sql(_TYPE_MEMBERS, 'Type', 'lab_type', 'ID_Type')}) ty ON f.Type = ty.lab_type"""


DEPLOY_FACT_SQL = _typed_fact_sql("v_deploy", facts.DEPLOYMENT_ATTRS, [
    ("de", "Description_breve", "ID_description"), ("co", "Ouvert_par", "ID_Collaborateur"),
    ("pl", "Plages_horaires", "ID_Plage_Horaires")])
REQUEST_FACT_SQL = _typed_fact_sql("v_request", facts.REQUEST_ATTRS, [
    ("de", "Description_breve", "ID_description"), ("co", "Affecte_a", "ID_Collaborateur"),
    ("pl", "Plages_horaires", "ID_Plage_Horaires")])
add("fact_deployments", lambda s, sf: star.deployment_star(s, sf)[0], DEPLOY_FACT_SQL)
add("fact_requests", lambda s, sf: star.request_star(s, sf)[0], REQUEST_FACT_SQL)

# --- end to end -------------------------------------------------------------------------------------------
def _labelled(fact: DataFrame, lookups, gold) -> DataFrame:
    """A stored fact with its labels instead of its keys; a NULL key keeps a NULL label."""
    for i, look in enumerate(lookups):
        dim = gold(look.dim).select(F.col(look.id_col).alias(f"__id_{i}"), F.col(look.dim_key).alias(f"__label_{i}"))
        fact = fact.join(dim, F.col(look.id_col) == F.col(f"__id_{i}"), "left").drop(look.id_col, f"__id_{i}")
    return fact.withColumnsRenamed({f"__label_{i}": look.fact_key for i, look in enumerate(lookups)})


_INCIDENT_RESULT = ["Numero", "Ouvert", "Mis_a_jour", *[look.fact_key for look in facts.INCIDENT_LOOKUPS]]


@query("pipeline_incidents", f"""SELECT {', '.join(_INCIDENT_RESULT)} FROM ({upsert_sql(
    'v_load1', 'v_load2', schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, schemas.INCIDENTS_CSV.names, ['Mis_a_jour'])})
    QUALIFY row_number() OVER (PARTITION BY Numero ORDER BY Mis_a_jour DESC) = 1""")
def pipeline_incidents(spark, sf):
    """Two CSV extracts through silver into the stored gold fact, read back with its labels."""
    root = scratch_path(spark, "lake")
    for load in fx.incident_loads(spark, sf):
        jobs.load_incidents(readers.read_csv(spark, as_csv(load), schemas.INCIDENTS_CSV), root, buckets=table_buckets(spark), days=400)
        jobs.load_incident_gold(spark, root, fx.group_types(spark), buckets=table_buckets(spark), days=400)
    fact = jobs.gold(spark, root, "factSupervision_gold")
    return without_zone(_labelled(fact, facts.INCIDENT_LOOKUPS, partial(jobs.gold, spark, root)).select(*_INCIDENT_RESULT))


def _ticket_lake(spark, sf) -> str:
    """Two extracts of deployments and requests through silver into both facts; the second closes tickets."""
    root = scratch_path(spark, "lake")
    deployments = fx.events_split(fx.deployments_raw(spark, sf), F.substring("Numero", 4, 18).cast("bigint"))
    requests = fx.events_split(fx.requests_raw(spark, sf), F.substring("Numero", 5, 18).cast("bigint"))
    for part in (0, 1):
        rows = deployments[part].withColumn("Etat", F.lit("Clos")) if part else deployments[part]
        jobs.load_deployments(
            readers.read_csv(spark, as_csv(fx.deployments_csv(rows)), schemas.DEPLOYMENTS_CSV), root, fx.HOLIDAYS,
            buckets=table_buckets(spark), days=400)
        jobs.load_requests(
            readers.read_csv(spark, as_csv(fx.requests_csv(requests[part])), schemas.REQUESTS_CSV), root, buckets=table_buckets(spark), days=400)
        jobs.load_deployment_request_gold(spark, root, buckets=table_buckets(spark), days=400)
    return root


_DEPLOYMENT_RESULT = ["Numero", "Ouvert", "Mis_a_jour", "Etat", "Ovrt_h", "Mis_h",
                      *[look.fact_key for look in facts.DEPLOYMENT_LOOKUPS]]
_REQUEST_RESULT = [*facts.REQUEST_ATTRS, *[look.fact_key for look in facts.REQUEST_LOOKUPS]]


@query("pipeline_deployments", f"""
    SELECT {', '.join(_DEPLOYMENT_RESULT)} FROM (SELECT * REPLACE (
        CASE WHEN substr(Numero, 4)::BIGINT % 10 >= 5 THEN 'Clos' ELSE Etat END AS Etat) FROM v_deploy)""")
def pipeline_deployments(spark, sf):
    gold = partial(jobs.gold, spark, _ticket_lake(spark, sf))
    return _labelled(gold("factMep_gold"), facts.DEPLOYMENT_LOOKUPS, gold).select(*_DEPLOYMENT_RESULT)


@query("pipeline_requests", f"SELECT {', '.join(_REQUEST_RESULT)} FROM v_request")
def pipeline_requests(spark, sf):
    gold = partial(jobs.gold, spark, _ticket_lake(spark, sf))
    return _labelled(gold("factDemande_gold"), facts.REQUEST_LOOKUPS, gold).select(*_REQUEST_RESULT)


# --- metrics ----------------------------------------------------------------------------------------------
CLOSED, OPEN = fx.CLOSED_STATES, fx.OPEN_STATES
_CLOSED_SQL = "Etat IN ('Clos', 'Résolu')"
_SECONDS_SQL = "date_sub('second', Ouvert, Mis_a_jour)"
_MEAN_SQL = "round(sum({s})::BIGINT / count({s}) / 3600, 2)"


def _incident_metric(ids, metric):
    def run(spark, sf):
        fact, found = star.incident_star(spark, sf, ids)
        return metric(fact, found)

    return run


add("kpi_state_counts", _incident_metric(["ID_Etat"], metrics.kpi_state_counts), """
    SELECT Etat, count(*) AS tickets, (SELECT count(*) FROM v_incidents) AS total_tickets
    FROM v_incidents GROUP BY Etat""")
add("kpi_escalation", _incident_metric(["ID_Groupe_affectation"], metrics.kpi_escalation), """
    SELECT count(*) AS tickets, count(*) FILTER (type = 'Exploitation') AS escalated,
           count(*) FILTER (type = 'Supervision') AS treated,
           round(count(*) FILTER (type = 'Exploitation') / count(*), 4) AS escalation_rate
    FROM v_incidents LEFT JOIN v_group_types ON Groupe_affectation = label""")
add("kpi_mttr", _incident_metric(["ID_Etat"], lambda f, d: metrics.kpi_mttr(f, d, CLOSED)), f"""
    SELECT count(*) AS closed_tickets, {_MEAN_SQL.format(s=_SECONDS_SQL)} AS mttr_hours
    FROM v_incidents WHERE {_CLOSED_SQL}""")
add("kpi_mttr_month", _incident_metric(["ID_Etat"], lambda f, d: metrics.kpi_mttr_month(f, d, CLOSED)), f"""
    SELECT year(Ouvert)::INTEGER AS annee, month(Ouvert)::INTEGER AS mois, count(*) AS closed_tickets,
           {_MEAN_SQL.format(s=_SECONDS_SQL)} AS mttr_hours
    FROM v_incidents WHERE {_CLOSED_SQL} GROUP BY 1, 2""")
add("kpi_priority", _incident_metric(["ID_Priorite"], metrics.kpi_priority),
    "SELECT Priorite, count(*) AS tickets FROM v_incidents GROUP BY ALL")
add("kpi_team_load",
    _incident_metric(["ID_Groupe_affectation", "ID_Etat"], lambda f, d: metrics.kpi_team_load(f, d, OPEN)), """
    SELECT Groupe_affectation, count(*) AS tickets, count(*) FILTER (Etat = 'En cours') AS open_tickets
    FROM v_incidents GROUP BY ALL""")
@query("kpi_assignee_load", """
    SELECT Affecte, count(*) AS tickets FROM v_incidents
    LEFT JOIN (SELECT DISTINCT * FROM v_assignee WHERE substr(Numero, 4)::BIGINT % 10 < 9) USING (Numero) GROUP BY ALL""")
def kpi_assignee_load(spark, sf):
    """A tenth of the tickets have no assignee; extract rows that come twice count once."""
    number = F.substring("Numero", 4, 18).cast("bigint")
    assigned = fx.assignee(spark, sf).filter(number % 10 < 9)
    bridge = quality.dedup(assigned.unionByName(assigned))
    return metrics.kpi_assignee_load(star.incident_star(spark, sf, [])[0], bridge)


add("kpi_trend", _incident_metric(["ID_Etat"], lambda f, d: metrics.kpi_trend(f, d, CLOSED, OPEN)), f"""
    SELECT month, count(*) FILTER (kind = 'opened') AS opened, count(*) FILTER (kind = 'closed') AS closed,
           count(*) FILTER (kind = 'opened' AND Etat = 'En cours') AS in_progress
    FROM (SELECT date_trunc('month', Ouvert)::DATE AS month, 'opened' AS kind, Etat FROM v_incidents
          UNION ALL SELECT date_trunc('month', Mis_a_jour)::DATE, 'closed', Etat FROM v_incidents WHERE {_CLOSED_SQL})
    GROUP BY month""")


def _type_metric(metric):
    def run(spark, sf):
        deployments, found = star.deployment_star(spark, sf, ["ID_Type"])
        return metric(deployments, star.request_star(spark, sf, ["ID_Type"])[0], found)

    return run


def _clock_ts(date: str, time: str) -> str:
    return f"TRY_CAST({date}::VARCHAR || ' ' || CASE WHEN len(string_split({time}, ':')) = 3 THEN {time} END AS TIMESTAMP)"


_BOTH_SQL = f"""(SELECT Type, Ouvert AS opened,
        date_sub('second', {_clock_ts('Ouvert', 'Ovrt_h')}, {_clock_ts('Mis_a_jour', 'Mis_h')}) AS s FROM v_deploy
    UNION ALL SELECT Type, Cree, Task_Duration FROM v_request)"""
add("kpi_type_totals", _type_metric(metrics.kpi_type_totals), f"""
    SELECT Type, count(*) AS tickets, sum(count(*)) OVER ()::BIGINT AS total_tickets FROM {_BOTH_SQL} GROUP BY Type""")
add("kpi_duration_type", _type_metric(metrics.kpi_duration_type), f"""
    SELECT Type, count(s) AS measured, {_MEAN_SQL.format(s='s')} AS mean_hours FROM {_BOTH_SQL} GROUP BY Type""")
add("kpi_type_trend", _type_metric(metrics.kpi_type_trend), f"""
    SELECT date_trunc('month', opened)::DATE AS month, Type, count(*) AS tickets FROM {_BOTH_SQL} GROUP BY ALL""")


@query("kpi_band_load", """
    SELECT Collaborateur, Plages_horaires, count(*) AS tickets
    FROM (SELECT Affecte_a AS Collaborateur, Plages_horaires FROM v_request
          UNION ALL SELECT Ouvert_par, Plages_horaires FROM v_deploy) GROUP BY ALL""")
def kpi_band_load(spark, sf):
    """Requests by shift and deployments by working hours."""
    ids = ["ID_Collaborateur", "ID_Plage_Horaires"]
    requests, of_requests = star.request_star(spark, sf, ids)
    deployments, of_deployments = star.deployment_star(spark, sf, ids)
    return metrics.kpi_band_load(
        (requests, of_requests["collaborateur_d"], of_requests["plage_horaires_d"]),
        (deployments, of_deployments["collaborateur"], of_deployments["plage_horaires"]))


@query("kpi_band_share", """
    SELECT Plages_horaires, count(*) AS tickets, round(count(*) / sum(count(*)) OVER (), 4) AS share
    FROM v_deploy GROUP BY Plages_horaires""")
def kpi_band_share(spark, sf):
    fact, found = star.deployment_star(spark, sf, ["ID_Plage_Horaires"])
    return metrics.kpi_band_share(fact, found["plage_horaires"])


@query("kpi_collab_rank", f"""
    SELECT *, row_number() OVER (ORDER BY tickets DESC, mean_hours NULLS FIRST, Collaborateur NULLS FIRST) AS rank
    FROM (SELECT Collaborateur, count(*) AS tickets, {_MEAN_SQL.format(s='seconds')} AS mean_hours
          FROM (SELECT Affecte_a AS Collaborateur, Task_Duration AS seconds FROM v_request UNION ALL
                SELECT Ouvert_par, date_sub('second', {_clock_ts('Ouvert', 'Ovrt_h')}, {_clock_ts('Mis_a_jour', 'Mis_h')})
                FROM v_deploy) GROUP BY Collaborateur)""")
def kpi_collab_rank(spark, sf):
    requests, of_requests = star.request_star(spark, sf, ["ID_Collaborateur"])
    deployments, of_deployments = star.deployment_star(spark, sf, ["ID_Collaborateur"])
    return metrics.kpi_collab_rank(
        (requests, of_requests["collaborateur_d"], F.col("Task_Duration")),
        (deployments, of_deployments["collaborateur"], metrics.deployment_seconds()))


@query("kpi_sla", f"""
    SELECT Priorite AS priority, count(*) AS closed_tickets,
           count(*) FILTER ({_SECONDS_SQL} <= hours * 3600) AS within_limit,
           CASE WHEN count(hours) > 0 THEN round(count(*) FILTER ({_SECONDS_SQL} <= hours * 3600) / count(hours), 4) END AS compliance
    FROM v_incidents LEFT JOIN (SELECT * FROM v_sla WHERE priority <> '5-LOW') ON Priorite = priority
    WHERE {_CLOSED_SQL} GROUP BY Priorite""")
def kpi_sla(spark, sf):
    """One priority has no limit and shows without a share."""
    fact, found = star.incident_star(spark, sf, ["ID_Etat", "ID_Priorite"])
    return metrics.kpi_sla(fact, found, fx.sla_limits(spark).filter("priority <> '5-LOW'"), CLOSED)


add("kpi_long_running", lambda s, sf: metrics.kpi_long_running(star.incident_star(s, sf, [])[0], 20), f"""
    SELECT Numero, Ouvert, Mis_a_jour, {_SECONDS_SQL} AS seconds FROM v_incidents
    ORDER BY seconds DESC NULLS LAST, Numero LIMIT 20""")


# --- metrics in working time: the SQL adds up every day of a ticket ------------------------------------
_WORKED_SQL = """(SELECT *, coalesce((SELECT sum(greatest(0, date_diff('second',
        greatest(Ouvert, d.day + INTERVAL 510 MINUTE), least(Mis_a_jour, d.day + INTERVAL 1110 MINUTE))))
    FROM (SELECT unnest(generate_series(date_trunc('day', Ouvert)::TIMESTAMP, Mis_a_jour, INTERVAL 1 DAY)) AS day) AS d
    WHERE isodow(d.day) < 6 AND strftime(d.day, '%m-%d') NOT IN ('01-01', '05-01', '12-25')), 0)::BIGINT AS worked
    FROM v_incidents)"""


def _worked(spark, sf, ids):
    fact, found = star.incident_star(spark, sf, ids)
    calendar = fx.holiday_calendar(fx.table(spark, sf, "orders"), "o_orderdate")
    return fact, found, working_seconds(F.col("Ouvert"), F.col("Mis_a_jour"), calendar)


@query("kpi_sla_working_hours", f"""
    SELECT Priorite AS priority, count(*) AS closed_tickets, count(*) FILTER (worked <= hours * 3600) AS within_limit,
           CASE WHEN count(hours) > 0 THEN round(count(*) FILTER (worked <= hours * 3600) / count(hours), 4) END AS compliance
    FROM {_WORKED_SQL} LEFT JOIN (SELECT * FROM v_sla WHERE priority <> '5-LOW') ON Priorite = priority
    WHERE {_CLOSED_SQL} GROUP BY Priorite""")
def kpi_sla_working_hours(spark, sf):
    """The limits as hours of working time."""
    fact, found, seconds = _worked(spark, sf, ["ID_Etat", "ID_Priorite"])
    return metrics.kpi_sla(fact, found, fx.sla_limits(spark).filter("priority <> '5-LOW'"), CLOSED, seconds)


@query("kpi_mttr_month_working_hours", f"""
    SELECT year(Ouvert)::INTEGER AS annee, month(Ouvert)::INTEGER AS mois, count(*) AS closed_tickets,
           {_MEAN_SQL.format(s='worked')} AS mttr_hours FROM {_WORKED_SQL} WHERE {_CLOSED_SQL} GROUP BY 1, 2""")
def kpi_mttr_month_working_hours(spark, sf):
    fact, found, seconds = _worked(spark, sf, ["ID_Etat"])
    return metrics.kpi_mttr_month(fact, found, CLOSED, seconds)


@query("kpi_long_running_working_hours", f"""
    SELECT Numero, Ouvert, Mis_a_jour, worked AS seconds FROM {_WORKED_SQL} ORDER BY seconds DESC, Numero LIMIT 20""")
def kpi_long_running_working_hours(spark, sf):
    fact, _, seconds = _worked(spark, sf, [])
    return metrics.kpi_long_running(fact, 20, seconds)


# --- metrics kept up to date from changes -----------------------------------------------------------------
_REOPENED = "(SELECT * REPLACE ('En cours' AS Etat) FROM v_load1 WHERE substr(Numero, 4)::BIGINT % 10 = 0)"
_THREE_LOADS = upsert_sql("(" + upsert_sql(
    "v_load1", "v_load2", schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, schemas.INCIDENTS_CSV.names, ["Mis_a_jour"]) + ")",
    _REOPENED, schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, schemas.INCIDENTS_CSV.names, ["Mis_a_jour"])


def _kept_totals(spark, sf, by, sums, where=None) -> DataFrame:
    """Three extracts merged into silver one after the other; after each one its changes go into the totals."""
    root, totals = scratch_path(spark, "lake"), scratch_path(spark, "totals")
    first, second = fx.incident_loads(spark, sf)
    reopened = first.filter(fx.incident_key(first) % 10 == 0).withColumn("Etat", F.lit(fx.OPEN_STATES[0]))
    for i, load in enumerate((first, second, reopened)):
        feed = f"{root}/changes/{i}"
        jobs.load_incidents(load, root, buckets=table_buckets(spark), days=400, changes_to=feed)
        added = deltas(spark.read.parquet(feed), by, sums, where)
        known = tables.read_path(spark, totals) if i else None
        tables.overwrite_path(folded(known, added, list(by)), totals)
    return tables.read_path(spark, totals)


@query("kpi_state_counts_incremental", f"SELECT Etat, count(*) AS n FROM ({_THREE_LOADS}) GROUP BY Etat")
def kpi_state_counts_incremental(spark, sf):
    return _kept_totals(spark, sf, {"Etat": lambda row: row["Etat"]}, {})


@query("kpi_mttr_month_incremental", f"""
    SELECT year(Ouvert)::INTEGER AS annee, month(Ouvert)::INTEGER AS mois, count(*) AS closed_tickets,
           {_MEAN_SQL.format(s=_SECONDS_SQL)} AS mttr_hours FROM ({_THREE_LOADS}) WHERE {_CLOSED_SQL} GROUP BY 1, 2""")
def kpi_mttr_month_incremental(spark, sf):
    """Sums and counts are kept; a reopened ticket's duration is taken back."""
    totals = _kept_totals(
        spark, sf, {"annee": lambda row: F.year(row["Ouvert"]), "mois": lambda row: F.month(row["Ouvert"])},
        {"seconds": lambda row: elapsed_seconds(row["Ouvert"], row["Mis_a_jour"])}, lambda row: row["Etat"].isin(*CLOSED))
    return totals.select(
        "annee", "mois", F.col("n").alias("closed_tickets"), F.round(F.col("seconds") / F.col("n") / 3600, 2).alias("mttr_hours"))


@query("pipeline_incidents_changes", f"""SELECT {', '.join(_INCIDENT_RESULT)} FROM ({upsert_sql(
    'v_load1', 'v_load2', schemas.INCIDENT_KEYS, schemas.INCIDENT_UPDATES, schemas.INCIDENTS_CSV.names, ['Mis_a_jour'])})
    QUALIFY row_number() OVER (PARTITION BY Numero ORDER BY Mis_a_jour DESC) = 1""")
def pipeline_incidents_changes(spark, sf):
    """The gold fact loaded from the changes of each silver merge alone."""
    root = scratch_path(spark, "lake")
    for i, load in enumerate(fx.incident_loads(spark, sf)):
        feed = f"{root}/changes/{i}"
        jobs.load_incidents(load, root, buckets=table_buckets(spark), days=400, changes_to=feed)
        changed = changed_rows(spark.read.parquet(feed))
        jobs.load_incident_gold(spark, root, fx.group_types(spark), changed=changed, buckets=table_buckets(spark), days=400)
    fact = jobs.gold(spark, root, "factSupervision_gold")
    return without_zone(_labelled(fact, facts.INCIDENT_LOOKUPS, partial(jobs.gold, spark, root)).select(*_INCIDENT_RESULT))
