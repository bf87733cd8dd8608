"""Ticket-shaped views over the test tables, for the registered queries and the tests.

`orders` (with customer and nation) plays the incidents, `events` the deployments and requests. The
source tables hold no NULLs and no malformed times, so the views derive them from the keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake import schemas
from ticketlake.functions.bands import shift_band
from ticketlake.operators import clean

# parameter tables of the test data
HOLIDAYS = (dt.date(2024, 1, 1),)
GROUP_TYPES = [("BUILDING", "Exploitation"), ("MACHINERY", "Exploitation"), ("HOUSEHOLD", "Supervision")]
GROUP_TYPES_REVISED = [("BUILDING", "Exploitation"), ("MACHINERY", "Supervision"), ("FURNITURE", "Exploitation")]
HOLIDAY_RULE = ("01-01", "05-01", "12-25")  # of every year that a ticket was opened in, and the next
SLA_HOURS = [("1-URGENT", 24), ("2-HIGH", 72), ("3-MEDIUM", 168), ("4-NOT SPECIFIED", 336), ("5-LOW", 720)]
CLOSED_STATES = ["Clos", "Résolu"]
OPEN_STATES = ["En cours"]


# declared, so that no read has to infer its schema first
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def group_types(spark: SparkSession, rows=GROUP_TYPES) -> DataFrame:
    return spark.createDataFrame(rows, "label string, type string")


def sla_limits(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SLA_HOURS, "priority string, hours int")


def holiday_calendar(tickets: DataFrame, opened: str = "Ouvert") -> DataFrame:
    """The holidays of all years in which tickets were open."""
    years = tickets.select(F.explode(F.array(F.year(opened), F.year(opened) + 1)).alias("year")).distinct()
    days = F.explode(F.array(*[F.lit(d) for d in HOLIDAY_RULE])).alias("rest")
    return years.filter("year IS NOT NULL").select("year", days).select(
        F.to_date(F.concat_ws("-", "year", "rest")).alias("day"))


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def null_if(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    key = F.col("o_orderkey")
    state = (
        F.when(F.col("o_orderstatus") == "O", "En cours")
        .when(F.col("o_orderstatus") == "P", "Résolu")
        .when(F.col("o_orderstatus") == "F", "Clos")
    )
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.concat(F.lit("INC"), F.lpad(key.cast("string"), 8, "0")).alias("Numero"),
            F.col("o_orderdate").alias("Ouvert"),
            F.timestamp_add("HOUR", (key % 720).cast("int"), F.col("o_orderdate")).alias("Mis_a_jour"),
            F.col("n_name").alias("Societe"),
            F.col("o_orderpriority").alias("Priorite"),
            null_if(key % 97 == 0, F.col("c_mktsegment")).alias("Groupe_affectation"),
            state.alias("Etat"),
            F.col("c_name").alias("Ouvert_par"),
            null_if(key % 89 == 0, F.concat(F.lit("CAT"), (key % 7).cast("string"))).alias("Categorie"),
            null_if(key % 3 != 0, F.concat(F.lit("EXT"), key.cast("string"))).alias("N_du_ticket_externe"),
        )
    )


def incident_key(df: DataFrame) -> Column:
    return F.substring(df["Numero"], 4, 18).cast("bigint")


def incident_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """First extract, and a second one that overlaps it, closes tickets and reassigns some."""
    full = incidents(spark, sf_dir)
    key = incident_key(full)

    def label(text: str) -> Column:
        """The same text on every row (no key is negative), but a value of the data, not a literal."""
        return F.when(key >= 0, text)

    later = full.filter(key % 10 >= 5).withColumn("Etat", label("Clos"))
    reassigned = later.filter(key % 50 == 5).withColumns(
        {
            "Groupe_affectation": label("FURNITURE"),
            "Mis_a_jour": F.timestamp_add("HOUR", F.lit(1), F.col("Mis_a_jour")),
        }
    )
    return full.filter(key % 10 < 7), later.unionByName(reassigned)


def _event_end(value: Column, ts: Column) -> Column:
    return F.timestamp_add("SECOND", F.floor(value * 3600).cast("int"), ts)


def deployments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deployments as cleaned columns, before classification."""
    events = table(spark, sf_dir, "events").filter(
        F.col("event_type").isin("error", "purchase", "signup")
    )
    key, ts = F.col("event_id"), F.col("ts")
    end = _event_end(F.col("value"), ts)
    opened_at = (
        F.when(key % 101 == 0, F.lit(None).cast("string"))
        .when(key % 103 == 0, "08:30")
        .when(key % 107 == 0, "ab:cd:ef")
        .otherwise(clock(ts))
    )
    return events.select(
        F.concat(F.lit("CHG"), key.cast("string")).alias("Numero"),
        ts.cast("date").alias("Ouvert"),
        end.cast("date").alias("Mis_a_jour"),
        F.col("event_type").alias("Description_breve"),
        F.when(key % 5 != 0, "Clos").otherwise("En cours").alias("Etat"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("Ouvert_par"),
        opened_at.alias("Ovrt_h"),
        clock(end).alias("Mis_h"),
    )


def _type_as_data(df: DataFrame) -> DataFrame:
    """Every ticket has a number, so this changes no value; but as in a stored silver table the type
    is then a column to join on, not a literal the optimizer folds the join away for."""
    return df.withColumn("Type", F.when(F.col("Numero").isNotNull(), F.col("Type")))


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _type_as_data(clean.classify_deployments(deployments_raw(spark, sf_dir), HOLIDAYS))


def requests_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as cleaned columns, open ones included."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "view"))
    key, ts = F.col("event_id"), F.col("ts")
    end = _event_end(F.col("value"), ts)
    return events.select(
        ts.cast("date").alias("Cree"),
        null_if(key % 11 == 0, end.cast("date")).alias("Ferme"),
        F.concat(F.lit("RITM"), key.cast("string")).alias("Numero"),
        F.col("event_type").alias("Description_breve"),
        F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string")).alias("Affecte_a"),
        F.floor(F.col("value") * 3600).cast("bigint").alias("Task_Duration"),
        clock(ts).alias("Cree_h"),
        null_if((key % 11 == 0) | (key % 13 == 0), clock(end)).alias("Ferme_h"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = clean.keep_closed(requests_raw(spark, sf_dir), ["Ferme", "Ferme_h"])
    return _type_as_data(clean.classify_requests(closed))


def shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        F.date_trunc("hour", ts).cast("timestamp_ntz").alias("Ouvert"),
        shift_band(clock(ts)).alias("Plage_horaire"),
    )


def assignee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("INC"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0")).alias("Numero"),
        F.concat(F.lit("U"), (F.col("o_custkey") % 25).cast("string")).alias("Affecte"),
    )


def events_split(df: DataFrame, number: Column) -> tuple[DataFrame, DataFrame]:
    """The two overlapping loads of an event view, by the number in the ticket key."""
    return df.filter(number % 10 < 7), df.filter(number % 10 >= 5)


def deployments_csv(df: DataFrame) -> DataFrame:
    """Deployments in the bronze column order, with the columns cleaning will drop."""
    return df.select(
        "Numero", "Ouvert", "Mis_a_jour", F.lit("SOC").alias("Societe"), F.lit("P1").alias("Priorite"),
        "Description_breve", F.lit("GRP").alias("Groupe"), "Etat", "Ouvert_par",
        F.lit("CAT").alias("Categorie"), F.lit("EXT").alias("Externe"), "Ovrt_h", "Mis_h",
    ).toDF(*schemas.DEPLOYMENTS_CSV.names)


def requests_csv(df: DataFrame) -> DataFrame:
    """Requests in the bronze column order, with the column cleaning will drop."""
    return df.select(
        "Cree", "Ferme", "Numero", "Description_breve", F.lit("GRP").alias("Groupe"), "Affecte_a",
        "Task_Duration", "Cree_h", "Ferme_h",
    ).toDF(*schemas.REQUESTS_CSV.names)
