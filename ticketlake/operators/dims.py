"""Dimension builders: dates, labels with stable surrogate keys, group types, ticket types."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.times import second_of_day
from ticketlake.operators.keys import assign_keys, global_row_number, max_id
from ticketlake.operators.upsert import upsert

__all__ = [
    "assign_keys", "date_dim_from_date", "date_dim_from_ts", "dim_group", "distinct_members",
    "extend_dim", "group_type", "max_id", "new_members", "union_members",
]

OTHER_GROUP = "Autre"  # fixed value: type of every group no lookup names


def date_dim_from_ts(df: DataFrame, column: str) -> DataFrame:
    """Distinct timestamps with their six parts."""
    moment = F.col(column)
    return df.select(column).distinct().select(
        column,
        F.dayofmonth(moment).alias("Jour"), F.month(moment).alias("Mois"), F.year(moment).alias("Annee"),
        F.hour(moment).alias("Heure"), F.minute(moment).alias("Minute"),
        F.second(moment).alias("Seconde"),
    )


def date_dim_from_date(df: DataFrame, date: str, time: str) -> DataFrame:
    """Distinct dates with the earliest well-formed time of day seen on each (NULL if there is none)."""
    earliest = df.groupBy(date).agg(F.min(second_of_day(F.col(time))).alias("__second"))
    second, day = F.col("__second"), F.col(date)
    return earliest.select(
        date,
        F.dayofmonth(day).alias("Jour"), F.month(day).alias("Mois"), F.year(day).alias("Annee"),
        F.floor(second / 3600).cast("int").alias("Heure"),
        F.floor(second % 3600 / 60).cast("int").alias("Minute"),
        (second % 60).cast("int").alias("Seconde"),
    )


def distinct_members(df: DataFrame, column: str, label: str | None = None) -> DataFrame:
    """Distinct labels of a column, NULL included, under the dimension's own column name."""
    return df.select(F.col(column).alias(label or column)).distinct()


def union_members(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct labels of several sources; each source is reduced before the union."""
    return reduce(DataFrame.unionByName, (distinct_members(f, column) for f in frames)).distinct()


def new_members(incoming: DataFrame, dim: DataFrame, key: str, null_safe: bool = True) -> DataFrame:
    """Labels the dimension does not have yet. Null-safe, so a NULL member is new only once."""
    known = dim.select(F.col(key).alias("__known"))
    label = F.col(key)
    same = label.eqNullSafe(F.col("__known")) if null_safe else label == F.col("__known")
    return incoming.join(known, same, "left_anti")


def extend_dim(
    members: DataFrame, existing: DataFrame | None, label: str, id_col: str
) -> DataFrame:
    """The dimension after one load: existing keys untouched, new labels appended in label order."""
    if existing is None:
        return global_row_number(members, F.col(label), name=id_col).select(id_col, label)
    fresh = assign_keys(new_members(members, existing, label), existing, label, id_col)
    return existing.unionByName(fresh.select(*existing.columns))


def group_type(groups: DataFrame, lookup: DataFrame, label: str = "Groupe_affectation") -> DataFrame:
    """Add `Type_Groupe` from a `(label, type)` lookup; unlisted and NULL groups are `Autre`.

    A label listed twice takes its first type in alphabetical order, so no group is doubled.
    """
    types = lookup.groupBy(F.col("label").alias("__label")).agg(F.min("type").alias("__type"))
    typed = groups.join(types, F.col(label) == F.col("__label"), "left")
    return typed.withColumn("Type_Groupe", F.coalesce("__type", F.lit(OTHER_GROUP))).drop("__label", "__type")


def dim_group(
    members: DataFrame, lookup: DataFrame, existing: DataFrame | None = None,
    label: str = "Groupe_affectation", id_col: str = "ID_Groupe_affectation",
) -> DataFrame:
    """Group dimension with its type: keys are stable, types follow the lookup of this load."""
    if existing is None:
        return group_type(extend_dim(members, None, label, id_col), lookup, label)
    keyed = extend_dim(members, existing.select(id_col, label), label, id_col)
    typed = group_type(keyed, lookup, label)
    return upsert(existing, typed, [label], ["Type_Groupe"], reduced=True)
