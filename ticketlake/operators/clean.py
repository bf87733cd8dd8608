"""Projections, predicates and the bronze-to-silver cleaning of the three ticket kinds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake import schemas
from ticketlake.functions.bands import shift_band, working_hours_band


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def tag_type(df: DataFrame, label: str) -> DataFrame:
    """Add the constant ticket type."""
    return df.withColumn("Type", F.lit(label))


def keep_closed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every closing column is filled."""
    return df.filter(reduce(and_, (F.col(c).isNotNull() for c in columns)))


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column equals a value; NULL is never equal."""
    return df.filter(F.col(column) == F.lit(value))


def ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Global ascending sort, NULLs first."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in columns])


def top_n(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """First `n` rows of that order; planned as a bounded take per partition, not as a full sort."""
    return ordered(df, columns).limit(n)


def classify_deployments(df: DataFrame, holidays: DataFrame | Iterable) -> DataFrame:
    """Add the working-hours band of the opening time and the type."""
    band = working_hours_band(F.col("Ouvert"), F.col("Ovrt_h"), holidays)
    return tag_type(df.withColumn("Plages_horaires", band), schemas.DEPLOYMENT_TYPE)


def classify_requests(df: DataFrame) -> DataFrame:
    """Add the shift of the creation time and the type."""
    return tag_type(df.withColumn("Plages_horaires", shift_band(F.col("Cree_h"))), schemas.REQUEST_TYPE)


def clean_assignees(bronze: DataFrame) -> DataFrame:
    return rename_columns(bronze, schemas.ASSIGNEE_RENAMES)


def clean_deployments(bronze: DataFrame, holidays: DataFrame | Iterable) -> DataFrame:
    """Bronze deployments to silver columns."""
    slim = drop_columns(rename_columns(bronze, schemas.DEPLOYMENT_RENAMES), schemas.DEPLOYMENT_DROPS)
    return classify_deployments(slim, holidays)


def clean_requests(bronze: DataFrame) -> DataFrame:
    """Bronze requests to silver columns; requests still open stay behind."""
    slim = drop_columns(rename_columns(bronze, schemas.REQUEST_RENAMES), schemas.REQUEST_DROPS)
    return classify_requests(keep_closed(slim, ["Ferme", "Ferme_h"]))
