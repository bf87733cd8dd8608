"""Data-quality profiling. Every check is one DataFrame; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.operators.latest import first_per_key


def null_counts(df: DataFrame) -> DataFrame:
    """One row, one NULL count per column; 0 on an empty frame."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def null_or_empty_counts(df: DataFrame) -> DataFrame:
    """NULL or empty-string count per column; only text can be empty."""
    def missing(field: T.StructField):
        column = F.col(f"`{field.name}`")
        return column.isNull() | (column == "") if isinstance(field.dataType, T.StringType) else column.isNull()

    return df.agg(*[F.count_if(missing(f)).alias(f.name) for f in df.schema.fields])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Total, distinct and surplus rows in one job; NULLs compare equal.

    Copies collapse in the map-side aggregation, so a row copied very often reaches its reducer as
    one partial count per task.
    """
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"), F.count("*").alias("distinct_rows")
    ).withColumn("duplicates", F.col("total") - F.col("distinct_rows"))


def duplicate_report(df: DataFrame) -> DataFrame:
    """`duplicate_count` with a verdict."""
    verdict = F.when(F.col("duplicates") == 0, "none").otherwise(
        F.concat(F.col("duplicates").cast("string"), F.lit(" duplicates"))
    )
    return duplicate_count(df).withColumn("verdict", verdict)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count `nb`."""
    return value_counts(df, keys, having="nb > 1", name="nb")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the duplicate groups, with the group size `nb`; keys with a NULL drop out.

    Grouping also on a hash of the key leaves the groups partitioned differently from the join, so
    the join shuffles both of its sides itself and AQE can split a hot key over many tasks (or turn
    to a broadcast when few groups are left). A count window would hold a hot group in one task.
    """
    filled = df.filter(reduce(and_, (F.col(k).isNotNull() for k in keys)))
    groups = (
        filled.groupBy(*keys, F.xxhash64(*keys).alias("key_hash"))
        .agg(F.count("*").alias("nb"))
        .filter("nb > 1")
        .drop("key_hash")
    )
    return filled.join(groups, on=list(keys), how="inner")


def dedup(df: DataFrame) -> DataFrame:
    """Distinct rows."""
    return df.dropDuplicates()


def dedup_keys(df: DataFrame, keys: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """One row per key: the first one by `order`, then by all other columns."""
    return first_per_key(df, keys, order or [])


def cardinality(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values; NULL is a value."""
    return df.select(column).distinct().agg(F.count("*").alias("n_distinct"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_counts(
    df: DataFrame, columns: Sequence[str], having: str | None = None, name: str = "n"
) -> DataFrame:
    """Row count per value combination, optionally filtered afterwards."""
    counts = df.groupBy(*columns).agg(F.count("*").alias(name))
    return counts.filter(having) if having else counts


def required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Required columns that hold NULLs: `(column, n_null)`, no row when all is well."""
    stats = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])
    return stats.select(F.inline(pairs)).filter("n_null > 0")


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; the job that reads them fails on the first NULL in a required column."""
    def checked(name: str):
        column = F.col(name)
        failure = F.raise_error(F.lit(f"NULL in required column {name}")).cast(df.schema[name].dataType)
        return F.when(column.isNull(), failure).otherwise(column)

    return df.withColumns({c: checked(c) for c in columns}) if columns else df


def profile(df: DataFrame) -> DataFrame:
    """Row count plus NULL and empty-string counts of every column in one pass over the data."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}_null") for c in df.columns],
        *[F.count_if(F.col(f"`{c}`") == "").alias(f"{c}_empty") for c in text],
    )
