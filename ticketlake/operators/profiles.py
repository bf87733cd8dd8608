"""Profiles that merge: a state for each load, so that the profile of all loads reads only the new one.

The exact parts (rows, NULLs, empty texts, least and greatest value, value counts) equal those of one
profile over all rows; the number of distinct values is estimated from sketches that merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: 2^14 registers a sketch, 16 KB at most: a standard error of 0.8 %.
SKETCH_BITS = 14


def _text(field: T.StructField) -> Column:
    return F.col(f"`{field.name}`").cast("string")


def column_state(df: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One row: `rows`, and a struct for each column with its counts, least and greatest value, and sketch.

    One pass, combined before its shuffle: each task sends one row. NULLs are outside of least, greatest
    and the sketch; only texts can be empty. Columns are of types that can be ordered and cast to text.
    """
    def state(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        empty = F.count_if(column == "") if isinstance(field.dataType, T.StringType) else F.lit(0).cast("long")
        return F.struct(
            F.count_if(column.isNull()).alias("nulls"), empty.alias("empty"), F.min(column).alias("least"),
            F.max(column).alias("greatest"), F.hll_sketch_agg(_text(field), F.lit(bits)).alias("sketch")).alias(field.name)

    return df.agg(F.count(F.lit(1)).alias("_rows"), *[state(f) for f in df.schema.fields])


def merged_state(states: DataFrame) -> DataFrame:
    """The state of all rows from those of its parts; of no part, there are no rows."""
    def merged(name: str) -> Column:
        part = F.col(f"`{name}`")
        return F.struct(
            F.coalesce(F.sum(part["nulls"]), F.lit(0)).alias("nulls"),
            F.coalesce(F.sum(part["empty"]), F.lit(0)).alias("empty"), F.min(part["least"]).alias("least"),
            F.max(part["greatest"]).alias("greatest"), F.hll_union_agg(part["sketch"]).alias("sketch")).alias(name)

    names = [c for c in states.columns if c != "_rows"]
    return states.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"), *[merged(c) for c in names])


def profile_of(state: DataFrame) -> DataFrame:
    """`(column, rows, n_null, n_empty, least, greatest, distinct_estimate)`, a row for each column."""
    def shown(name: str) -> Column:
        part = F.col(f"`{name}`")
        return F.struct(
            F.lit(name).alias("column"), F.col("_rows").alias("rows"), part["nulls"].alias("n_null"),
            part["empty"].alias("n_empty"), part["least"].cast("string").alias("least"),
            part["greatest"].cast("string").alias("greatest"),
            F.coalesce(F.hll_sketch_estimate(part["sketch"]), F.lit(0)).alias("distinct_estimate"))

    return state.select(F.inline(F.array(*[shown(c) for c in state.columns if c != "_rows"])))


def value_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, value, n)`: exact counts of the values, as text, of columns that hold few; NULL is a value.

    Each column's rows are counted by task before the shuffle, so a value of a third of all rows is one
    row a task. The size of the state grows with the distinct values.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def merged_values(states: DataFrame) -> DataFrame:
    """The value counts of all rows from those of its parts."""
    return states.groupBy("column", "value").agg(F.sum("n").alias("n"))


def keep_load(df: DataFrame, path: str, load: str, columns: Sequence[str]) -> None:
    """Write the states of one load under `path`; a load that is repeated replaces its own states only.

    `columns` are those whose values are counted exactly. The loads so far are not read.
    """
    for state, kind in ((column_state(df), "columns"), (value_state(df, columns), "values")):
        (
            state.withColumn("_load", F.lit(load)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("_load").parquet(f"{path}/{kind}")
        )


def kept_profile(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Profile and value counts of all loads, from their states alone."""
    states, values = (spark.read.parquet(f"{path}/{kind}").drop("_load") for kind in ("columns", "values"))
    return profile_of(merged_state(states)), merged_values(values)
