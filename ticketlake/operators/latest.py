"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by `order`, ties broken by all other columns ascending.

    Rank 1 of a window is pruned to one row per key and task before the shuffle, so a key that
    holds a large share of the rows sends almost nothing to its reducer. NULL keys form a group.
    """
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in keys]
    if not order and not rest:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def as_column(order: Column | str) -> Column:
    return F.col(order) if isinstance(order, str) else order


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[Column | str]) -> DataFrame:
    """The row of each key with the greatest `latest_by` columns or expressions, NULLs last."""
    return first_per_key(df, keys, [as_column(c).desc_nulls_last() for c in latest_by])
