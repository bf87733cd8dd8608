"""Vector tables: which rows take part, and blocks of bounded size for comparing two of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the searched table and queries that meet in one task at a time.
BLOCK_ROWS, BLOCK_QUERIES = 32_768, 2_048


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def common_size(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has the most frequent length, the shorter of equally frequent ones."""
    sizes = rows.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    most = sizes.agg(F.max(F.struct("n", -F.col("size"))).alias("top")).select(-F.col("top.col2"))
    return rows.filter(F.size(vector) == most.scalar())


def stacked(column: pd.Series) -> np.ndarray:
    """Vectors of a pandas column as a matrix."""
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def best(partial: DataFrame, k: int) -> DataFrame:
    """The `k` rows of each query with the largest score, ties to the smaller id, with their rank.

    `partial` has at most `k` rows of a query from each block, and Spark thins them out before the
    shuffle because only the first ranks are kept.
    """
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_rows(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` largest scores, ties to the first place, best first."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > bar), np.flatnonzero(scores == bar)
        place = np.concatenate([above, equal[:k - len(above)]])
    else:
        place = np.arange(len(scores))
    return place[np.lexsort((place, -scores[place]))]
