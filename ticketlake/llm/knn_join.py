"""Exact top-k by inner product as a Voronoi join: pivots group queries and data, summaries of the
groups bound distances, and a query is sent only to cells that can hold one of its results.

An inner product becomes a distance by one more component: with M the largest norm, x' = (x,
sqrt(M^2 - |x|^2)) and q' = (q, 0) give |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the largest products
are the nearest neighbours and the triangle inequality holds. Bounds carry a small slack for rounding;
scores themselves are exact integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm import vectors as V
from ticketlake.llm.common import staged

#: Rows for each pivot, about, and least and most pivots; pivots and k distances each come to the driver.
ROWS_PER_PIVOT, PIVOTS = 4_096, (8, 512)
#: Float products of integers are exact up to here.
EXACT = float(1 << 53)
PARTIAL = "query_id long, vec_id long, score long"


def extended(x: np.ndarray, most: float) -> np.ndarray:
    """Data vectors with the component that brings all to the same norm."""
    rest = np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, square))


def rows_of(lists: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a matrix of doubles."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def nearest_pivot(vector: str, pivots: np.ndarray, most: float) -> Column:
    """Cell of each data vector and its distance to the cell's pivot."""
    @F.arrow_udf("struct<cell:int,away:double>")
    def of(lists: pa.Array) -> pa.Array:
        d = distances(extended(rows_of(lists), most), pivots)
        cell = d.argmin(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])], ["cell", "away"])

    return of(F.col(vector))


def query_cells(vector: str, pivots: np.ndarray, far: np.ndarray, reach: np.ndarray, slack: float) -> Column:
    """Cells that can hold a result of each query.

    `far[j]` is the largest distance of cell j's rows to its pivot. `reach` lists distances d of rows
    to pivots j, k + 1 for each cell: some row lies within |q, p_j| + d, so the (k + 1)-th smallest of
    these bounds the query's k-th result, its own row aside.
    """
    @F.arrow_udf("array<int>")
    def of(lists: pa.Array) -> pa.Array:
        x = rows_of(lists)
        d = distances(np.concatenate([x, np.zeros((len(x), 1))], axis=1), pivots)
        k = reach.shape[1]
        bound = np.sort((d[:, :, None] + reach[None, :, :]).reshape(len(x), -1), axis=1)[:, k - 1]
        need = (d - far[None, :] <= bound[:, None] + slack) & np.isfinite(far)[None, :]
        offsets = np.concatenate([[0], np.cumsum(need.sum(axis=1))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.nonzero(need)[1], pa.int32()))

    return of(F.col(vector))


def local_top(queries: pd.DataFrame, data: pd.DataFrame, k: int, exact: bool) -> pd.DataFrame:
    """Best rows of one block for each of its queries; both have `id` and `vector`."""
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    if queries.empty or data.empty:
        return empty
    data = data.sort_values("id", kind="stable")
    kind = np.float64 if exact else np.int64
    x, ids = V.stacked(data["vector"]).astype(kind), data["id"].to_numpy()
    out = [empty]
    for at in range(0, len(queries), 128):
        part = queries.iloc[at:at + 128]
        scores = (V.stacked(part["vector"]).astype(kind) @ x.T).astype(np.int64)
        for own, line in zip(part["id"].to_numpy(), scores):
            others = np.flatnonzero(ids != own)
            place = others[V.top_rows(line[others], k)]
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[place], "score": line[place]}))
    return pd.concat(out, ignore_index=True)


def top_products(
    data: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "vector",
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: the `k` rows of `data` with the largest inner product.

    Vectors are arrays of integers whose squared norms fit a long. Null or empty vectors, those with
    null components, rows with a null id and vectors of another than the most frequent length take
    no part. A row with the query's own id is no candidate; repeated rows each count. Ties go to the
    smaller id. All are returned where fewer than `k` are left; empty tables give an empty result.

    A cell with very many rows is dealt to blocks by a hash of the id, and the queries of a cell too,
    so that no task holds more than one block of each.
    """
    spark = data.sparkSession

    def valid(rows: DataFrame) -> DataFrame:
        whole = F.forall(vector, lambda x: x.isNotNull()) & (F.size(vector) > 0)
        return rows.select(F.col(id_col).alias("id"), F.col(vector).cast("array<long>").alias("vector")).filter(
            F.col("id").isNotNull() & F.coalesce(whole, F.lit(False)))

    rows = V.common_size(valid(data), "vector")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, most, width = rows.agg(F.count("*"), F.max(norm), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    count = min(PIVOTS[1], max(PIVOTS[0], n // ROWS_PER_PIVOT))
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(count).collect()
    pivots = extended(np.array([r["vector"] for r in chosen], dtype=np.float64), most)
    pivots = np.unique(pivots, axis=0)
    celled = staged(rows.withColumn("at", nearest_pivot("vector", pivots, most)).select(
        "id", "vector", "at.cell", "at.away"), "cells")
    size, far = np.zeros(len(pivots), dtype=np.int64), np.full(len(pivots), -np.inf)
    for r in celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("far")).collect():
        size[r["cell"]], far[r["cell"]] = r["n"], r["far"]
    reach = np.full((len(pivots), k + 1), np.inf)
    nearest = celled.select("cell", "away", F.row_number().over(Window.partitionBy("cell").orderBy("away")).alias("i"))
    for r in nearest.filter(F.col("i") <= k + 1).collect():
        reach[r["cell"], r["i"] - 1] = r["away"]
    slack = 1e-6 * (1 + float(np.sqrt(most)))
    asked = staged(
        valid(queries).filter(F.size("vector") == width)
        .withColumn("cell", F.explode(query_cells("vector", pivots, far, reach, slack))), "asked")
    sent = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    deal = [F.lit(x) for cell in range(len(pivots)) for x in (
        cell, F.struct(F.lit(int(-(-size[cell] // V.BLOCK_ROWS)) or 1).alias("rows"),
                       F.lit(-(-sent.get(cell, 0) // V.BLOCK_QUERIES) or 1).alias("queries")))]
    deal = F.create_map(*deal)[F.col("cell")]
    left = (
        celled.select("id", "vector", "cell", F.pmod(F.xxhash64("id", F.lit(1)), deal["rows"]).cast("int").alias("block"),
                      F.explode(F.sequence(F.lit(0), deal["queries"] - 1)).alias("part"))
    )
    right = (
        asked.select("id", "vector", "cell", F.pmod(F.xxhash64("id", F.lit(2)), deal["queries"]).cast("int").alias("part"),
                     F.explode(F.sequence(F.lit(0), deal["rows"] - 1)).alias("block"))
    )
    exact = most < EXACT

    def solve(mine: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        return local_top(asking, mine, k, exact)

    keys = ["cell", "block", "part"]
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, PARTIAL)
    return V.best(partial, k)
