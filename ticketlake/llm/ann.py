"""Approximate nearest neighbours: multi-index hashing over learned rotated binary codes.

Codes are signs of rotated principal components; the rotation is learned to lose least (ITQ). A code
is cut into substrings and each substring is indexed by its value. A code within Hamming radius r of a
query's differs by at most r // m in one of m substrings, so probing all values that near finds every
one of them. Those that are within r are ranked by the original vectors. The probes run at every size
and radius; how much they spare depends on the radius that the data need.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm import vectors as V

#: Vectors that codes are learned from, at most.
SAMPLE = 4_096
#: Rotations, each of as many bits as there are components or 64, and bits of a substring.
ROTATIONS, SUBSTRING = 4, 16
#: Share of the sample's own neighbours that the first radius is to hold.
HELD = 0.97
PARTIAL = "query_id long, vec_id long, score double"


@dataclass
class Codes:
    """`signs(x @ turn - shift)` are a vector's bits; vectors get one more component to equal norms."""

    turn: np.ndarray
    shift: np.ndarray
    most: float
    radius: int

    def bits(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Bits packed to 16-bit substrings, one row for each vector."""
        norm = np.sqrt((x * x).sum(axis=1))
        if query:
            wide = np.concatenate([x / np.maximum(norm, 1e-300)[:, None], np.zeros((len(x), 1))], axis=1)
        else:
            x = x / self.most
            wide = np.concatenate([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))[:, None]], axis=1)
        signs = wide @ self.turn > self.shift
        return np.packbits(signs, axis=1).view(">u2").astype(np.uint16)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def learn(sample: np.ndarray, most: float, k: int, seed: int = 3) -> Codes:
    """Codes from a sample of vectors, and the radius that holds most of its nearest neighbours."""
    x = sample / most
    wide = np.concatenate([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))[:, None]], axis=1)
    mean = wide.mean(axis=0)
    _, _, axes = np.linalg.svd(wide - mean, full_matrices=False)
    rng = np.random.default_rng(seed)
    bits = max(SUBSTRING, min(64, wide.shape[1]) // SUBSTRING * SUBSTRING)
    base = axes[:bits].T
    turns = []
    for _ in range(ROTATIONS):
        rotation, _ = np.linalg.qr(rng.standard_normal((base.shape[1], bits)) if base.shape[1] >= bits else
                                   rng.standard_normal((bits, bits)))
        rotation = rotation[:base.shape[1]]
        for _ in range(12 if base.shape[1] == bits else 0):
            projected = (wide - mean) @ base @ rotation
            u, _, w = np.linalg.svd(np.sign(projected).T @ ((wide - mean) @ base))
            rotation = (u @ w).T
        turns.append(base @ rotation)
    turn = np.concatenate(turns, axis=1)
    codes = Codes(turn, mean @ turn, most, 0)
    own, asked = codes.bits(sample, False), codes.bits(sample[:512], True)
    reach = []
    for i in range(min(512, len(sample))):
        scores = sample @ sample[i]
        scores[i] = -np.inf
        reach.extend(hamming(asked[i], own[V.top_rows(scores, min(k, len(sample) - 1))]).tolist())
    codes.radius = int(np.quantile(reach, HELD)) if reach else turn.shape[1]
    return codes


class Index:
    """Rows of a block by the value of each substring of its codes: sorted values, and where each one's rows are."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.rows = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.values, self.starts = zip(*(
            np.unique(codes[rows, j], return_index=True) for j, rows in enumerate(self.rows)))

    def candidates(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Whether each row is in a probed bucket; true for all rows within the Hamming radius.

        With radius = a * m + b, a code whose first b + 1 substrings differ by more than a, and the others by
        a or more, differs by more than the radius. Of the values that near, those that occur are probed.
        """
        near, more = divmod(radius, len(code))
        seen = np.zeros(len(self.codes), dtype=bool)
        for j, (rows, values, starts) in enumerate(zip(self.rows, self.values, self.starts)):
            hit = np.flatnonzero(np.bitwise_count(values ^ code[j]).astype(np.int64) <= (near if j <= more else near - 1))
            sizes = np.append(starts, len(rows))[hit + 1] - starts[hit]
            seen[rows[np.repeat(starts[hit] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]] = True
        return seen

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows within the Hamming radius, in order."""
        found = np.flatnonzero(self.candidates(code, radius))
        return found[hamming(self.codes[found], code) <= radius]


def search_block(queries: pd.DataFrame, data: pd.DataFrame, codes: Codes, k: int) -> pd.DataFrame:
    """For each query the best rows of a block among those within the radius, or the next that holds k."""
    empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    if queries.empty or data.empty:
        return empty
    data = data.sort_values("id", kind="stable")
    x, ids = V.stacked(data["vector"]).astype(np.float64), data["id"].to_numpy()
    q = V.stacked(queries["vector"]).astype(np.float64)
    index, asked, out = Index(codes.bits(x, False)), codes.bits(q, True), [empty]
    widest = codes.turn.shape[1]
    for i, own in enumerate(queries["id"].to_numpy()):
        radius = codes.radius
        while True:
            found = index.within(asked[i], radius)
            found = found[ids[found] != own]
            if len(found) >= k or radius >= widest:
                break
            radius = min(widest, radius + 2 * asked.shape[1])
        # sums along rows, so that equal vectors have equal scores
        scores = (x[found] * q[i]).sum(axis=1)
        place = V.top_rows(scores, k)
        out.append(pd.DataFrame({"query_id": own, "vec_id": ids[found[place]], "score": scores[place]}))
    return pd.concat(out, ignore_index=True)


def nearest(data: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`(query_id, rank, vec_id, score)`: the `k` rows found nearest by inner product in double precision.

    Null, empty or zero vectors, those with null or non-finite components, rows with a null id and
    vectors of another than the most frequent length take no part. A row with the query's own id is
    no candidate; repeated rows each count; ties go to the smaller id. Fewer than `k` rows are
    returned only where there are fewer. Empty tables give an empty result.

    Codes are learned from at most `SAMPLE` vectors; every row is indexed. Rows are dealt to blocks by
    a hash of the id, each block holds its own index, and each block of queries searches all of them:
    however many rows share a bucket, a task holds one block of each. The radius is widened in a block
    until it holds `k` rows, and nothing within it is left out.
    """
    def valid(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("vector")).filter(
            F.col("id").isNotNull() & V.usable(F.col("vector")) & F.exists("vector", lambda x: x != 0))

    rows = V.common_size(valid(data), "vector")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    n, most, width = rows.agg(F.count("*"), F.max(norm), F.max(F.size("vector"))).first()
    if not n:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    codes = learn(np.array([r["vector"] for r in sample]), float(np.sqrt(most)), k)
    asked = valid(queries).filter(F.size("vector") == width)
    blocks, parts = -(-n // V.BLOCK_ROWS), -(-asked.count() // V.BLOCK_QUERIES) or 1

    def dealt(x: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return x.select("id", "vector", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_own)).cast("int").alias(own),
                        F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    left, right = dealt(rows, "block", blocks, "part", parts), dealt(asked, "part", parts, "block", blocks)

    def solve(mine: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        return search_block(asking, mine, codes, k)

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(solve, PARTIAL)
    return V.best(found, k)
