"""Near duplicates by SetSketch: banded registers propose pairs, a joint likelihood thins them out,
full shingle sets decide.

A register is the exponentially spaced, truncated minimum of one hash over a document's shingles.
Registers of two sets merge by maximum, and equal registers tell of similar sets. Documents with the
same set form one class, and only classes are compared: every link is between different sets.

Joins with a side whose size Spark takes from a file, or from before an explode, are hinted to merge: such a
guess can be far too low, and the driver would have to hold a table that grows with the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.llm import words as W
from ticketlake.llm.common import staged
from ticketlake.llm.components import components

SHINGLE_WORDS, PERCENT = 5, 80
#: Registers, and how many of them make a band: a pair at 80 % misses all bands once in 3e5.
REGISTERS, BAND = 160, 5
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
#: How far a pair may be estimated below the threshold and still be compared, over 4 deviations.
MARGIN = 0.15
#: Buckets up to the first size are joined with themselves; larger ones are cut into blocks of the second.
BLOCK = 64, 256
SKETCH = "struct<n:long,digest:binary,registers:binary>"


@lru_cache(maxsize=1)
def factors() -> np.ndarray:
    """One odd multiplier for each register."""
    return np.random.default_rng(20).integers(1, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z are lower-cased, empty without words.

    A text with fewer words than `size` has its whole sequence as one shingle.
    """
    for chunk in W.text_chunks(texts):
        found = W.split_words(pc.ascii_lower(chunk))
        own = np.array([xxhash.xxh3_64_intdigest(w) for w in found.vocab.to_pylist()], dtype=np.uint64)
        h, n = own[found.codes], len(found.codes)
        rolling = np.zeros(max(0, n - size + 1), dtype=np.uint64)
        for i in range(size):
            rolling = rolling * np.uint64(0x100000001B3) + h[i:i + len(rolling)]
        rolling = W.mixed(rolling)
        for a, b in zip(found.offsets[:-1], found.offsets[1:]):
            if b - a >= size:
                yield np.unique(rolling[a:b - size + 1])
            elif b > a:
                yield np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes(), int(b - a))], dtype=np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    low = np.full(REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 4096):
        low = np.minimum(low, (short[at:at + 4096, None] * factors()[None, :]).min(axis=0))
    least = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def sketch(text: Column, size: int) -> Column:
    """Set size, digest of the set and registers of a text column."""
    @F.arrow_udf(SKETCH)
    def of(texts: pa.Array) -> pa.Array:
        n, digest, found = [], [], []
        for hashes in shingle_sets(texts, size):
            n.append(len(hashes))
            digest.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            found.append(registers(hashes).tobytes() if len(hashes) else b"")
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(found, pa.binary())],
            ["n", "digest", "registers"])

    return of(text)


def matrix(found: pa.Array) -> np.ndarray:
    """Registers of several rows, one row each."""
    return np.frombuffer(b"".join(found.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One bucket key for each band of registers."""
    bands = found.reshape(-1, REGISTERS // BAND, BAND).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, REGISTERS // BAND + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for i in range(BAND):
        key = W.mixed(key * np.uint64(0x100000001B3) + bands[:, :, i])
    return key.view(np.int64)


def bucket_keys(column: str) -> Column:
    """Array of the bucket keys of a register column."""
    @F.arrow_udf("array<long>")
    def of(found: pa.Array) -> pa.Array:
        key = band_keys(matrix(found))
        offsets = np.arange(len(key) + 1, dtype=np.int32) * key.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(key.reshape(-1)))

    return of(column)


def rises(share: np.ndarray, j: np.ndarray | float, more: np.ndarray, fewer: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Slope of the log likelihood of similarity `j` given how many registers are larger, smaller, equal.

    `share` is the first set's size among both sizes. A register is larger in the first set with
    probability p(u - v j), where p(x) = -log_b(1 - x (b - 1) / b).
    """
    c, u, v = (BASE - 1) / BASE, share, 1 - share

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * c) / np.log(BASE)

    def slope(x):
        return c / np.log(BASE) / (1 - np.clip(x, 1e-12, 1) * c)

    x, y = u - v * j, v - u * j
    equal = np.maximum(1 - p(x) - p(y), 1e-12)
    return -more * v * slope(x) / p(x) - fewer * u * slope(y) / p(y) + same * (v * slope(x) + u * slope(y)) / equal


def estimate(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of largest likelihood of row pairs of registers; the likelihood has one top."""
    share = n_a / (n_a + n_b)
    counts = (a > b).sum(axis=1), (a < b).sum(axis=1), (a == b).sum(axis=1)
    low, high = np.zeros(len(share)), np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    for _ in range(30):
        mid = (low + high) / 2
        up = rises(share, mid, *counts) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


def likely(share: np.ndarray, more: np.ndarray, fewer: np.ndarray, same: np.ndarray, least: float) -> np.ndarray:
    """Whether the estimate is at least `least`: where the likelihood, which has one top, still rises."""
    return rises(share, least, more, fewer, same) >= 0


def near(percent: int):
    """Column function: the estimate for two classes, -1 where sizes alone tell them apart."""
    @F.arrow_udf("double")
    def of(n_a: pa.Array, n_b: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        sizes = n_a.to_numpy(zero_copy_only=False), n_b.to_numpy(zero_copy_only=False)
        return pa.array(estimate(*sizes, matrix(a), matrix(b)))

    def column(left: str, right: str) -> Column:
        fits = F.least(f"{left}.n", f"{right}.n") * 100 >= F.greatest(f"{left}.n", f"{right}.n") * percent
        guess = of(f"{left}.n", f"{right}.n", f"{left}.registers", f"{right}.registers")
        return F.when(fits, guess).otherwise(-1.0)

    return column


def block_links(left: pd.DataFrame, right: pd.DataFrame | None, size: int, percent: int) -> pd.DataFrame:
    """Links between different components within a block, or between two, of one bucket.

    Pairs that sizes and estimate let pass are compared by their full sets. Pairs that share an earlier
    bucket are left to it, and those that a link found here joins already need no test, so a block
    returns fewer links than it has rows.
    """
    other = left if right is None else right
    band = left["band"].iloc[0]
    a, b = (np.frombuffer(b"".join(x["registers"]), np.uint16).reshape(-1, REGISTERS) for x in (left, other))
    n_a, n_b = left["n"].to_numpy(), other["n"].to_numpy()
    own, root = left["component"].to_numpy().copy(), other["component"].to_numpy().copy()
    sets_a = [frozenset(x.tolist()) for x in shingle_sets(pa.array(left["text"]), size)]
    sets_b = sets_a if right is None else [frozenset(x.tolist()) for x in shingle_sets(pa.array(other["text"]), size)]
    out = []
    for i in range(len(left)):
        at = np.arange(i + 1 if right is None else 0, len(other))
        at = at[(np.minimum(n_a[i], n_b[at]) * 100 >= np.maximum(n_a[i], n_b[at]) * percent) & (root[at] != own[i])]
        same = a[i] == b[at]
        here = same.reshape(len(at), REGISTERS // BAND, BAND).all(axis=2).argmax(axis=1) == band
        at, same = at[here], same[here].sum(axis=1)
        more = (a[i] > b[at]).sum(axis=1)
        passed = likely(n_a[i] / (n_a[i] + n_b[at]), more, REGISTERS - same - more, same, percent / 100 - MARGIN)
        for j in at[passed]:
            if root[j] == own[i]:
                continue
            common = len(sets_a[i] & sets_b[j])
            if 100 * common >= percent * (n_a[i] + n_b[j] - common):
                out.append((left["node"].iloc[i], other["node"].iloc[j]))
                old = root[j]
                own[own == old] = own[i]
                root[root == old] = own[i]
    pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})


def hub_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """For each class, its most similar one among the first members of its buckets, if near enough."""
    pairs = members.filter("node <> hub").select("node", "hub").distinct()
    guessed = (
        pairs.join(classes.alias("a").hint("merge"), F.col("a.node") == pairs["node"]).drop(F.col("a.node"))
        .join(classes.alias("b").hint("merge"), F.col("b.node") == F.col("hub")).drop(F.col("b.node"))
        .select("node", "hub", near(percent)("a", "b").alias("guess"))
        .filter(F.col("guess") >= percent / 100 - MARGIN)
    )
    best = guessed.groupBy("node").agg(F.max(F.struct("guess", "hub")).alias("best"))
    return best.select(F.col("best.hub").alias("a"), F.col("node").alias("b"))


def open_buckets(members: DataFrame, linked: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components, with component and bucket size."""
    rows = members.join(linked.hint("merge"), "node", "left").select(
        "key", "band", "node", F.coalesce("component", "node").alias("component"))
    several = rows.groupBy("key").agg(
        F.count("*").alias("size"), F.min("component").alias("least"), F.max("component").alias("most"))
    return rows.join(several.filter("least <> most").select("key", "size"), "key")


def small_bucket_pairs(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in small buckets that sizes and estimate let pass."""
    few = rows.filter(F.col("size") <= BLOCK[0])
    joined = (
        few.alias("x").join(few.alias("y").hint("merge"), "key")
        .filter((F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component")))
        .select(F.col("x.node").alias("node"), F.col("y.node").alias("hub")).distinct()
    )
    return (
        joined.join(classes.alias("a").hint("merge"), F.col("a.node") == joined["node"]).drop(F.col("a.node"))
        .join(classes.alias("b").hint("merge"), F.col("b.node") == F.col("hub")).drop(F.col("b.node"))
        .select(F.col("node").alias("a"), F.col("hub").alias("b"), near(percent)("a", "b").alias("guess"))
        .filter(F.col("guess") >= percent / 100 - MARGIN).select("a", "b")
    )


def large_bucket_links(rows: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between components in large buckets. Each pair of blocks meets in one group of bounded size."""
    blocks = F.ceil(F.col("size") / BLOCK[1]).cast("int")
    many = (
        rows.filter(F.col("size") > BLOCK[0]).join(classes.hint("merge"), "node").join(texts.hint("merge"), "node")
        .withColumn("own", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("lo", F.least("own", "with")).withColumn("hi", F.greatest("own", "with"))
        .select("key", "lo", "hi", "own", "band", "node", "component", "n", "registers", "text")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        lo, hi = group["lo"].iloc[0], group["hi"].iloc[0]
        left, right = group[group["own"] == lo], group[group["own"] == hi] if lo != hi else None
        if left.empty or right is not None and right.empty:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        return block_links(left, right, size, percent)

    return many.groupBy("key", "lo", "hi").applyInPandas(compare, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    @F.arrow_udf("boolean")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        both = pa.chunked_array([a.cast(pa.large_string()), b.cast(pa.large_string())]).combine_chunks().dictionary_encode()
        sets, at = list(shingle_sets(both.dictionary, size)), both.indices.to_numpy(zero_copy_only=False)
        out = []
        for i, j in zip(at[:len(a)], at[len(a):]):
            same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            out.append(100 * same >= percent * (len(sets[i]) + len(sets[j]) - same))
        return pa.array(out, pa.bool_())

    left, right = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")).hint("merge") for x in "ab")
    return pairs.join(left, "a").join(right, "b").filter(alike("text_a", "text_b")).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)`: one row for each row of `docs`.

    Two documents link if their sets of `size`-word shingles have a similarity of `percent` or more;
    `component_id` is the smallest id that links reach, and `kept` marks the document of that id. A
    text that is null or without words links with nothing. Rows link by their own texts: rows without an
    id link others, and so does each text of an id that comes with several. A component without any id
    has a null `component_id`, and its rows are kept. Repeated rows stay and agree. Very long texts are
    worked on whole; an empty table gives an empty result; other columns don't matter.

    1. Row-local sketches, written once. Equal sets become one class, reduced before the shuffle.
    2. Buckets of band keys. Each class is compared with the most similar first member of its
       buckets: one pair for each class, however large the bucket.
    3. Buckets that still hold several components: all pairs across components, thinned by sizes and
       the estimate. Small buckets are joined with themselves; large ones are compared in blocks that
       return links only. Pairs inside a component need no test, so nothing is capped.
    4. Components of all confirmed links.
    """
    placed = placed_rows(docs, id_col, text, size, percent)
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept"))


def text_key(text: Column) -> Column:
    """128 bits of a text. A text and its row's id tell rows apart without shipping the text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def placed_rows(docs: DataFrame, id_col: str, text: str, size: int, percent: int) -> DataFrame:
    """`(doc_id, key, n, component, component_id)` of each row; without words, the last two are null."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), text_key(F.col(text)).alias("key"))
    rows = staged(base.select("doc_id", "key", sketch(F.col("text"), size).alias("s")).select("doc_id", "key", "s.*"), "sketches")
    # the row whose text stands for the class: that of the smallest id, rows without one last
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))
    classes = staged(
        rows.filter("n > 0").groupBy("digest").agg(
            first_row.alias("first"), F.first("n").alias("n"), F.first("registers").alias("registers"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    short = classes.select("node", "n", "registers")
    keys = classes.select("node", F.posexplode(bucket_keys("registers")).alias("band", "key"))
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub <> last")
    members = staged(keys.join(hubs.select("key", "hub").hint("merge"), "key"), "members")
    wanted = members.select("node").distinct().join(classes.hint("merge"), "node").select("node", "first.doc_id", "first.key")
    texts = staged(class_texts(base, wanted), "texts")
    first = staged(confirmed(hub_pairs(members, short, percent), texts, size, percent), "links")
    rest = staged(open_buckets(members, components(first)), "open")
    small = confirmed(small_bucket_pairs(rest, short, percent), texts, size, percent)
    linked = components(first.union(small).union(large_bucket_links(rest, short, texts, size, percent)))
    known = (
        classes.select("digest", "node", F.col("first.doc_id").alias("first_id"))
        .join(linked.hint("merge"), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = known.join(least, "component").select("digest", "component", "component_id")
    return rows.join(found, "digest", "left").select("doc_id", "key", "n", "component", "component_id")


def same_row(left: DataFrame, right: DataFrame, id_left: str, id_right: str) -> Column:
    """Whether two rows have the same id, null or not, and the same text."""
    return left[id_left].eqNullSafe(right[id_right]) & (left["key.a"] == right["key.a"]) & (left["key.b"] == right["key.b"])


def class_texts(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """The text of the row that stands for each wanted class."""
    found = base.join(wanted.hint("merge"), same_row(base, wanted, "doc_id", "doc_id")).select(wanted["node"], base["text"])
    return found.dropDuplicates(["node"])


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """One row of `docs` for each component of near duplicates: that of the smallest id, rows without one last.

    Of several texts of that id within the component, the one of the least key is left; of rows with that
    id and text, the one whose other columns are least. A text that is null or without words is no
    duplicate of another, but of rows with the same id and text one is left.
    """
    placed = placed_rows(docs, id_col, text, size, percent)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    of_groups = placed.filter("n > 0").groupBy("component").agg(F.min(order).alias("least")).select("least.doc_id", "least.key")
    kept = of_groups.union(placed.filter("n = 0").select("doc_id", "key").distinct())
    kept = staged(kept.select(F.col("doc_id").alias("id"), F.col("key.a").alias("a"), F.col("key.b").alias("b")), "kept")
    whole = docs.select(
        F.col(id_col).alias("id"), text_key(F.col(text)).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    is_kept = whole["id"].eqNullSafe(kept["id"]) & (F.col("key.a") == kept["a"]) & (F.col("key.b") == kept["b"])
    sortable = [f.name for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    rest = F.struct(*[F.col("row").getField(c) for c in sortable if c != text])
    return whole.join(kept.hint("merge"), is_kept, "left_semi").groupBy("id", "key").agg(F.min_by("row", rest).alias("row")).select("row.*")
