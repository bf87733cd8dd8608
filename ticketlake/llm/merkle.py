"""Merkle manifest of a dataset: a tree of digests for each group of rows, and one over the groups.

Nodes hold no pointers. Each carries the interval `lo` to `hi` of leaf ranks that it covers, so a node's
parent is the node one level up whose interval contains its own: an equi-join on the tree and the span
of that level (its bucket), then containment. The siblings of a node are the intervals within its
parent's but its own. Ancestors are attached from the roots down, so a level ships as many rows as it has
nodes, and every 16 leaves share one row until the last step.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm.common import staged

#: Consecutive nodes that share a parent.
FAN = 16


class Manifest(NamedTuple):
    """Nodes by level, from the parents of leaves up: `tree size lo hi digest children`."""

    #: Levels over the leaves of each group; children of the first level also hold the caller's `row`.
    groups: list[DataFrame]
    #: Levels over the groups' roots; a group's number is its leaf rank there.
    top: list[DataFrame]
    #: The digest of everything, None for an empty table.
    root: str | None


def digest(*columns: Column) -> Column:
    """Lower-case hex sha256 of the columns: `-` for null, else the count of UTF-8 bytes, `:`, the value."""
    def field(column: Column) -> Column:
        text = column.cast("string")
        return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(field, columns)), 256)


def combined(digests: Column) -> Column:
    """Digest of a parent from the array of its children's."""
    return F.sha2(F.array_join(digests, ""), 256)


def ranked(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """`rows` with `rank` from 0 within their group by `order`, and `size`, the rows of the group.

    Rows are cut into ranges by group and order and sorted inside, so a group may fill many ranges. A
    row's number within its range is set off by the group's rows in the ranges before; groups with
    ranges are all that meets, at most one row for each pair. `order` must be unique; nulls come first.
    """
    keys = [F.col(c).asc_nulls_first() for c in ([group] if group else []) + order]
    placed = staged(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id()),
        "ranked")
    own = F.col(group) if group else F.lit(0)
    part = F.shiftright("_place", 33)
    runs = placed.groupBy(own.alias("_own"), part.alias("_part")).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy("_own")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({
        "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "size": F.sum("_n").over(whole)}).drop("_n")
    joined = placed.join(runs, own.eqNullSafe(F.col("_own")) & (part == F.col("_part")))
    rank = F.col("_place") - F.col("_first") + F.col("_before")
    return joined.select(*rows.columns, rank.alias("rank"), "size")


def parents(nodes: DataFrame, level: int, *extra: str) -> DataFrame:
    """The nodes of a level from those below it, for the trees that are not done yet.

    A parent is the digest of its children, in order. The lone leaf of a tree of one is its own parent.
    """
    span = FAN ** level
    left = nodes if level == 1 else nodes.filter(F.col("size") > span // FAN)
    runs = left.groupBy("tree", "size", F.expr(f"lo div {span}").alias("bucket")).agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "digest", *extra))).alias("children"))
    own = F.when(F.col("size") == 1, F.col("children")[0]["digest"]).otherwise(combined(F.col("children.digest")))
    return runs.select(
        "tree", "size", F.array_min("children.lo").alias("lo"), F.array_max("children.hi").alias("hi"),
        own.alias("digest"), "children")


def levels(leaves: DataFrame, *extra: str) -> list[DataFrame]:
    """All levels over leaves `tree size lo hi digest`, each one written before the next is made."""
    largest = leaves.agg(F.max("size")).first()[0] or 1
    made = [staged(parents(leaves, 1, *extra), "merkle")]
    while FAN ** len(made) < largest:
        made.append(staged(parents(made[-1], len(made) + 1), "merkle"))
    return made


def whole() -> Column:
    """True for the root of a tree."""
    return F.col("hi") - F.col("lo") + 1 == F.col("size")


def roots(made: list[DataFrame]) -> DataFrame:
    """`tree digest`, one row for each tree."""
    found = [level.filter(whole()).select("tree", "digest") for level in made]
    for other in found[1:]:
        found[0] = found[0].union(other)
    return found[0]


def manifest(leaves: DataFrame) -> Manifest:
    """Builds the trees over rows `group`, `order`, `digest` and `row`.

    Leaves ascend by `order` within their `group`, null orders first and ties by digest; a null group
    is a group of its own and the first. `row` is a struct of orderable columns that comes back with
    the proofs. Repeated rows are leaves of their own. An empty table has no nodes and no root.
    """
    rows = staged(leaves.select("group", "order", "digest", "row").withColumn("_row", F.monotonically_increasing_id()),
                  "leaves")
    placed = staged(ranked(rows, "group", ["order", "digest", "_row"]), "leaves")
    groups = ranked(placed.filter("rank = 0").select("group"), None, ["group"]).select(
        F.col("group").alias("_group"), F.col("rank").alias("tree"))
    numbered = placed.join(groups, F.col("group").eqNullSafe(F.col("_group"))).select(
        "tree", "size", F.col("rank").alias("lo"), F.col("rank").alias("hi"), "digest", "row")
    made = levels(numbered, "row")
    subroots = staged(roots(made), "roots")
    count = subroots.count()
    top = levels(subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("size"), F.col("tree").alias("lo"),
        F.col("tree").alias("hi"), "digest"))
    last = roots(top).first()
    return Manifest(made, top, last and last["digest"])


def with_ancestors(made: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first level with `path`, its ancestors from the parent up, and the other columns of `above`.

    An ancestor is its `children` and the interval `lo` to `hi` of the one on the path. `above` has for
    each `tree` the `path` on top of its root.
    """
    upper, kept = None, [c for c in above.columns if c != "tree"]
    for level in range(len(made), 0, -1):
        nodes = made[level - 1]
        found = nodes.filter(whole()).join(above, "tree").select(*nodes.columns, *kept)
        if upper is not None:
            up = upper.select(*[F.col(c).alias(f"up_{c}") for c in upper.columns])
            span = FAN ** (level + 1)
            inside = (
                (F.col("tree") == F.col("up_tree")) & (F.expr(f"lo div {span}") == F.expr(f"up_lo div {span}"))
                & (F.col("lo") >= F.col("up_lo")) & (F.col("hi") <= F.col("up_hi")))
            step = F.array(F.struct(F.col("up_children").alias("children"), "lo", "hi"))
            others = [F.col(f"up_{c}").alias(c) for c in kept if c != "path"]
            below = nodes.filter(~whole()).join(up, inside).select(
                *nodes.columns, F.concat(step, "up_path").alias("path"), *others)
            found = found.unionByName(below)
        upper = found
    return upper


def proofs(trees: Manifest, leaf: Column | None = None) -> DataFrame:
    """One row for each leaf: `row`, `leaf`, `subroot`, `root`, `proof_sha256` and `folded_root`.

    `proof_sha256` is the digest of all siblings from the leaf's to the last level's, left to right.
    `folded_root` is the root that follows from them and the digest `leaf`, an expression of `row`
    (the stored digest where it is null or not given).
    """
    no_path = F.array().cast("array<struct<children:array<struct<lo:bigint,hi:bigint,digest:string>>,lo:bigint,hi:bigint>>")
    nothing = trees.top[-1].select("tree").distinct().withColumn("path", no_path)
    child = F.col("child")
    step = F.array(F.struct("children", child["lo"].alias("lo"), child["hi"].alias("hi")))
    tops = with_ancestors(trees.top, nothing).withColumn("child", F.explode("children")).select(
        child["lo"].alias("tree"), child["digest"].alias("subroot"),
        F.when(F.col("size") > 1, F.concat(step, "path")).otherwise(F.col("path")).alias("path"))

    def siblings(children: Column, lo: Column, hi: Column) -> Column:
        others = F.filter(children, lambda c: (c["hi"] < lo) | (c["lo"] > hi))
        return F.transform(others, lambda c: c["digest"])

    def replaced(children: Column, lo: Column, new: Column) -> Column:
        return combined(F.transform(children, lambda c: F.when(c["lo"] == lo, new).otherwise(c["digest"])))

    upper = F.array_join(F.flatten(F.transform("path", lambda p: siblings(p["children"], p["lo"], p["hi"]))), "")
    blocks = with_ancestors(trees.groups, tops).select("size", "children", "path", "subroot", upper.alias("upper"))
    own = blocks.withColumn("child", F.explode("children")).withColumn("row", F.col("child.row"))
    start = child["digest"] if leaf is None else F.coalesce(leaf, child["digest"])
    first = F.when(F.col("size") == 1, start).otherwise(replaced(F.col("children"), child["lo"], start))
    folded = F.aggregate("path", first, lambda below, p: replaced(p["children"], p["lo"], below))
    beside = F.array_join(siblings(F.col("children"), child["lo"], child["hi"]), "")
    return own.select(
        "row", child["digest"].alias("leaf"), "subroot", F.lit(trees.root).alias("root"),
        F.sha2(F.concat(beside, "upper"), 256).alias("proof_sha256"), folded.alias("folded_root"))
