"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import staged


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    larger = both.filter("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return larger.filter("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    smaller = down.join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smaller.union(least).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`(node, component)` of every node of an edge; the component is its smallest node.

    `edges` has long columns `a` and `b`; nulls and loops are left out. Each round is written to the
    shared folder, so the plan does not grow, and only a count and a hash come to the driver. A node
    with very many edges is reduced before the shuffle and its join is one that Spark can split. No side is
    broadcast, as each round would leave its copies in the driver's memory.
    """
    now = staged(edges.select("a", "b").dropna().filter("a <> b").distinct(), "edges")
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
        now = staged(small_star(large_star(now)), "edges")
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
