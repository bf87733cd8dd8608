"""Totals that are kept up to date from the changes of a merge, without reading unchanged rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Makes a column from the struct of a row.
OfRow = Callable[[Column], Column]


def deltas(changes: DataFrame, by: Mapping[str, OfRow], sums: Mapping[str, OfRow], where: OfRow | None = None) -> DataFrame:
    """What changes (`before`, `after`) add to totals by group: `n` rows and sums.

    The state before counts -1 and its values are taken back, the state after counts +1; a row outside
    `where` on one side counts on the other only. `by` and `sums` name columns made from a row; a NULL
    value adds nothing. One aggregation over the changes, combined before its shuffle.
    """
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")),
        F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")))
    signed = changes.select(F.inline(sides)).filter(F.col("row").isNotNull())
    if where is not None:
        signed = signed.filter(where(F.col("row")))
    return signed.groupBy(*[make(F.col("row")).alias(name) for name, make in by.items()]).agg(
        F.sum(F.col("sign").cast("long")).alias("n"),
        *[F.coalesce(F.sum(F.col("sign") * make(F.col("row"))), F.lit(0)).alias(name) for name, make in sums.items()])


def folded(totals: DataFrame | None, added: DataFrame, by: list[str]) -> DataFrame:
    """Totals with `deltas` added; groups without rows go. `totals` are those of earlier loads, if any."""
    both = added if totals is None else totals.select(*added.columns).unionByName(added)
    measures = [c for c in added.columns if c not in by]
    return both.groupBy(*by).agg(*[F.sum(m).alias(m) for m in measures]).filter("n <> 0")
