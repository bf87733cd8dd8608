"""Global row numbers and surrogate keys without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Sampled orders for each range: the largest of very many ranges then stays under twice the mean.
SAMPLES_PER_RANGE = 64


def global_row_number(
    df: DataFrame, order: Column, name: str = "row_number", buckets: int | None = None
) -> DataFrame:
    """Number all rows 1..n by `order`, which must be unique; a NULL order comes first.

    A sample (the orders with the smallest digests, so always the same for the same rows) cuts the
    order into `buckets` ranges, as many as the session has shuffle partitions unless given. Rows are
    numbered inside their range, which is one window partition, and shifted by the sizes of the
    ranges before it. Only the sample, `SAMPLES_PER_RANGE` rows for each range, and the range sizes
    ever meet in one place; both come back as scalar subqueries, without a join.
    """
    buckets = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = df.withColumn("__order", order)
    # The three uses of `keyed` stay free of filters of their own, so that they share one shuffle:
    # collect_list drops a sampled NULL, and the range is never NULL.
    sample = keyed.select("__order").orderBy(
        F.md5(F.to_json(F.struct("__order"))).asc_nulls_first(), "__order"
    ).limit(buckets * SAMPLES_PER_RANGE)
    cuts = sample.agg(F.sort_array(F.collect_list("__order")).alias("s")).select(_every(F.col("s"), buckets)).scalar()
    ranged = (
        keyed.withColumn("__cuts", cuts)
        .withColumn("__range", _cuts_up_to(F.col("__order"), F.col("__cuts"), buckets))
        .drop("__cuts")
    )
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("size"))
    start = F.get(_rows_before(sizes, buckets).scalar(), F.col("__range"))
    inside = Window.partitionBy("__range").orderBy(F.col("__order").asc_nulls_first())
    return ranged.withColumn(name, start + F.row_number().over(inside)).drop("__range", "__order")


def _every(sample: Column, ranges: int) -> Column:
    """The `ranges - 1` values that cut an ascending array into equal parts; all of a short one."""
    places = F.sequence(F.lit(1), F.lit(ranges - 1))
    even = F.transform(places, lambda i: F.get(sample, F.floor(i * F.size(sample) / ranges).cast("int")))
    return F.when(F.size(sample) < ranges, sample).otherwise(even)


def _rows_before(sizes: DataFrame, ranges: int) -> DataFrame:
    """One array: for every range the number of rows in the ranges before it."""
    def before(position: Column) -> Column:
        smaller = F.filter("sizes", lambda entry: entry["__range"] < position)
        return F.aggregate(smaller, F.lit(0).cast("bigint"), lambda total, entry: total + entry["size"])

    return sizes.agg(F.collect_list(F.struct("__range", "size")).alias("sizes")).select(
        F.transform(F.sequence(F.lit(0), F.lit(ranges - 1)), before)
    )


def _cuts_up_to(order: Column, cuts: Column, limit: int) -> Column:
    """How many of the ascending `cuts` (fewer than `limit`) are not above `order`, by bisection.

    Past the end of the array and for a NULL order the comparison is NULL, and the position stays.
    """
    steps = [1 << bit for bit in reversed(range(max(1, (limit - 1).bit_length())))]
    position = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= order, at + step).otherwise(at),
    )
    return F.coalesce(position, F.lit(0))


def max_id(dim: DataFrame, id_col: str) -> DataFrame:
    """One row: the greatest key of a dimension, 0 when it has none."""
    return dim.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("max_id"))


def assign_keys(new: DataFrame, existing: DataFrame, label: str, id_col: str) -> DataFrame:
    """Give new members the keys after the existing maximum, dense and in label order."""
    numbered = global_row_number(new, F.col(label), name=id_col)
    return numbered.withColumn(id_col, F.col(id_col) + max_id(existing, id_col).scalar())
