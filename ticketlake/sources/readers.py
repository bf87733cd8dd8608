"""Batch and streaming readers of extracts, and bronze landing."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", keep_corrupt: bool = False
) -> DataFrame:
    """CSV extract with a header and a fixed schema.

    Columns bind by position whatever the header says. A field that does not parse becomes NULL and
    its row stays; `keep_corrupt` adds the raw text of such rows in `_corrupt_record`.
    """
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True).option("sep", sep).option("enforceSchema", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table by name."""
    return spark.read.table(name)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Files of a path, in the given format, with the schema they carry."""
    return spark.read.format(fmt).load(path)


def preview(table: DataFrame, order: list[str], n: int = 1000) -> DataFrame:
    """First `n` rows through SQL, in a stated order so that the answer is always the same."""
    columns = ", ".join(f"`{c}` ASC NULLS FIRST" for c in order)
    return table.sparkSession.sql(f"SELECT * FROM {{t}} ORDER BY {columns} LIMIT {int(n)}", t=table)


def with_lineage(df: DataFrame, run_ts, source: str) -> DataFrame:
    """Add the load time, where the rows came from, and the date and run bronze is partitioned by."""
    loaded = F.lit(str(run_ts)).cast("timestamp_ntz")  # as text: no session zone shifts it
    return df.withColumns(
        {
            "_loaded_at": loaded,
            "_source": F.lit(source),
            "_load_date": loaded.cast("date"),
            "_load_run": F.date_format(loaded, "HHmmss"),
        }
    )


def land_bronze(df: DataFrame, run_ts, path: str, source: str = "") -> DataFrame:
    """Append an extract to a bronze folder partitioned by load date and run; returns the folder.

    A run replaces only its own partition, so repeating a failed load cannot double it.
    """
    landed = with_lineage(df, run_ts, source)
    (
        landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("_load_date", "_load_run").parquet(path)
    )
    return df.sparkSession.read.schema(landed.schema).parquet(path)


class Quarantine(NamedTuple):
    """Good rows, bad rows with the array `_reasons` of the rules they break, and how many there are."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def judged(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """`df` with `_reasons`: the names, in order, of the rules whose condition a row fulfils.

    A rule describes what is wrong. A condition that is NULL doesn't hold. Rows read with `keep_corrupt`
    have the reason `malformed` first where a field didn't parse.
    """
    wrong = {name: F.expr(rule) if isinstance(rule, str) else rule for name, rule in rules.items()}
    if CORRUPT in df.columns:
        wrong = {"malformed": F.col(CORRUPT).isNotNull(), **wrong}
    if not wrong:
        return df.withColumn("_reasons", F.array().cast("array<string>"))
    return df.withColumn("_reasons", F.array_compact(F.array(*[F.when(is_wrong, F.lit(name)) for name, is_wrong in wrong.items()])))


def quarantine(df: DataFrame, rules: Mapping[str, Column | str], path: str) -> Quarantine:
    """Split rows into good and bad ones in one pass, written to `path` and read again from there.

    The source is scanned once: a row's verdict is the partition it is written to, and the counts (`rows`,
    `bad`, and one for each rule) are observed on the way. Both sides are whole, repeated rows included. Good
    rows have the columns of `df` without the raw text of malformed ones. A load that is repeated replaces
    the folder. A retried task doesn't write rows twice, and the counts are those of the attempts that count.
    """
    split = judged(df, rules)
    observed = Observation()
    names = (["malformed"] if CORRUPT in df.columns else []) + list(rules)
    broken = {name: F.count_if(F.array_contains("_reasons", name)) for name in names}
    (
        split.withColumn("_bad", F.size("_reasons") > 0)
        .observe(
            observed, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_bad")).alias("bad"),
            *[count.alias(f"rule_{i}") for i, count in enumerate(broken.values())])
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_bad").parquet(path)
    )
    seen = observed.get
    written = df.sparkSession.read.schema(T.StructType([*split.schema.fields, T.StructField("_bad", T.BooleanType())])).parquet(path)
    good = written.filter("NOT _bad").select(*[f"`{c}`" for c in df.columns if c != CORRUPT])
    bad = written.filter("_bad").drop("_bad")
    return Quarantine(good, bad, {
        "rows": seen["rows"], "bad": seen["bad"], **{name: seen[f"rule_{i}"] for i, name in enumerate(names)}})


def stream_tickets(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Continuous ticket events from a folder new files arrive in."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
