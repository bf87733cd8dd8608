"""Helpers shared by the operators: staging, row keys that survive nulls, label folds."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.session import scratch_path


#: Rows and bytes that a Python worker is handed at a time; whole texts may be long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def on_workers(spark: SparkSession, batch: dict[str, str] = BATCH) -> None:
    """Let Python workers import this library from the folder where the driver has it.

    A folder that a worker's machine lacks is passed over, so an installed copy is used there. Also
    bounds what a worker holds of a text column by `batch`.
    """
    for key, value in batch.items():
        spark.conf.set(key, value)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared scratch folder and read again.

    This cuts the lineage: executors that are lost later cost only the re-reading of a file.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def hashed_fraction(column: Column, fraction: Column | float) -> Column:
    """True for about `fraction` of the values of `column`, always the same ones."""
    share = F.pmod(F.xxhash64(column, F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    return share < fraction
