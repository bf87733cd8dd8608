"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Keyed state with timers needs this store; it also keeps large state out of the heap.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a batch writes what it changed, not all files of the store
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the context; what they were before comes back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(app: str = "ticketlake", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings every job assumes; `conf` keys use `__` for dots.

    AQE sizes and coalesces shuffle partitions at run time, so no partition count is fixed here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **ROCKSDB_STATE,
        # rows bucketed by a part of the key need no shuffle for a join on all of it
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        # Python call sites in error messages cost a stack walk per column expression
        "spark.sql.dataFrameQueryContext.enabled": "false",
        "spark.ui.enabled": "false",
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table_buckets(spark: SparkSession) -> int:
    """Buckets of a table that a merge rewrites as a whole: one for each core, as a bucket is one task's."""
    return max(4, spark.sparkContext.defaultParallelism)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stages, staged tables and stream checkpoints.

    The cluster names it in `spark.checkpoint.dir`. Only a local session without that setting gets
    a temporary folder, because on a cluster a machine-local folder dies with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    found = _local_roots.get(spark.sparkContext.applicationId)
    if found is None:
        found = _local_roots[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="ticketlake-")
    return found


_local_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared scratch folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/ticketlake/{purpose}-{uuid.uuid4().hex}"
