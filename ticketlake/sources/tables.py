"""Stored tables: Parquet tables of the session catalog, partitioned by period and bucketed by key.

A table is named by its folder. Its rows are partitioned by the period of a date (`PERIOD`) and, within
a period, bucketed by a hash of the key, both by Spark's own writer. So a merge reads and rewrites only
the periods it touches, by dynamic partition overwrite: Spark writes beside the old files and moves the
new ones in place when the job has committed, so a lost job leaves the table as it was and a job may read
the table it writes. And because the stored side lies in buckets, only the updates are shuffled.

A table has one writer at a time. A catalog that forgets, as a session's own one does, gets a table back
from its folder by `ensure_table`.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.operators.quality import assert_not_null
from ticketlake.operators.upsert import Key, key_pairs, merge_changes, new_rows, reduce_updates, upsert
from ticketlake.session import scratch_path

#: The partition column; a row without a date, and every row of a table without a period, has `NO_PERIOD`.
PERIOD = "part_period"
NO_PERIOD = dt.date(1600, 1, 1)
_PROPERTY = "ticketlake.table"


class Layout(NamedTuple):
    """Where rows live: `buckets` hash buckets of `keys` in every `days` days of `period`."""

    keys: Sequence[str] = ()
    buckets: int = 1
    period: str | None = None
    days: int = 30

    def checked(self) -> Layout:
        if self.buckets < 1 or self.days < 1:
            raise ValueError("buckets and days must be at least 1")
        return self._replace(keys=list(self.keys))

    def renamed(self, mapping: dict[str, str]) -> Layout:
        return self._replace(
            keys=[mapping.get(k, k) for k in self.keys], period=mapping.get(self.period, self.period)
        )


# --- names and folders ------------------------------------------------------------------------------
def table_name(path: str) -> str:
    """Catalog name of the table in a folder."""
    words = re.sub(r"\W+", "_", path).strip("_").lower()[-80:]
    return f"{words}_{hashlib.md5(path.rstrip('/').encode()).hexdigest()[:8]}"


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files in a folder, 0 if there is none."""
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def table_exists(spark: SparkSession, path: str) -> bool:
    return spark.catalog.tableExists(table_name(path))


# --- definition -------------------------------------------------------------------------------------
def _definition(spark: SparkSession, path: str) -> tuple[T.StructType, Layout]:
    """Schema, with required columns as not nullable, and layout of a stored table."""
    if not table_exists(spark, path):
        raise FileNotFoundError(f"no table is known in {path}")
    found = dict(spark.sql(f"SHOW TBLPROPERTIES {table_name(path)}").collect())
    stated = json.loads(found[_PROPERTY])
    return T.StructType.fromJson(stated["schema"]), Layout(**stated["layout"])


def _create(spark: SparkSession, path: str, schema: T.StructType, layout: Layout) -> None:
    layout = layout.checked()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    stated = json.dumps({"schema": schema.jsonValue(), "layout": layout._asdict()}, ensure_ascii=True)
    stated = stated.replace("\\", "\\\\").replace("'", "\\'")
    buckets = f"CLUSTERED BY ({', '.join(f'`{k}`' for k in layout.keys)}) INTO {layout.buckets} BUCKETS"
    spark.sql(
        f"CREATE TABLE {table_name(path)} ({columns}, {PERIOD} DATE) USING parquet"
        f" OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY ({PERIOD})"
        f" {buckets if layout.keys else ''} LOCATION '{path}' TBLPROPERTIES ('{_PROPERTY}' = '{stated}')")
    if _exists(spark, path):
        spark.sql(f"ALTER TABLE {table_name(path)} RECOVER PARTITIONS")


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, layout: Layout = Layout()
) -> None:
    """Create a table unless it is known; rows that its folder holds already belong to it.

    Columns declared NOT NULL are enforced by writes.
    """
    if not table_exists(spark, path):
        _create(spark, path, schema, layout)


def create_catalog_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None
) -> None:
    """A plain Parquet table of the session catalog by its own name; `location` makes it external."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


# --- periods ----------------------------------------------------------------------------------------
def period_of(layout: Layout, schema: T.StructType, columns: dict[str, Column]) -> Column:
    """First day of a row's period, from its date cast to the table's type.

    It does not depend on the session's time zone, so a row always finds its period again.
    """
    if layout.period is None:
        return F.lit(NO_PERIOD)
    moment = columns[layout.period].cast(schema[layout.period].dataType)
    zoned = isinstance(schema[layout.period].dataType, T.TimestampType)
    day = F.floor(F.unix_seconds(moment) / 86400) if zoned else F.unix_date(moment.cast("date"))
    first = F.date_from_unix_date((F.floor(day / layout.days) * layout.days).cast("int"))
    return F.coalesce(first, F.lit(NO_PERIOD))


def _own_period(layout: Layout, schema: T.StructType) -> Column:
    return period_of(layout, schema, {name: F.col(f"`{name}`") for name in schema.names})


def read_path(
    spark: SparkSession, path: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """The rows of a table; `since` and `until`, both included, select days of its period column.

    They become partition filters, so periods outside are not listed or read, and a filter of the rows.
    Every row has a period; the filter that says so makes Spark list the files when it plans, and so know
    their size, which decides about broadcasts.
    """
    schema, layout = _definition(spark, path)
    rows = _stored(spark, path).filter(F.col(PERIOD).isNotNull())
    if since is not None or until is not None:
        if layout.period is None:
            raise ValueError("the table has no period")
        zoned = isinstance(schema[layout.period].dataType, T.TimestampType)
        spare = dt.timedelta(days=1 if zoned else 0)  # the session's day may begin in another one of the periods
        own = F.col(f"`{layout.period}`").cast("date")
        if since is not None:
            rows = rows.filter((F.col(PERIOD) > F.lit(since - spare - dt.timedelta(days=layout.days))) & (own >= F.lit(since)))
        if until is not None:
            rows = rows.filter((F.col(PERIOD) <= F.lit(until + spare)) & (own <= F.lit(until)))
    return rows.select(*[F.col(f"`{name}`") for name in schema.names])


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The table with its partition column; files that another session has written meanwhile are seen."""
    spark.catalog.refreshTable(table_name(path))
    return spark.read.table(table_name(path))


# --- writing ----------------------------------------------------------------------------------------
def _placed(df: DataFrame, schema: T.StructType, layout: Layout) -> DataFrame:
    """Rows typed like the table, with their period; required columns are checked in the same job."""
    checked = assert_not_null(df, [f.name for f in schema.fields if not f.nullable])
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    return checked.select(*columns, _own_period(layout, schema).alias(PERIOD))


def _dealt(rows: DataFrame, layout: Layout) -> DataFrame:
    """One task for each bucket, or tasks of the advisory size for a table without buckets."""
    if layout.keys:
        return rows.repartition(layout.buckets, *[F.col(f"`{k}`") for k in layout.keys])
    return rows.hint("rebalance", PERIOD)


def _replace(rows: DataFrame, path: str, touched: Iterable[dt.date]) -> None:
    """Write placed rows over the periods they fall into; of the `touched` ones, those without rows go."""
    spark, name, seen = rows.sparkSession, table_name(path), Observation()
    rows.observe(seen, F.collect_set(PERIOD).alias("periods")).write.insertInto(name, overwrite=True)
    for period in sorted(set(touched) - set(seen.get["periods"])):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PERIOD} = DATE '{period.isoformat()}')")
        remove(spark, f"{path}/{PERIOD}={period.isoformat()}")


def _periods(rows: DataFrame) -> list[dt.date]:
    """The periods of some rows: as many values as the time they span has periods."""
    return [row[0] for row in rows.select(PERIOD).distinct().collect()]


def overwrite_path(
    df: DataFrame, path: str, layout: Layout = Layout(), required: Sequence[str] = (),
) -> None:
    """Replace a table. `df` may read the table it replaces.

    With the schema and layout that the table has, a lost job leaves it as it was. With others, the new
    rows are written to the scratch folder first, and the table is made anew from there.
    """
    spark = df.sparkSession
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, f.name not in required) for f in df.schema.fields]
    )
    layout = layout.checked()
    if not table_exists(spark, path):
        ensure_table(spark, path, schema, layout)
        _dealt(_placed(df, schema, layout), layout).write.insertInto(table_name(path), overwrite=True)
    elif _definition(spark, path) == (schema, layout):
        before = _periods(_stored(spark, path))
        _replace(_dealt(_placed(df, schema, layout), layout), path, before)
    else:
        with staged(df) as rows:
            spark.sql(f"DROP TABLE {table_name(path)}")
            remove(spark, path)
            overwrite_path(rows, path, layout, required)


def append_path(df: DataFrame, path: str) -> None:
    """Add rows to a table."""
    schema, layout = _definition(df.sparkSession, path)
    _dealt(_placed(df, schema, layout), layout).write.insertInto(table_name(path))


def rename_overwrite(spark: SparkSession, path: str, mapping: dict[str, str]) -> None:
    """Rename columns of a stored table by rewriting it, keys included."""
    schema, layout = _definition(spark, path)
    required = [mapping.get(f.name, f.name) for f in schema if not f.nullable]
    overwrite_path(
        read_path(spark, path).withColumnsRenamed(mapping), path, layout.renamed(mapping), required=required)


def upsert_table(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[Key], update_cols=None,
    insert_cols=None, *, latest_by: Sequence[Column | str] = (), null_safe: bool = True,
    keep_newer: bool = False, reduced: bool = False, changes_to: str | None = None,
) -> None:
    """Merge updates into a stored table (see `operators.upsert.upsert`).

    Updates are reduced to one row per key and staged in the shared scratch folder: they are
    computed once, later steps do not depend on the executors that made them, and their size is
    known. `reduced` says that they have one row per key already. Only the periods that hold their keys, or will, are read and rewritten; an insert-only
    merge rewrites nothing and appends. The stored rows lie in buckets of the key, so only the updates
    are shuffled to them, unless an update has a NULL in one of the bucket's columns. `changes_to` names
    a folder that takes what the merge changes (`operators.upsert.merge_changes`), written before it.
    """
    pairs = key_pairs(keys)
    schema, layout = _definition(spark, path)
    if not set(layout.keys) <= {t for t, _ in pairs}:
        raise ValueError(f"table is bucketed by {layout.keys}, which is not part of the merge key")
    one_per_key = updates if reduced else reduce_updates(updates, [s for _, s in pairs], latest_by, null_safe)
    place = period_of(layout, schema, _source_columns(updates, schema, pairs, insert_cols))
    with staged(one_per_key.withColumn(PERIOD, place)) as stage:
        source = stage.drop(PERIOD)
        nulls = [F.count_if(F.col(f"`{dict(pairs)[k]}`").isNull()) for k in layout.keys]
        periods, *without = stage.agg(F.collect_set(PERIOD), *nulls).first()
        plain = [k for k, n in zip(layout.keys, without) if not n]
        stored = _stored(spark, path)
        touched = {*periods, *_homes(stored, stage, pairs, layout, null_safe, plain)}
        target = stored.filter(F.col(PERIOD).isin(touched)).select(*[F.col(f"`{n}`") for n in schema.names])
        if changes_to is not None:
            if not null_safe:
                raise ValueError("changes are told for null-safe keys")
            merge_changes(
                target, source, keys, update_cols, insert_cols, latest_by=latest_by, reduced=True,
                keep_newer=keep_newer, filled=plain,
            ).write.parquet(changes_to)
        if update_cols is not None and not update_cols:
            rows = new_rows(
                target, source, keys, insert_cols, null_safe=null_safe, reduced=True, filled=plain)
            _dealt(_placed(rows, schema, layout), layout).write.insertInto(table_name(path))
            return
        rows = upsert(
            target, source, keys, update_cols, insert_cols, latest_by=latest_by, null_safe=null_safe,
            reduced=True, keep_newer=keep_newer, filled=plain,
        )
        placed = _placed(rows, schema, layout)
        _replace(placed if plain else _dealt(placed, layout), path, touched)


def _source_columns(updates: DataFrame, schema: T.StructType, pairs, insert_cols) -> dict[str, Column]:
    """What an inserted row takes each table column from."""
    renamed = dict(insert_cols) if isinstance(insert_cols, Mapping) else {}
    source_of = {**{name: name for name in schema.names}, **renamed, **dict(pairs)}
    return {
        name: F.col(f"`{source}`") if source in updates.columns else F.lit(None)
        for name, source in source_of.items()
    }


def _homes(stored: DataFrame, stage: DataFrame, pairs, layout: Layout, null_safe: bool, plain) -> list[dt.date]:
    """The periods in which rows with the updates' keys live, when the period is not part of the key.

    Few values, bounded by the layout; finding them reads only the key and period columns.
    """
    if layout.period is None or layout.period in dict(pairs):
        return []
    known = stored.select(*dict(pairs), PERIOD)
    wanted = stage.select(*[F.col(f"`{s}`").alias(f"__u_{t}") for t, s in pairs])
    same = [
        known[t].eqNullSafe(wanted[f"__u_{t}"]) if null_safe and t not in plain else known[t] == wanted[f"__u_{t}"]
        for t, _ in pairs
    ]
    return _periods(known.join(wanted, reduce(and_, same), "left_semi"))


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The rows written to the shared scratch folder and read back; removed on leaving."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "stage")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)
