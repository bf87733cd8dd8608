"""Run registered queries in Spark and their oracles in DuckDB, and compare the rows."""

from __future__ import annotations

import collections
import datetime as dt
import glob
import os
import sys
import time
import traceback

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def normal(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when rows, names and types agree, else what differs."""
    result = query(spark, sf_dir)
    names = sorted(result.columns)
    rows = result.select(*[f"`{n}`" for n in names]).collect()
    cursor = con.execute(sql)
    oracle_names = [d[0] for d in cursor.description]
    if sorted(oracle_names) != names:
        return f"columns {names} != {sorted(oracle_names)}"
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in result.schema}
    oracle_types = {d[0]: str(d[1]) for d in cursor.description}
    wrong = {n: (spark_types[n], oracle_types[n]) for n in names if spark_types[n] != oracle_types[n]}
    if wrong:
        return f"types {wrong}"
    at = [oracle_names.index(n) for n in names]
    ours = collections.Counter(tuple(normal(v) for v in row) for row in rows)
    theirs = collections.Counter(tuple(normal(row[i]) for i in at) for row in cursor.fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (f"{sum(ours.values())} rows, {sum(theirs.values())} expected; only ours "
                f"{list(extra.items())[:2]}; only oracle {list(missing.items())[:2]}")
    return None if rows or not sum(theirs.values()) else "no rows"


def main(sf: str, *only: str) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from ticketlake.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                problem = None if query(spark, sf).collect() else "no rows"
            else:
                problem = compare(spark, con, query, sql, sf)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if only:
                traceback.print_exc()
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} of {len(entry.queries())} failed")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], *sys.argv[2:])))
