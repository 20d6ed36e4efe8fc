"""Compare registered queries with their DuckDB twins: `python -m tests.compare <sf> [names]`."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()
# Spark type -> DuckDB type
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when schema and rows agree, else what differs."""
    mine = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if mine != theirs:
        return f"schema: {set(mine.items()) ^ set(theirs.items())}"
    left = rows_of(df.columns, df.collect())
    right = rows_of(relation.columns, relation.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{sorted(df.columns)}: {[(c, x, y) for c, x, y in zip(sorted(df.columns), a, b) if x != y]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from eventloom.session import local_session

    directory = f"/root/testdata/sf{sys.argv[1]}"
    spark, con = local_session(8), connect(directory)
    queries, oracles = entry.queries(), entry.oracle_sql()
    print("without oracle:", sorted(set(queries) - set(oracles)), "without query:", sorted(set(oracles) - set(queries)))
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            result = difference(queries[name](spark, directory), con, oracles[name])
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        failed += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print("failed:", failed)
