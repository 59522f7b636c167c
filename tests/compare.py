"""Run bound queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
import time

import duckdb


def oracle_connection(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


# Spark type of a result column and the DuckDB type it must match.
SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def canonical(value):
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple((type(v).__name__, str(canonical(v))) for v in (row[i] for i in order)) for row in rows)


def compare(spark, con, name, query, sql, folder):
    """(message or None, number of rows, seconds)."""
    started = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return None, len(got), took
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    unlike = [(c, kind, types.get(c)) for c, kind in df.dtypes if SAME_TYPES.get(kind) != types.get(c)]
    if unlike:
        return f"types {unlike}", len(got), took
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), took
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}", len(got), took
    a, b = rows_of(df.columns, got), rows_of(names, want)
    for left, right in zip(a, b):
        if left != right:
            diff = [(n, x, y) for n, x, y in zip(sorted(names), left, right) if x != y]
            return f"differs: {diff[:4]}", len(got), took
    return None, len(got), took
