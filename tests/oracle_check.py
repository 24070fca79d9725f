"""Compare registered queries with their SQL: columns, row count, and all values irrespective of order."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(con, frame, sql):
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    described = {d[0]: str(d[1]) for d in result.description}
    types = {name: (dtype, described[name]) for name, dtype in frame.dtypes if TYPES[dtype] != described[name]}
    if types:
        return f"types differ: {types}"
    actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    expected = rows_of(names, expected_rows)
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]}" if wrong else None
