"""Run a registered query next to its SQL and compare the rows, order aside."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return datetime.datetime(value.year, value.month, value.day)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types of values and rows agree."""
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = _rows(want_names, cursor.fetchall())
    got = _rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(want_names):
        return [f"columns {sorted(df.columns)} and {sorted(want_names)}"]
    if len(got) != len(want):
        return [f"{len(got)} rows and {len(want)}"]
    found = [f"{g} and {w}" for g, w in zip(got, want, strict=True) if repr(g) != repr(w)]
    return found[:3]
