"""Compare a Spark result with DuckDB over the same tables."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return ("f", "nan") if math.isnan(value) else ("f", repr(value))
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, datetime.datetime):
        return ("t", value.isoformat())
    if value is None:
        return ("", "")
    return (type(value).__name__, str(value))


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = sorted(tuple(_cell(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], cells


def spark_result(df):
    return normalized(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return normalized(columns, cursor.fetchall())


def difference(left, right):
    """None when equal, else a short description."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"spark {a}\n duck {b}"
    return None
