"""Compare a registered query with its SQL twin: names, types by family, rows and values."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

from checks.oracle import SQL
from checks.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def _family(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, Decimal):
        return "decimal"
    return type(value).__name__


def _rows(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, name: str, sf: str) -> str:
    """Empty when equal, else what differs first."""
    df = QUERIES[name](spark, sf)
    mine, columns = [tuple(r) for r in df.collect()], df.columns
    cursor = con.execute(SQL[name])
    theirs, their_columns = cursor.fetchall(), [d[0] for d in cursor.description]
    if sorted(columns) != sorted(their_columns):
        return f"columns {sorted(columns)} against {sorted(their_columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for left, right in zip(_rows(mine, columns), _rows(theirs, their_columns)):
        for column, a, b in zip(sorted(columns), left, right):
            if _family(a) != _family(b):
                return f"{column}: {a!r} ({_family(a)}) against {b!r} ({_family(b)}) in {left}"
            if a != b and not (isinstance(a, float) and math.isnan(a) and math.isnan(b)):
                return f"{column}: {a!r} against {b!r} in {left} / {right}"
    return ""
