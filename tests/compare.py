"""Compare a Spark query with its SQL statement, regardless of row order."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def normal(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in rows)


def expected(sql: str, folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = dict(zip(columns, (str(d[1]) for d in result.description)))
    return *rows_of(columns, result.fetchall()), types


def difference(df, sql: str, folder: str) -> str | None:
    """None when columns and rows agree, else a short account of what differs."""
    columns, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want_columns, want, _ = expected(sql, folder)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if rows != want:
        return f"extra {list((rows - want).items())[:3]} missing {list((want - rows).items())[:3]}"
    return None
