"""Compare a Spark result with an SQL result over the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r),
    )


def difference(df, con, sql: str) -> str | None:
    """None if both have the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"row {got}, expected {want}"
        if [type(v) for v in got] != [type(v) for v in want]:
            return f"types of {got}, expected {want}"
    return None
