"""Compare a Spark query with its SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import collections
import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _value(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    ours = _multiset(df.columns, [tuple(row) for row in df.collect()])
    theirs = _multiset(names, cursor.fetchall())
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return f"{sum(ours.values())} rows against {sum(theirs.values())}; only here {extra}; only in SQL {missing}"
