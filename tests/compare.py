"""Row-for-row comparison of a Spark query with its DuckDB query."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value) -> str:
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return f"{type(value).__name__} {value!r}"


def _table(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty when columns and all values agree."""
    cursor = con.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    theirs = _table(theirs_columns, cursor.fetchall())
    ours = _table(df.columns, df.collect())
    if sorted(df.columns) != sorted(theirs_columns):
        return [f"columns {sorted(df.columns)} against {sorted(theirs_columns)}"]
    if ours == theirs:
        return []
    only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
    return [f"{len(ours)} rows against {len(theirs)}; {len(only_ours)} and {len(only_theirs)} not shared",
            f"ours   {sorted(only_ours)[:2]}", f"theirs {sorted(only_theirs)[:2]}"]
