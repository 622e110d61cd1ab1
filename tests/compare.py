"""Order-free comparison of a Spark result with a DuckDB answer."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return repr(round(value, 9))
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return repr(value)


def rows_by_name(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree in column names, types of value and rows."""
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_by_name(names, answer.fetchall())
    got = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    only_got = [r for r in got[:20000] if r not in set(want)][:2]
    only_want = [r for r in want[:20000] if r not in set(got)][:2]
    return f"{sorted(names)}\n rows {len(got)} != {len(want)}\n spark only {only_got}\n answer only {only_want}"
