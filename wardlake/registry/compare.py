"""Run a registered query and its SQL counterpart and compare the rows, whatever their order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path


def normal(value):
    """Values that both engines return alike."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 9) + 0.0
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in rows)


def sql_rows(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = f"{path}/*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return columns, cursor.fetchall()


def differences(df, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Number of rows, and what differs (empty when equal)."""
    rows = df.collect()
    columns, got = bag(df.columns, rows)
    other_columns, expected = bag(*sql_rows(sql, sf_dir))
    notes = []
    if columns != other_columns:
        notes.append(f"columns {columns} against {other_columns}")
    elif got != expected:
        notes.append(f"{sum(got.values())} rows against {sum(expected.values())}")
        notes += [f"only Spark: {r}" for r in list((got - expected))[:3]]
        notes += [f"only SQL:   {r}" for r in list((expected - got))[:3]]
    return len(rows), notes
