"""Run a query and its SQL over the same files and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, con, sql: str) -> str:
    """Empty when both return the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = _rows(names, result.fetchall())
    actual = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    if sorted(names) != sorted(frame.columns):
        return f"columns: spark only {set(frame.columns) - set(names)}, sql only {set(names) - set(frame.columns)}"
    if actual == expected:
        return ""
    extra, missing = set(actual) - set(expected), set(expected) - set(actual)
    return (
        f"{len(actual)} rows for {len(expected)}; {len(extra)} extra, {len(missing)} missing; "
        f"columns {sorted(names)}; e.g. {sorted(extra)[:2]} / {sorted(missing)[:2]}"
    )
