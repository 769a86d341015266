"""Equality of a Spark query and its SQL, row by row."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


_KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else value
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """What differs, or None."""
    rows = [tuple(r) for r in df.collect()]
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in found.description}
    other = {n: (k, kinds[n]) for n, k in df.dtypes if k != kinds[n]}
    if other:
        return f"types {other}"
    ours, theirs = _bag(df.columns, rows), _bag(names, found.fetchall())
    if ours == theirs:
        return None if ours else "no row to compare"
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"ours only {list(ours - theirs)[:2]}; theirs only {list(theirs - ours)[:2]}"
    )
