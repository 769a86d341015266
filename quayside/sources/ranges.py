"""Splitting a key into ranges of about equal row counts."""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.ranks import in_ranges, running

#: Buckets asked for in one histogram; bounds what reaches the driver.
MAX_BUCKETS = 1024


class KeyRange(NamedTuple):
    lo: int
    hi: int
    rows: int


def histogram_sql(table: str, key: str, lo: int, hi: int, width: int, window: str = "1 = 1") -> str:
    """Rows and key bounds per equal-width bucket; the source does the counting."""
    return (
        f"SELECT bucket, COUNT(*) AS n_rows, MIN(k) AS lo, MAX(k) AS hi FROM ("
        f"SELECT {key} AS k, FLOOR(({key} - ({lo})) / {width}) AS bucket FROM {table} "
        f"WHERE {key} >= {lo} AND {key} <= {hi} AND {window}) b GROUP BY bucket"
    )


def histogram_of(
    run: Callable[[str], DataFrame], table: str, key: str, window: str = "1 = 1"
) -> Callable[[int, int, int], list[KeyRange]]:
    """The histograms of one table, by whatever runs SQL on it."""

    def histogram(lo: int, hi: int, width: int) -> list[KeyRange]:
        found = run(histogram_sql(table, key, lo, hi, width, window)).collect()
        return [KeyRange(int(r["lo"]), int(r["hi"]), int(r["n_rows"])) for r in found]

    return histogram


def ordered_sql(table: str, key: str, parts: int, window: str = "1 = 1") -> str:
    """Rows and key bounds of equal shares of the rows in key order, for keys that are no numbers."""
    return (
        f"SELECT bucket, COUNT(*) AS n_rows, MIN(k) AS lo, MAX(k) AS hi FROM ("
        f"SELECT {key} AS k, NTILE({parts}) OVER (ORDER BY {key}) AS bucket FROM {table} "
        f"WHERE {key} IS NOT NULL AND {window}) b GROUP BY bucket ORDER BY bucket"
    )


def ordered_shares(df: DataFrame, key: str, parts: int, ranges: int | None = None) -> DataFrame:
    """The same for rows that Spark holds, as ``bucket, n_rows, lo, hi``; no task sees all rows.

    Rows are counted by key first, so a value with many rows is one row from there
    on.  A value that fills a share has it to itself; others are in the share
    in which their first row lies.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = in_ranges(counts, [F.col("k")], ranges)
    total = placed.agg(F.sum("n")).first()[0] or 0
    size = max(1, math.ceil(total / parts))
    return (
        running(placed, "n", "before")
        .groupBy(F.expr(f"before div {size}").alias("bucket"), (F.col("n") >= size).alias("full"))
        .agg(F.sum("n").alias("n_rows"), F.min("k").alias("lo"), F.max("k").alias("hi"))
        .drop("full")
    )


def literal(value) -> str:
    quoted = str(value).replace("'", "''")
    return str(value) if isinstance(value, int) else f"'{quoted}'"


def ordered_predicates(key: str, shares: list) -> list[tuple[str, str | None]]:
    """Disjoint conditions that together hold for every row, also for new keys.

    ``shares`` are rows of ``ordered_sql`` or ``ordered_shares``, in order.  A value that fills a share
    gets a condition of its own and is given beside it, to be cut by another key.
    The source alone compares keys, so its order of texts need not be Python's.
    """
    starts = list(dict.fromkeys(s["lo"] for s in shares))
    full = {s["lo"] for s in shares if s["lo"] == s["hi"] and s["n_rows"] > 1}
    found = [(f"{key} < {literal(starts[0])} OR {key} IS NULL", None)]
    for start, end in zip(starts, [*starts[1:], None]):
        below = "" if end is None else f" AND {key} < {literal(end)}"
        if start in full:
            found.append((f"{key} = {literal(start)}", literal(start)))
            found.append((f"{key} > {literal(start)}{below}", None))
        else:
            found.append((f"{key} >= {literal(start)}{below}", None))
    return found


def bucket_width(lo: int, hi: int, buckets: int) -> int:
    return max(1, math.ceil((hi - lo + 1) / buckets))


def split_ranges(
    histogram: Callable[[int, int, int], list[KeyRange]], whole: KeyRange, rows_per_range: int
) -> list[KeyRange]:
    """Ranges of at most ``rows_per_range`` rows that cover every key.

    A bucket with too many rows is split again between its own lowest and
    highest key, so gaps in the key cost nothing; a single key is never split.
    ``histogram(lo, hi, width)`` lists the non-empty buckets.
    """
    pending, fine = [whole], []
    while pending:
        part = pending.pop()
        if part.rows <= rows_per_range or part.lo == part.hi:
            fine.append(part)
            continue
        buckets = min(MAX_BUCKETS, 4 * math.ceil(part.rows / rows_per_range))
        pending += histogram(part.lo, part.hi, bucket_width(part.lo, part.hi, buckets))
    return _merge(sorted(fine), rows_per_range)


def _merge(parts: list[KeyRange], rows_per_range: int) -> list[KeyRange]:
    merged: list[KeyRange] = []
    for part in parts:
        if merged and merged[-1].rows + part.rows <= rows_per_range:
            merged[-1] = KeyRange(merged[-1].lo, part.hi, merged[-1].rows + part.rows)
        else:
            merged.append(part)
    return merged


def range_predicates(key: str, ranges: list[KeyRange]) -> list[str]:
    """Disjoint conditions that together hold for every row, also for new keys."""
    if len(ranges) < 2:
        return ["1 = 1"]
    starts = [r.lo for r in ranges[1:]]
    first = f"{key} < {starts[0]} OR {key} IS NULL"
    between = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(starts, starts[1:])]
    return [first, *between, f"{key} >= {starts[-1]}"]
