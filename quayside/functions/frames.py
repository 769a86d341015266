"""Frame helpers that keep plans safe when data grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes up to which a lookup table is sent to every executor, and rows, each of which has a cost of its own.
BROADCAST_BYTES, BROADCAST_ROWS = 16 << 20, 100_000


def lookup_join(df: DataFrame, lookup: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a lookup table, broadcasting it only when its size is checked.

    A lookup has few keys, so hashing the large side by them would leave most
    of it in a few tasks.  Beyond the bound it is a plain join, in which
    adaptive execution splits hot keys.
    """
    # Values as text are no smaller than they are; the limit bounds what is looked at.
    width = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in lookup.columns)))) + F.lit(8 * len(lookup.columns))
    size = lookup.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    small = size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES
    return df.join(F.broadcast(lookup) if small else lookup, on, how)


def hot_keys(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Keys that hold more than ``limit`` rows, and ``n_rows``; counted map-side first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > limit)


def same_row(left: DataFrame, right: DataFrame, names: list[str]):
    """Null-safe equality of the named columns, as a join condition."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
