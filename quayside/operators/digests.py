"""The content of two tables compared by digests of key ranges.

Both sides are cut into the same ranges of a position, the first whole-number key
column, or a hash of the key where it has none.  A range's digest is its number of
rows and sums of their hashes, so the order of rows and their files do not matter, and
repeated rows count.  Ranges whose digests differ are cut again, on both sides, until
they are small; only rows in them are compared key by key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.contracts import ContractError, TableContract

#: Ranges compared at a time; so many rows reach the driver at most, twice over.
RANGES = 1024

#: Ranges with fewer rows are not cut again.
LEAF_ROWS = 100_000

#: Ranges up to this number are a filter each, which can skip files.
FILTERS = 32

_LOW = (1 << 32) - 1


def position(contract: TableContract) -> Column:
    if not contract.key:
        raise ContractError(f"{contract.name} has no key to compare by")
    whole = [k for k in contract.key if isinstance(contract[k].type, T.LongType)]
    return F.col(whole[0]) if whole else F.shiftright(F.xxhash64(*contract.key), 2)


def _sums(contract: TableContract) -> list[Column]:
    """Rows, and four sums of halves of two 64-bit hashes; no sum leaves a long below 2**31 rows."""
    # A hash passes over nulls, so where they are is hashed beside the values.
    parts = [F.array(*(F.col(c).isNull() for c in contract.column_names))]
    for column in contract.columns:
        parts.append(F.col(column.name))
        if isinstance(column.type, T.ArrayType):
            parts.append(F.transform(column.name, lambda x: x.isNull()))
    halves = []
    for seed in (1, 2):
        hashed = F.xxhash64(F.lit(seed), *parts)
        halves += [F.shiftright(hashed, 32), hashed.bitwiseAND(F.lit(_LOW))]
    return [F.count(F.lit(1)).alias("n"), *(F.sum(h).alias(f"d{i}") for i, h in enumerate(halves))]


_DIGEST = ["n", "d0", "d1", "d2", "d3"]


def _bucket(at: Column, width: int) -> Column:
    """Which range of a grid of this width, the one of 0 beginning at 0."""
    down = F.when((at < 0) & (at % width != 0), 1).otherwise(0)
    return F.call_function("div", at, F.lit(width)) - down


@dataclass(frozen=True)
class Differing:
    """Ranges ``[k * width, (k + 1) * width)`` in which two tables differ; ``nulls``: also rows without position."""

    width: int
    buckets: tuple[int, ...]
    nulls: bool

    def __bool__(self) -> bool:
        return bool(self.buckets) or self.nulls

    @property
    def ranges(self) -> list[tuple[int, int]]:
        """First and last position of each run of neighbouring ranges."""
        runs: list[list[int]] = []
        for k in self.buckets:
            if runs and runs[-1][1] == k - 1:
                runs[-1][1] = k
            else:
                runs.append([k, k])
        return [(max(a * self.width, -(1 << 63)), min((b + 1) * self.width - 1, (1 << 63) - 1)) for a, b in runs]

    def holds(self, at: Column) -> Column:
        """Whether a row is in one of the ranges; bounds of all of them always reach the files."""
        ranges = self.ranges
        if not ranges:
            inside = F.lit(False)
        elif len(ranges) <= FILTERS:
            inside = reduce(Column.__or__, ((at >= a) & (at <= b) for a, b in ranges))
        else:
            inside = (at >= ranges[0][0]) & (at <= ranges[-1][1]) & _bucket(at, self.width).isin(list(self.buckets))
        return inside | at.isNull() if self.nulls else inside


def _compared(left: DataFrame, right: DataFrame, contract: TableContract, width: int) -> DataFrame:
    """``bucket, n`` of ranges whose digests differ; ``n`` is the rows of the larger side."""
    sides = []
    for df, side in ((left, "l"), (right, "r")):
        digests = df.groupBy(_bucket(position(contract), width).alias("bucket")).agg(*_sums(contract))
        sides.append(digests.select("bucket", *(F.col(c).alias(f"{side}_{c}") for c in _DIGEST)).alias(side))
    joined = sides[0].join(sides[1], F.col("l.bucket").eqNullSafe(F.col("r.bucket")), "full_outer")
    same = reduce(Column.__and__, (F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in _DIGEST))
    return joined.where(~same).select(
        F.coalesce("l.bucket", "r.bucket").alias("bucket"), F.greatest(*(F.coalesce(f"{s}_n", F.lit(0)) for s in "lr")).alias("n")
    )


def differing_ranges(
    left: DataFrame, right: DataFrame, contract: TableContract, ranges: int = RANGES, leaf_rows: int = LEAF_ROWS
) -> Differing:
    """Where two tables with the contract's columns differ; false if they do not.

    The first round reads both tables, with partial sums in each task; later ones
    read the ranges that differ.
    """
    at = position(contract)
    ends = [df.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first() for df in (left, right)]
    lo = min((e["lo"] for e in ends if e["lo"] is not None), default=0)
    hi = max((e["hi"] for e in ends if e["hi"] is not None), default=0)
    width = max(1, math.ceil((hi - lo + 1) / ranges))
    found = Differing(width, (), False)
    inside = F.lit(True)
    while True:
        rows = _compared(left.where(inside), right.where(inside), contract, width).collect()
        found = Differing(
            width, tuple(sorted(r["bucket"] for r in rows if r["bucket"] is not None)), any(r["bucket"] is None for r in rows)
        )
        finer = ranges // max(1, len(found.buckets))
        large = any(r["n"] > leaf_rows for r in rows if r["bucket"] is not None)
        if width == 1 or finer < 2 or not large:
            return found
        width = max(1, width // finer)
        inside = found.holds(at)


def differences(
    left: DataFrame, right: DataFrame, contract: TableContract, ranges: int = RANGES, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """Keys whose rows differ: the key, ``kind``, ``left_rows`` and ``right_rows``.

    ``kind`` is ``missing`` (in the left table only), ``extra`` (in the right only) or
    ``changed``.  Rows that share a key are compared as a set in which copies count.
    """
    found = differing_ranges(left, right, contract, ranges, leaf_rows)
    inside = found.holds(position(contract))
    sides = []
    for df, side in ((left, "l"), (right, "r")):
        digests = df.where(inside).groupBy(*contract.key).agg(*_sums(contract))
        names = [F.col(k).alias(f"{side}_{k}") for k in contract.key] + [F.col(c).alias(f"{side}_{c}") for c in _DIGEST]
        sides.append(digests.select(*names))
    same_key = reduce(Column.__and__, (F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")) for k in contract.key))
    joined = sides[0].join(sides[1], same_key, "full_outer")
    same = reduce(Column.__and__, (F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in _DIGEST))
    kind = F.when(F.col("r_n").isNull(), "missing").when(F.col("l_n").isNull(), "extra").otherwise("changed")
    keys = [F.when(F.col("l_n").isNull(), F.col(f"r_{k}")).otherwise(F.col(f"l_{k}")).alias(k) for k in contract.key]
    return joined.where(~same).select(
        *keys,
        kind.alias("kind"),
        F.coalesce("l_n", F.lit(0)).alias("left_rows"),
        F.coalesce("r_n", F.lit(0)).alias("right_rows"),
    )
