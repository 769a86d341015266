"""Files that are narrow in several keys at once, and what a look-up opens of them."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.ranks import ranked

#: Steps of the curve for each file, so that a file's border can be near any row.
CELLS_PER_FILE = 16

#: A key is cut in at most two to the power of this; the cuts are literals of the plan.
MOST_BITS = 10

_PREFIX_BYTES = 6

Place = Callable[[Sequence[Column]], Column]


def curve(df: DataFrame, keys: Sequence[Column], kinds: Sequence[T.DataType], files: int) -> Place:
    """Where rows lie on a Z-order curve over equally full shares of each key.

    The shares are cut by one approximate aggregate of the keys alone, whose result
    does not grow with the rows; text keys take one more for the start that all values have in
    common.  Nulls come first.  The function returned makes the place, a whole number, of the keys' columns.
    """
    bits = min(MOST_BITS, max(1, math.ceil(math.log2(max(1, files) * CELLS_PER_FILE) / len(keys))))
    texts = [i for i, kind in enumerate(kinds) if isinstance(kind, T.StringType)]
    skips = dict.fromkeys(texts, 0)
    if texts:
        ends = [end(keys[i]).alias(f"{name}{i}") for i in texts for name, end in (("least", F.min), ("most", F.max))]
        found = df.agg(*ends).first()
        for i in texts:
            both = [(found[f"{name}{i}"] or "").encode() for name in ("least", "most")]
            skips[i] = len(os.path.commonprefix(both))
    numbers = partial(_numbers, kinds, skips)
    shares = [n / (1 << bits) for n in range(1, 1 << bits)]
    cut = [F.percentile_approx(n, shares).alias(f"k{i}") for i, n in enumerate(numbers(keys))]
    cuts = [list(row or ()) for row in df.agg(*cut).first()]
    return lambda columns: _place(numbers(columns), cuts, bits)


def _numbers(kinds, skips, columns: Sequence[Column]) -> list[Column]:
    """Each key as a double whose order is the key's; texts by the first bytes in which they differ."""
    numbers = []
    for i, (column, kind) in enumerate(zip(columns, kinds)):
        if isinstance(kind, T.StringType):
            start = F.hex(F.substring(F.encode(column, "UTF-8"), skips[i] + 1, _PREFIX_BYTES))
            column = F.conv(F.rpad(start, 2 * _PREFIX_BYTES, "0"), 16, 10)
        elif isinstance(kind, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(kind, T.DateType):
            column = F.unix_date(column)
        elif isinstance(kind, T.BooleanType):
            column = column.cast("int")
        numbers.append(column.cast("double"))
    return numbers


def _place(numbers: list[Column], cuts: list[list[float]], bits: int) -> Column:
    """A binary search of all keys at once; each step adds one bit of every key to the place."""
    bounds = [F.array(*map(F.lit, c)) if c else F.array().cast("array<double>") for c in cuts]
    names = [f"k{i}" for i in range(len(numbers))]
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(bits))))

    def search(row: Column) -> Column:
        def step(state: Column, width: Column) -> Column:
            place, at = state["place"], []
            for name, bound in zip(names, bounds):
                above = F.coalesce(row[name] > F.get(bound, state[name] + width - 1), F.lit(False))
                place = place * 2 + above.cast("bigint")
                at.append((state[name] + F.when(above, width).otherwise(0)).alias(name))
            return F.struct(place.alias("place"), *at)

        start = F.struct(F.lit(0).cast("bigint").alias("place"), *(F.lit(0).alias(n) for n in names))
        return F.aggregate(steps, start, step, lambda state: state["place"])

    row = F.struct(*(n.alias(name) for n, name in zip(numbers, names)))
    return F.get(F.transform(F.array(row), search), 0)


def files_opened(df: DataFrame, key: str, ranges: int = 16) -> DataFrame:
    """``n_values, n_files, n_opened``, one row: the files opened if each value of ``key`` is looked up once.

    ``df`` is rows of a table as read.  A look-up opens the files whose least and greatest value are about
    it, which is as many as the values from one to the other; null is not looked up.
    """
    kept = df.where(F.col(key).isNotNull()).select(F.col(key).alias("value"), F.input_file_name().alias("file"))
    files = kept.groupBy("file").agg(F.min("value").alias("least"), F.max("value").alias("most"))
    values = ranked(kept.select("value").distinct(), [F.col("value")], ranges, "nth")
    first = values.select(F.col("value").alias("least"), F.col("nth").alias("from"))
    last = values.select(F.col("value").alias("most"), F.col("nth").alias("to"))
    spans = files.join(first, "least").join(last, "most").select((F.col("to") - F.col("from") + 1).alias("opened"))
    counts = [
        values.agg(F.count(F.lit(1)).alias("n_values")).select("n_values", F.expr("0L AS n_files"), F.expr("0L AS n_opened")),
        spans.select(F.expr("0L AS n_values"), F.expr("1L AS n_files"), F.col("opened").alias("n_opened")),
    ]
    return counts[0].unionByName(counts[1]).agg(*(F.sum(c).alias(c) for c in counts[0].columns))
