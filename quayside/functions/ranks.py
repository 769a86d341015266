"""Places of rows in one order of a whole table, without a window over all of them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import scratch_folder

#: Where a row was written: its range, and its place there.
RANGE, PLACE = "_range", "_place"

_PLACE_BITS = 33


def in_ranges(df: DataFrame, order: list[Column], ranges: int) -> DataFrame:
    """The rows cut into ranges of ``order``, with ``_range`` and ``_place`` in it, both from 0.

    The number of the input partition is the last range key, so equal rows, however
    many, are spread.  The rows are written down: range bounds are sampled, and
    every later use must see the same ones, also after a lost task ran again.
    """
    folder = scratch_folder(df.sparkSession, "ranges")
    (
        df.withColumn("_split", F.spark_partition_id())
        .repartitionByRange(ranges, *order, "_split")
        .sortWithinPartitions(*order, "_split")
        .drop("_split")
        .withColumn("_at", F.monotonically_increasing_id())
        .write.parquet(folder)
    )
    placed = df.sparkSession.read.parquet(folder)
    return placed.withColumns(
        {
            RANGE: F.shiftright("_at", _PLACE_BITS).cast("int"),
            PLACE: F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
        }
    ).drop("_at")


def known_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of a few rows of numbers, truth values and texts, a literal of the plan: no Python worker makes it."""
    names = [field.split()[0] for field in schema.split(", ")]
    told = json.dumps([dict(zip(names, row)) for row in rows])
    kind = ", ".join(f"{name}: {rest}" for name, rest in (field.split() for field in schema.split(", ")))
    return spark.range(1).select(F.inline(F.from_json(F.lit(told), f"array<struct<{kind}>>")))


def before_ranges(placed: DataFrame, measure: Column, name: str) -> DataFrame:
    """``_range, name``: the sum of a measure over all ranges before each; a row per range."""
    sums = placed.groupBy(RANGE).agg(measure.alias("_sum")).collect()
    rows, total = [], 0
    for r in sorted(sums, key=lambda r: r[RANGE]):
        rows.append((r[RANGE], total))
        total += r["_sum"]
    return known_rows(placed.sparkSession, rows, f"{RANGE} int, {name} bigint")


def ranked(df: DataFrame, order: list[Column], ranges: int, name: str = "rank") -> DataFrame:
    """The rows with their place from 1 in ``order``; equal rows get different places.

    Each range counts its rows; the counts, one number a range, are summed up on the driver.
    """
    placed = in_ranges(df, order, ranges)
    before = before_ranges(placed, F.count(F.lit(1)), "_before")
    return (
        placed.join(F.broadcast(before), RANGE)
        .withColumn(name, F.col("_before") + F.col(PLACE) + 1)
        .drop(RANGE, PLACE, "_before")
    )


def running(placed: DataFrame, measure: str, name: str) -> DataFrame:
    """Rows of ``in_ranges`` with the sum of ``measure`` over all rows before each."""
    before = before_ranges(placed, F.sum(measure), "_before")
    own = Window.partitionBy(RANGE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_own", F.coalesce(F.sum(measure).over(own), F.lit(0)))
        .join(F.broadcast(before), RANGE)
        .withColumn(name, F.col("_before") + F.col("_own"))
        .drop("_before", "_own")
    )
