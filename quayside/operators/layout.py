"""How rows are laid out in a table's files."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.contracts import TableContract

TARGET_FILE_BYTES = 512 * 1024 * 1024

#: A table below the target size is still written by several tasks, if each
#: gets this many rows; more files than this would slow its readers down.
SMALL_FILE_ROWS = 100_000
SMALL_TABLE_FILES = 16

_WIDTHS = {T.LongType: 8, T.TimestampType: 8, T.DateType: 4, T.BooleanType: 1, T.DecimalType: 8}


def file_count(contract: TableContract, rows: int, size_bytes: int | None, cores: int = 1) -> int:
    """Files for a load, from the source's bytes or else its rows and types; one if it has no rows."""
    if not rows:
        return 1
    if size_bytes is None:
        size_bytes = rows * sum(_WIDTHS.get(type(c.type), 24) for c in contract.columns)
    by_size = math.ceil(size_bytes / TARGET_FILE_BYTES)
    by_cores = min(cores, SMALL_TABLE_FILES, math.ceil(rows / SMALL_FILE_ROWS))
    return max(1, by_size, by_cores)


def scan_bytes(df: DataFrame) -> int:
    """Bytes of the files a plain scan reads, from the listing Spark already has."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, keys: list[Column], files: int) -> DataFrame:
    """Range-partition by the keys, one partition per file to be written.

    The input partition's number is the last range key.  It splits a key that
    holds more rows than a file should, also when the rows are exact copies,
    and, unlike a random salt, is the same when a lost task runs again.

    Spark runs everything below this shuffle twice, once to sample the ranges:
    spread a source frame first and convert its values afterwards.
    """
    return df.withColumn("_split", F.spark_partition_id()).repartitionByRange(files, *keys, "_split").drop("_split")


def cluster(df: DataFrame, keys: tuple[str, ...], files: int) -> DataFrame:
    """Range-partition and sort by the cluster keys: narrow min/max per file."""
    if not keys:
        return df
    return spread(df, [F.col(k) for k in keys], files).sortWithinPartitions(*keys)
