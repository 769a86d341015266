"""Comparing what a source holds with what was loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(frames: dict[str, DataFrame], name: str = "n_rows") -> DataFrame:
    """Rows per table, one row each, all tables in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(table).alias("table_name"), name)
        for table, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source against loaded rows per table; a table of one side only counts as differing.

    Both inputs are ``table_name, n_rows``, as ``counts`` makes them.
    """
    return (
        source.withColumnRenamed("n_rows", "source_rows")
        .join(target.withColumnRenamed("n_rows", "loaded_rows"), "table_name", "full_outer")
        .select(
            "table_name",
            "source_rows",
            "loaded_rows",
            (F.coalesce("loaded_rows", F.lit(0)) - F.coalesce("source_rows", F.lit(0))).alias("difference"),
            F.col("source_rows").eqNullSafe(F.col("loaded_rows")).alias("matched"),
        )
    )
