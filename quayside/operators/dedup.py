"""The latest row of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], newest_by: list[str]) -> DataFrame:
    """One row per key: the newest, other columns deciding ties.

    Spark keeps the first row of each key per input task before it shuffles,
    so a key with very many rows does not reach one task whole.
    """
    rest = [c for c in df.columns if c not in key and c not in newest_by]
    order = [F.col(c).desc_nulls_last() for c in [*newest_by, *rest]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def lookup(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """The latest row of each key of a lookup, which holds a copy for every appended batch."""
    newest_by = ["_ingested_at"] if "_ingested_at" in df.columns else []
    return latest(df.select(key, *columns, *newest_by), [key], newest_by).select(key, *columns)
