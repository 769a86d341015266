"""Intermediate tables in the folder all executors share, and keys of documents."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to a new shared folder and read back: lineage ends there.

    A lost executor then costs no earlier stage.  The folder lies in
    ``spark.checkpoint.dir`` and goes when that is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_key() -> Column:
    """``doc_id``, or a key made from the text where it is null.

    Rows that share a key are one document to the operators that use it.
    """
    return F.coalesce(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))))
