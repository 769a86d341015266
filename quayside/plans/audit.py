"""The record of a run: one row per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.catalog import create_namespace, table_name

OK, DRY_RUN, FAILED = "OK", "DRY-RUN", "FAILED"

AUDIT_TABLE = "load_audit"

_COLUMNS = (
    "run_id string, ingested_at timestamp, ord int, table_name string, mode string, source_rows bigint, "
    "loaded_rows bigint, n_columns int, status string, matched boolean, error string, "
    "elapsed_s double, high_water bigint, unmarked_rows bigint"
)


def audit_frame(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """Audit rows as a frame; there is one per table of the run."""
    return spark.createDataFrame(list(rows), _COLUMNS)


def append_audit(spark: SparkSession, namespace: str, audit: DataFrame, made: bool = False) -> None:
    """Append rows; ``made`` says that the audit table is there, and saves asking the catalog."""
    if not made:
        create_namespace(spark, namespace)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table_name(namespace, AUDIT_TABLE)} ({_COLUMNS}) USING parquet")
    audit.coalesce(1).write.insertInto(table_name(namespace, AUDIT_TABLE))


def read_audit(spark: SparkSession, namespace: str) -> DataFrame | None:
    name = table_name(namespace, AUDIT_TABLE)
    return spark.table(name) if spark.catalog.tableExists(name) else None


def totals(audit: DataFrame) -> DataFrame:
    """Tables by status and rows loaded or checked, per run."""
    good = F.col("status").isin(OK, DRY_RUN)
    return audit.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.count_if(good).alias("n_ok"),
        F.count_if(F.col("status") == FAILED).alias("n_failed"),
        F.sum(F.when(good, F.coalesce("loaded_rows", F.lit(0))).otherwise(0)).alias("n_rows"),
    )


def failed_tables(audit: DataFrame) -> DataFrame:
    """The failed tables of each run, in run order: the ``tables`` to run again."""
    return (
        audit.where(F.col("status") == FAILED)
        .groupBy("run_id")
        .agg(F.sort_array(F.collect_list(F.struct("ord", "table_name"))).alias("failed"))
        .select("run_id", F.concat_ws(",", "failed.table_name").alias("failed_tables"))
    )


def last_failed(spark: SparkSession, namespace: str) -> list[str]:
    """Tables whose last attempt failed, whichever run it was in."""
    audit = read_audit(spark, namespace)
    if audit is None:
        return []
    attempts = audit.groupBy("table_name").agg(
        F.max_by(F.struct("status", "ord"), F.struct("ingested_at", "run_id")).alias("last")
    )
    rows = attempts.where(F.col("last.status") == FAILED).select("table_name", "last.ord").collect()
    return [row["table_name"] for row in sorted(rows, key=lambda r: (r["ord"], r["table_name"]))]


def last_high_water(spark: SparkSession, namespace: str, table: str) -> int | None:
    """The highest modified time of the batches the table has now, without reading it.

    Batches that a truncating load or a dropped table took away say nothing
    about the rows held; without any in the audit there is no mark.
    """
    audit = read_audit(spark, namespace)
    if audit is None:
        return None
    held = spark.sql(f"SHOW PARTITIONS {table_name(namespace, table)}").select(
        F.regexp_extract("partition", r"_ingestion_batch_id=([^/]*)", 1).alias("run_id")
    )
    return _done(audit, table).join(held, "run_id", "left_semi").agg(F.max("high_water")).first()[0]


def batches_before(spark: SparkSession, namespace: str, table: str, start: int) -> list[str]:
    """Batches known to hold no row modified at ``start`` or later, or at an unknown time."""
    audit = read_audit(spark, namespace)
    if audit is None:
        return []
    older = (F.coalesce("high_water", F.lit(start - 1)) < start) & (F.coalesce("unmarked_rows", F.lit(0)) == 0)
    per_batch = _done(audit, table).groupBy("run_id").agg(F.every(older).alias("older"))
    return [row["run_id"] for row in per_batch.where("older").collect()]


def _done(audit: DataFrame, table: str) -> DataFrame:
    return audit.where((F.col("table_name") == table) & (F.col("status") == OK))
