"""What a table holds now: its latest rows, without those that vanished from the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.contracts import LINEAGE, TableContract
from quayside.functions.frames import same_row
from quayside.operators.catalog import table_name
from quayside.operators.conform import Run, with_lineage
from quayside.operators.dedup import latest
from quayside.operators.sinks import read_table


def _vanished_table(namespace: str, contract: TableContract) -> str:
    return table_name(namespace, f"{contract.name}__vanished")


def mark_vanished(spark: SparkSession, keys: DataFrame, contract: TableContract, namespace: str, run: Run) -> None:
    """Record that the source no longer has these keys; rows loaded later count again."""
    name = _vanished_table(namespace, contract)
    kinds = [contract[k] for k in contract.key] + list(LINEAGE)
    listed = ", ".join(f"`{c.name}` {c.type.simpleString()}" for c in kinds)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({listed}) USING parquet")
    with_lineage(keys.select(*contract.key), run).write.insertInto(name)


def vanished(spark: SparkSession, contract: TableContract, namespace: str) -> DataFrame | None:
    """Keys that vanished, with the lineage of the sweep that noticed; None if none ever did."""
    name = _vanished_table(namespace, contract)
    return spark.table(name) if spark.catalog.tableExists(name) else None


def read_current(spark: SparkSession, namespace: str, contract: TableContract) -> DataFrame:
    """One row per key, the last loaded, unless its key vanished at or after that load."""
    rows = latest(read_table(spark, namespace, contract), list(contract.key), ["_ingested_at", "_ingestion_batch_id"])
    gone = vanished(spark, contract, namespace)
    if gone is None:
        return rows
    last = gone.groupBy(*contract.key).agg(F.max("_ingested_at").alias("_vanished_at"))
    after = last["_vanished_at"] >= rows["_ingested_at"]
    return rows.join(last, same_row(rows, last, list(contract.key)) & after, "left_anti")
