"""Truncate and append loads, and reading the loaded tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.contracts import LINEAGE, TableContract
from quayside.operators.catalog import require_table, set_properties, table_location
from quayside.operators.conform import Run
from quayside.session import list_folders, remove_folder, timestamps_with_statistics

MODES = ("truncate", "append")

#: Table properties while a truncating load is published, each a batch's path in the
#: table: one that does not count yet, and one beside which no other counts.
HIDDEN, ONLY = "batch_hidden", "batch_only"


@dataclass(frozen=True)
class Loaded:
    """Rows written, their highest modified time in microseconds, the rows without one, and where they are."""

    rows: int
    high_water: int | None
    unmarked: int
    folder: str | None = None


def measured(df: DataFrame, contract: TableContract) -> tuple[DataFrame, Observation]:
    """The frame, counting its rows while they pass.

    It must be the last step before the write: below a shuffle, the rows of a
    task that runs again would be counted twice.
    """
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if contract.modified:
        measures.append(F.max(F.unix_micros(contract.modified)).alias("high_water"))
        measures.append(F.count_if(F.col(contract.modified).isNull()).alias("unmarked"))
    return df.observe(seen, *measures), seen


def loaded(seen: Observation) -> Loaded:
    found = seen.get
    return Loaded(found.get("rows") or 0, found.get("high_water"), found.get("unmarked") or 0)


def load(
    spark: SparkSession,
    df: DataFrame,
    contract: TableContract,
    namespace: str,
    run: Run,
    mode: str = "truncate",
) -> Loaded:
    """Write a stamped frame as one batch and make it part of the table."""
    with timestamps_with_statistics(spark):
        written = write_batch(spark, df, contract, namespace, run)
    publish_batch(spark, contract, namespace, run, mode, written.folder)
    return written


def write_batch(spark: SparkSession, df: DataFrame, contract: TableContract, namespace: str, run: Run) -> Loaded:
    """Write a stamped frame into a new folder beside the table's.

    Every attempt has its own, so nothing changes for readers until the batch
    is published, also when a published run is tried again; one that fails
    takes its folder away.
    """
    table = require_table(spark, namespace, contract.name)
    folder = f"{table_location(spark, table)}__batches/{uuid.uuid4()}/{_spec(run)}"
    counted, seen = measured(df.drop("_ingestion_batch_id"), contract)
    try:
        counted.write.parquet(folder)
    except Exception:
        remove_folder(spark, folder)
        raise
    return replace(loaded(seen), folder=folder)


def publish_batch(
    spark: SparkSession, contract: TableContract, namespace: str, run: Run, mode: str, folder: str
) -> None:
    """Make a written batch part of its table; truncating, the only part.

    Each mode has one catalog call that makes the change for ``read_table``.  A
    run published before gets its new folder by one call too; if it truncates
    a table of several batches, the others go by a second.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    table = require_table(spark, namespace, contract.name)
    try:
        _publish(spark, table, run, mode, folder)
    except Exception:
        if not _holds(spark, table, run, folder):
            remove_folder(spark, folder)
        raise


def _publish(spark: SparkSession, table: str, run: Run, mode: str, folder: str) -> None:
    settle(spark, table)
    part = _partition(_spec(run))
    before = _folder(spark, table, run)
    if before is not None:
        spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{folder}'")
        remove_folder(spark, before)
    elif mode == "append":
        _add(spark, table, run, folder)
    else:
        announce(spark, table, run, folder)
    if mode == "truncate":
        switch(spark, table, run)
        settle(spark, table)
    spark.catalog.refreshTable(table)


def _folder(spark: SparkSession, table: str, run: Run) -> str | None:
    """Where the table has a run's batch; None if it has none."""
    part = _partition(_spec(run))
    if spark.sql(f"SHOW PARTITIONS {table} {part}").isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {part}")
    return described.where("col_name = 'Location'").first()["data_type"]


def _holds(spark: SparkSession, table: str, run: Run, folder: str) -> bool:
    """Whether a folder is part of the table; if the catalog does not say, it may be."""
    try:
        found = _folder(spark, table, run)
    except Exception:  # noqa: BLE001 - the caller is about to raise the error that came first
        return True
    return found is not None and found.rstrip("/").endswith(_attempt(folder))


def _attempt(folder: str) -> str:
    """The part of a batch's path that no other attempt has."""
    return folder[folder.index("__batches/") :].rstrip("/")


def clear_dead_batches(spark: SparkSession, namespace: str, contract: TableContract) -> int:
    """Remove folders of batches that were written and never published, as a killed load leaves them.

    No load of the table may be running.  Returns the number of folders removed.
    """
    table = require_table(spark, namespace, contract.name)
    settle(spark, table)
    held = set()
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_partition(row[0])}")
        held.add(described.where("col_name = 'Location'").first()["data_type"].rstrip("/").split("/")[-3])
    dead = [f for f in list_folders(spark, f"{table_location(spark, table)}__batches") if f.split("/")[-1] not in held]
    for folder in dead:
        remove_folder(spark, folder)
    return len(dead)


def announce(spark: SparkSession, table: str, run: Run, folder: str) -> None:
    """Add a batch that readers do not see yet."""
    set_properties(spark, table, {HIDDEN: _spec(run)})
    _add(spark, table, run, folder)


def switch(spark: SparkSession, table: str, run: Run) -> None:
    """From here on readers see this batch and no other."""
    set_properties(spark, table, {HIDDEN: "", ONLY: _spec(run)})


def settle(spark: SparkSession, table: str) -> None:
    """Drop what readers do not see: after a switch, or left by a load that died."""
    marks = _marks(spark, table)
    if not marks:
        return
    if marks.get(ONLY):
        found = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        unseen = [spec for spec in found if spec != marks[ONLY]]
    else:
        unseen = [marks[HIDDEN]] if marks.get(HIDDEN) else []
    if unseen:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(map(_partition, unseen))}")
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{HIDDEN}', '{ONLY}')")


def _marks(spark: SparkSession, table: str) -> dict[str, str]:
    listed = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key").isin(HIDDEN, ONLY))
    return {row["key"]: row["value"] for row in listed.collect()}


def _add(spark: SparkSession, table: str, run: Run, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} ADD {_partition(_spec(run))} LOCATION '{folder}'")


def _spec(run: Run) -> str:
    return f"_ingested_date={run.ingested_date}/_ingestion_batch_id={run.run_id}"


def _day_and_batch(spec: str) -> list[str]:
    return [part.split("=", 1)[1] for part in spec.split("/", 1)]


def _partition(spec: str) -> str:
    day, batch = _day_and_batch(spec)
    return f"PARTITION (_ingested_date = DATE'{day}', _ingestion_batch_id = '{batch}')"


def _is(spec: str):
    day, batch = _day_and_batch(spec)
    return (F.col("_ingested_date") == F.lit(day).cast("date")) & (F.col("_ingestion_batch_id") == batch)


def read_table(
    spark: SparkSession,
    namespace: str,
    contract: TableContract,
    *,
    batches: Iterable[str] | None = None,
    except_batches: Iterable[str] = (),
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """A loaded table in contract order, by batch or by ``since <= _ingested_at < until``.

    Bounds on the instant are repeated on the partition date, since a filter on
    the instant alone would still open every date's files.
    """
    table = require_table(spark, namespace, contract.name)
    df, marks = spark.table(table), _marks(spark, table)
    if marks.get(HIDDEN):
        df = df.where(~_is(marks[HIDDEN]))
    if marks.get(ONLY):
        df = df.where(_is(marks[ONLY]))
    if batches is not None:
        df = df.where(F.col("_ingestion_batch_id").isin(list(batches)))
    if except_batches:
        df = df.where(~F.col("_ingestion_batch_id").isin(list(except_batches)))
    if since is not None:
        day = since.astimezone(timezone.utc).date()
        df = df.where((F.col("_ingested_date") >= F.lit(day)) & (F.col("_ingested_at") >= F.lit(since)))
    if until is not None:
        day = until.astimezone(timezone.utc).date()
        df = df.where((F.col("_ingested_date") <= F.lit(day)) & (F.col("_ingested_at") < F.lit(until)))
    return df.select(*contract.column_names, *(c.name for c in LINEAGE))
