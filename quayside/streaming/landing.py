"""Increments as a stream: files that arrive in a landing folder become batches of a table."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside.contracts import TableContract
from quayside.operators.catalog import create_namespace, require_table, table_ddl, table_name
from quayside.operators.conform import Run, conform, with_lineage
from quayside.operators.drift import widen
from quayside.operators.sinks import publish_batch, settle, write_batch
from quayside.plans.audit import OK, append_audit, audit_frame
from quayside.session import require_session, timestamps_with_statistics

log = logging.getLogger(__name__)

STREAM = "stream"


@dataclass
class Landing:
    """Parquet files of one table's raw rows, loaded once each, whatever dies in between.

    A micro-batch is a batch of the table, named after the stream, as its checkpoint knows
    it, and its number.  Spark repeats a batch with the same files if it was not
    recorded as done; one that the table has already is passed over, one that was
    written and not published is written again.  ``read_current`` gives the latest rows.

    ``checkpoint`` must outlive the application.  Files must be moved into the folder
    whole and not be changed there.
    """

    spark: SparkSession
    folder: str
    contract: TableContract
    namespace: str
    checkpoint: str
    location: str | None = None
    source_system: str = "landing"
    files_per_batch: int = 1000
    raw: T.StructType | None = None

    def __post_init__(self) -> None:
        require_session(self.spark)

    def run(self) -> int:
        """Load all files that are there, then stop; returns the batches that were loaded."""
        create_namespace(self.spark, self.namespace, self.location)
        self.spark.sql(table_ddl(self.namespace, self.contract))
        widen(self.spark, self.namespace, self.contract)
        before = len(self._published())
        query = (
            self._arriving()
            .writeStream.foreachBatch(self._load)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return len(self._published()) - before

    def _arriving(self) -> DataFrame:
        schema = self.raw or self.spark.read.parquet(self.folder).schema
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files_per_batch).parquet(self.folder)

    def _published(self) -> set[str]:
        table = require_table(self.spark, self.namespace, self.contract.name)
        return {r[0].split("_ingestion_batch_id=")[1] for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}

    def _name(self, number: int) -> str:
        """A new checkpoint is another stream, so its numbers are not mistaken for these."""
        stream = self.spark.read.json(f"{self.checkpoint}/metadata").first()["id"]
        return f"{stream}-{number:09d}"

    def _load(self, rows: DataFrame, number: int) -> None:
        started = time.monotonic()
        name = self._name(number)
        table = table_name(self.namespace, self.contract.name)
        settle(self.spark, table)
        if name in self._published():
            log.info("[%s] %s is loaded already", self.contract.name, name)
            return
        run = Run(self.source_system, name)
        with timestamps_with_statistics(rows.sparkSession):
            stamped = with_lineage(conform(rows, self.contract), run)
            done = write_batch(rows.sparkSession, stamped, self.contract, self.namespace, run)
        self._written(number)
        publish_batch(self.spark, self.contract, self.namespace, run, "append", done.folder)
        row = {
            "run_id": name,
            "ingested_at": run.ingested_at,
            "ord": 0,
            "table_name": self.contract.name,
            "mode": STREAM,
            "source_rows": done.rows,
            "loaded_rows": done.rows,
            "n_columns": len(self.contract.columns),
            "status": OK,
            "matched": True,
            "error": None,
            "elapsed_s": time.monotonic() - started,
            "high_water": done.high_water,
            "unmarked_rows": done.unmarked,
        }
        append_audit(self.spark, self.namespace, audit_frame(self.spark, [row]))

    def _written(self, number: int) -> None:
        """Called between writing and publishing a batch."""

