"""The load job: probe, then per table count, scan, conform, stamp, load, reconcile, record."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import timedelta
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.contracts import Registry, TableContract
from quayside.functions.frames import same_row
from quayside.operators.catalog import create_tables, require_table, table_name
from quayside.operators.conform import Run, check_columns, conform, conformed, with_lineage
from quayside.operators.current import mark_vanished, read_current
from quayside.operators.digests import differences
from quayside.operators.drift import widen
from quayside.operators.incremental import changed_since, high_water_mark, not_yet_loaded, window_start
from quayside.operators.interleave import curve
from quayside.operators.layout import file_count, scan_bytes, spread
from quayside.operators.sinks import (
    MODES,
    Loaded,
    loaded,
    measured,
    publish_batch,
    read_table,
    settle,
    write_batch,
)
from quayside.plans.audit import (
    DRY_RUN,
    FAILED,
    OK,
    append_audit,
    audit_frame,
    batches_before,
    last_high_water,
)
from quayside.session import remove_folder, require_session, scratch_folder, timestamps_with_statistics
from quayside.sources.base import Source

log = logging.getLogger(__name__)

INCREMENTAL, SWEEP = "incremental", "sweep"


class IngestFailed(RuntimeError):
    """At least one table failed; ``audit`` has the row of each."""

    def __init__(self, tables: list[str], audit: DataFrame):
        super().__init__(f"failed tables, to be run again: {','.join(tables)}")
        self.tables = tables
        self.audit = audit


class CountMismatch(RuntimeError):
    """Strict runs only: the rows loaded are not the rows counted."""


@dataclass
class Ingest:
    """Whole tables of one source into one namespace.

    ``mode`` is ``truncate``, ``append`` or ``incremental`` (append what changed
    since the last load).  A count mismatch is a warning; with ``strict`` it
    fails the table and leaves it as it was.
    ``concurrency`` tables are loaded at a time; one leaves executors idle while
    small tables load, more share them.  Each is then in a scheduler pool named after it:
    with ``spark.scheduler.mode=FAIR`` small tables do not wait for the tasks of a large one.
    """

    spark: SparkSession
    source: Source
    registry: Registry
    namespace: str
    location: str | None = None
    mode: str = "truncate"
    strict: bool = False
    concurrency: int = 1
    overlap: timedelta = timedelta(0)
    cluster_files: int | None = None
    run: Run = field(default_factory=lambda: Run("source"))
    _executed: bool = field(default=False, init=False, repr=False)
    _audited: bool = field(default=False, init=False, repr=False)
    _appending: Lock = field(default_factory=Lock, init=False, repr=False)

    def __post_init__(self) -> None:
        if self.mode not in (*MODES, INCREMENTAL):
            raise ValueError(f"mode must be one of {(*MODES, INCREMENTAL)}, not {self.mode!r}")
        require_session(self.spark)

    def create(self) -> int:
        """Create the namespace and tables only; the source is not contacted."""
        return create_tables(self.spark, self.namespace, self.registry, self.location)

    def check(self, tables: str | list[str] | None = None, *, fail: bool = True) -> DataFrame:
        """Dry run: every table is read and conformed, nothing is created or written."""
        log.info("source: %s", self.source.probe(self.registry.select(tables)))
        return self._finish(self._each(tables, self._check_table), fail)

    def execute(self, tables: str | list[str] | None = None, *, create: bool = True, fail: bool = True) -> DataFrame:
        """Load the tables and return the audit, after appending it to the audit table.

        A table that fails does not stop the others; with ``fail`` the job
        raises at its end if any did.  Executing again is a new run.
        """
        if self._executed:
            self.run = Run(self.run.source_system)
        self._executed = True
        if create:
            self.create()
        log.info("source: %s", self.source.probe(self.registry.select(tables)))
        with timestamps_with_statistics(self.spark):
            rows = self._each(tables, self._load_table, self._written)
        return self._finish(rows, fail)

    def sweep(self, tables: str | list[str] | None = None, *, fail: bool = True) -> DataFrame:
        """Find what increments cannot see, by content: rows that vanished, and rows changed without a new time.

        Changed and missing rows are appended as a batch, vanished keys are marked; ``read_current``
        then has the source's rows.  Tables need a key that no two rows share.  A sweep that died is made good
        by the next.  Returns the audit; ``matched`` says that nothing differed.
        """
        if self._executed:
            self.run = Run(self.run.source_system)
        self._executed = True
        with timestamps_with_statistics(self.spark):
            rows = self._each(tables, self._sweep_table, lambda row: self._written(row | {"mode": SWEEP}))
        return self._finish([row | {"mode": SWEEP} for row in rows], fail)

    def _sweep_table(self, contract: TableContract) -> dict:
        settle(self.spark, require_table(self.spark, self.namespace, contract.name))
        source_rows = self.source.count(contract.name)
        source = conform(self.source.read(contract), contract)
        held = read_current(self.spark, self.namespace, contract).select(contract.column_names)
        folder = scratch_folder(self.spark, "differences")
        differences(source, held, contract).write.parquet(folder)
        found = self.spark.read.parquet(folder)
        fresh = found.where("kind <> 'extra'").select(*contract.key)
        done = Loaded(0, None, 0)
        if not fresh.isEmpty():
            rows = with_lineage(source.join(fresh, same_row(source, fresh, list(contract.key)), "left_semi"), self.run)
            done = write_batch(self.spark, rows, contract, self.namespace, self.run)
            publish_batch(self.spark, contract, self.namespace, self.run, "append", done.folder)
        gone = found.where("kind = 'extra'")
        if not gone.isEmpty():
            mark_vanished(self.spark, gone, contract, self.namespace, self.run)
        return {
            "source_rows": source_rows,
            "loaded_rows": done.rows,
            "n_columns": len(contract.columns),
            "matched": found.isEmpty(),
            "status": OK,
            "high_water": done.high_water,
            "unmarked_rows": done.unmarked,
        }

    def _written(self, row: dict) -> None:
        """Each table's row is in the audit as soon as it has ended; one append at a time."""
        with self._appending:
            append_audit(self.spark, self.namespace, audit_frame(self.spark, [row]), self._audited)
            self._audited = True

    def _finish(self, rows: list[dict], fail: bool) -> DataFrame:
        audit = audit_frame(self.spark, rows)
        failed = [r["table_name"] for r in rows if r["status"] == FAILED]
        if failed and fail:
            raise IngestFailed(failed, audit)
        return audit

    def _each(
        self, tables, action: Callable[[TableContract], dict], ended: Callable[[dict], None] = lambda row: None
    ) -> list[dict]:
        names = list(enumerate(self.registry.select(tables)))

        def one(item: tuple[int, str]) -> dict:
            if self.concurrency > 1:
                self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", item[1])
            row = self._recorded(*item, action)
            ended(row)
            return row

        if self.concurrency == 1:
            return [one(item) for item in names]
        with ThreadPoolExecutor(self.concurrency) as pool:
            # Wrapped once for each table: tables that share a wrapper share their thread's properties, pools too.
            ends = [pool.submit(inheritable_thread_target(self.spark)(one), item) for item in names]
            return [end.result() for end in ends]

    def _recorded(self, ord_: int, name: str, action: Callable[[TableContract], dict]) -> dict:
        """The audit row of one table; any error becomes its FAILED row."""
        row = {
            "run_id": self.run.run_id,
            "ingested_at": self.run.ingested_at,
            "ord": ord_,
            "table_name": name,
            "mode": self.mode,
            "source_rows": None,
            "loaded_rows": None,
            "n_columns": None,
            "matched": None,
            "error": None,
            "high_water": None,
            "unmarked_rows": None,
        }
        started = time.monotonic()
        try:
            row |= action(self.registry[name])
        except Exception as error:  # noqa: BLE001 - one table must not stop the others
            log.exception("[%s] failed", name)
            row |= {"status": FAILED, "error": f"{type(error).__name__}: {error}"}
        row["elapsed_s"] = time.monotonic() - started
        return row

    def _check_table(self, contract: TableContract) -> dict:
        source_rows = self.source.count(contract.name)
        # A count alone would read no column, so no value would be tried.
        counted, seen = measured(conform(self.source.read(contract), contract), contract)
        counted.write.format("noop").mode("overwrite").save()
        return {
            "source_rows": source_rows,
            "loaded_rows": loaded(seen).rows,
            "n_columns": len(contract.columns),
            "status": DRY_RUN,
        }

    def _load_table(self, contract: TableContract) -> dict:
        widen(self.spark, self.namespace, contract)
        settle(self.spark, require_table(self.spark, self.namespace, contract.name))
        source_rows = self.source.count(contract.name)
        mark = self._mark(contract)
        try:
            if mark is None:
                df, order = self._full(contract, source_rows)
            else:
                df, order = self._increment(contract, mark), contract.cluster
            if order:
                df = df.sortWithinPartitions(*order)
            done = write_batch(self.spark, df, contract, self.namespace, self.run)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._landing(contract)}")
        matched = self._reconciled(contract, source_rows, done) if mark is None else None
        # Only an increment adds to the rows held; all that is loaded whole replaces them.
        mode = "append" if mark is not None else "truncate" if self.mode == INCREMENTAL else self.mode
        publish_batch(self.spark, contract, self.namespace, self.run, mode, done.folder)
        return {
            "source_rows": source_rows,
            "loaded_rows": done.rows,
            "n_columns": len(contract.columns),
            "matched": matched,
            "status": OK,
            "high_water": done.high_water,
            "unmarked_rows": done.unmarked,
        }

    def _reconciled(self, contract: TableContract, source_rows: int, done: Loaded) -> bool:
        if done.rows == source_rows:
            return True
        told = f"[{contract.name}] source has {source_rows} rows, loaded {done.rows}"
        if self.strict:
            remove_folder(self.spark, done.folder)
            raise CountMismatch(told)
        log.warning(told)
        return False

    def _full(self, contract: TableContract, rows: int) -> tuple[DataFrame, Sequence[str | Column]]:
        """The whole table, stamped, one range of its cluster keys per task if it has any; and the order in a task."""
        raw, order = self.source.read(contract), contract.cluster
        keys = contract.cluster
        if keys and (contract.interleaved or keys != self.source.ranged_by(contract)):
            check_columns(raw.columns, contract)
            if self.source.land_first:
                raw = self._landed(raw, contract)
                size = scan_bytes(raw)
            else:
                size = self.source.size_bytes(raw)
            cores = self.spark.sparkContext.defaultParallelism
            files = self.cluster_files or file_count(contract, rows, size, cores)
            values = [conformed(raw, contract, contract[k]) for k in keys]
            if contract.interleaved:
                place = curve(raw, values, [contract[k].type for k in keys], files)
                values, order = [place(values)], [place([F.col(k) for k in keys])]
            raw = spread(raw, values, files)
        return with_lineage(conform(raw, contract), self.run), order

    def _landed(self, df: DataFrame, contract: TableContract) -> DataFrame:
        """The rows as read, in a table of the namespace that goes when the load ends."""
        name = self._landing(contract)
        df.write.format("parquet").saveAsTable(name)
        return self.spark.table(name)

    def _landing(self, contract: TableContract) -> str:
        return table_name(self.namespace, f"{contract.name}__landed_{self.run.run_id}".replace("-", "_"))

    def _mark(self, contract: TableContract) -> int | None:
        """Where the last load ended; None asks for a full load."""
        if self.mode != INCREMENTAL or not contract.modified:
            return None
        mark = last_high_water(self.spark, self.namespace, contract.name)
        if mark is None:
            mark = high_water_mark(read_table(self.spark, self.namespace, contract), contract)
        return mark

    def _increment(self, contract: TableContract, mark: int) -> DataFrame:
        start = window_start(mark, self.overlap)
        extract = conform(self.source.read_since(contract, start), contract)
        older = batches_before(self.spark, self.namespace, contract.name, start)
        target = read_table(self.spark, self.namespace, contract, except_batches=older)
        fresh = not_yet_loaded(extract, target, contract, changed_since(contract, start))
        return with_lineage(fresh, self.run)
