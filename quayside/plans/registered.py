"""The registered queries: each operator over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from contextlib import suppress
from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.contracts import Registry, TableContract, columns
from quayside.contracts.banking import BANKING
from quayside.contracts.warehouse import WAREHOUSE
from quayside.operators import quality, rollups, summaries
from quayside.operators.catalog import create_tables, describe_columns, table_name
from quayside.operators.conform import Run, conform, with_lineage
from quayside.operators.current import read_current, vanished
from quayside.operators.dedup import latest
from quayside.operators.digests import differences
from quayside.operators.history import chain_breaks
from quayside.operators.interleave import files_opened
from quayside.operators.money import round_to_currency
from quayside.operators.reconcile import counts, reconcile
from quayside.operators.sinks import announce, read_table, switch, write_batch
from quayside.operators.standardise import accepted, rejected, standardise
from quayside.plans.audit import failed_tables, last_failed, read_audit, totals
from quayside.plans.banking_shape import banking_frames
from quayside.plans.job import Ingest
from quayside.session import engine_session, shared_folder
from quayside.sources import FrameSource, ParquetSource
from quayside.sources.base import Source
from quayside.sources.ranges import (
    KeyRange,
    bucket_width,
    histogram_of,
    histogram_sql,
    ordered_predicates,
    ordered_shares,
    range_predicates,
    split_ranges,
)
from quayside.streaming.landing import Landing

Query = Callable[[SparkSession, str], DataFrame]

SOURCE_SYSTEM = "testdata"
FIRST = Run(SOURCE_SYSTEM, "00000000-0000-0000-0000-000000000001", datetime(2024, 1, 1, tzinfo=timezone.utc))
SECOND = Run(SOURCE_SYSTEM, "00000000-0000-0000-0000-000000000002", datetime(2024, 1, 2, tzinfo=timezone.utc))
THIRD = Run(SOURCE_SYSTEM, "00000000-0000-0000-0000-000000000003", datetime(2024, 1, 3, tzinfo=timezone.utc))

#: The first part of an incremental load ends here.
CUTOFF = datetime(1999, 12, 31, tzinfo=timezone.utc)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def printable(df: DataFrame) -> DataFrame:
    """Values two engines show alike: decimals and dates as text, times without zone, arrays by element."""
    # A row whose array is null or empty stays, with neither place nor element.
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            others = [c for c in df.columns if c != field.name]
            df = df.select(*others, F.posexplode_outer(field.name).alias(f"{field.name}_pos", field.name))
    shown = {
        f.name: F.col(f.name).cast("string" if isinstance(f.dataType, (T.DecimalType, T.DateType)) else "timestamp_ntz")
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DecimalType, T.DateType, T.TimestampType))
    } | {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.FloatType)}
    return df.withColumns(shown) if shown else df


def _job(spark: SparkSession, source: Source, registry: Registry, **options) -> Ingest:
    """A job into a new namespace of the shared folder."""
    name = f"raw_{uuid.uuid4().hex}"
    options.setdefault("run", FIRST)
    return Ingest(spark, source, registry, name, f"{shared_folder(spark)}/{name}", **options)


def _load(job: Ingest, tables: list[str]) -> Ingest:
    create_tables(job.spark, job.namespace, job.registry, job.location, tables)
    job.execute(tables, create=False)
    return job


def _loaded(job: Ingest, table: str, **bounds) -> DataFrame:
    return read_table(job.spark, job.namespace, job.registry[table], **bounds)


def _warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every test table, conformed."""
    source = ParquetSource(spark, sf_dir)
    return {c.name: conform(source.read(c), c) for c in WAREHOUSE}


def _banking(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every banking table, conformed."""
    return {name: conform(df, BANKING[name]) for name, df in banking_frames(spark, sf_dir).items()}


# --- scans ---


@query
def scan_full(spark, sf_dir):
    return ParquetSource(spark, sf_dir).read(WAREHOUSE["lineitem"])


@query
def scan_range_plan(spark, sf_dir):
    """The row counts by which a key is cut into ranges for a parallel read."""
    orders = ParquetSource(spark, sf_dir).read(WAREHOUSE["orders"])
    lo, hi = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return spark.sql(histogram_sql("{orders}", "o_orderkey", lo, hi, bucket_width(lo, hi, 16)), orders=orders)


@query
def scan_ranges(spark, sf_dir):
    """Each row is read by exactly one of the statements of a parallel read."""
    lineitem = ParquetSource(spark, sf_dir).read(WAREHOUSE["lineitem"])
    whole = KeyRange(*lineitem.agg(F.min("l_orderkey"), F.max("l_orderkey"), F.count(F.lit(1))).first())
    histogram = histogram_of(partial(spark.sql, lineitem=lineitem), "{lineitem}", "l_orderkey")
    statements = range_predicates("l_orderkey", split_ranges(histogram, whole, -(-whole.rows // 16)))
    hits = [F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in statements]
    return lineitem.groupBy(sum(hits, F.lit(0)).alias("statements")).agg(F.count(F.lit(1)).alias("n_rows"))


def _statements_per_row(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Rows by how many statements of a parallel read by this key would read them."""
    shares = ordered_shares(df, key, parts).orderBy("lo").collect()
    hits = [F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p, _ in ordered_predicates(key, shares)]
    return df.groupBy(sum(hits, F.lit(0)).alias("statements")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def scan_text_ranges(spark, sf_dir):
    """A text key is read in ranges too: each row by exactly one statement."""
    return _statements_per_row(ParquetSource(spark, sf_dir).read(WAREHOUSE["customer"]), "c_name", 16)


@query
def scan_hot_ranges(spark, sf_dir):
    """The same for a text of which few values hold all rows."""
    return _statements_per_row(ParquetSource(spark, sf_dir).read(WAREHOUSE["orders"]), "o_orderstatus", 16)


@query
def scan_text_shares(spark, sf_dir):
    """The shares themselves, of names that are all different and of few values that hold all rows."""
    source = ParquetSource(spark, sf_dir)
    names = ordered_shares(source.read(WAREHOUSE["customer"]), "c_name", 16)
    modes = ordered_shares(source.read(WAREHOUSE["lineitem"]), "l_returnflag", 5)
    return names.withColumn("key", F.lit("c_name")).unionByName(modes.withColumn("key", F.lit("l_returnflag")))


@query
def source_counts(spark, sf_dir):
    source = ParquetSource(spark, sf_dir)
    return counts({c.name: source.read(c) for c in WAREHOUSE})


@query
def empty_batch_append(spark, sf_dir):
    """A table without rows loads as a typed batch of none beside the full one."""
    orders = ParquetSource(spark, sf_dir).read(WAREHOUSE["orders"])
    job = _load(_job(spark, FrameSource({"orders": orders}), WAREHOUSE, mode="append"), ["orders"])
    nothing = FrameSource({"orders": spark.createDataFrame([], WAREHOUSE["orders"].schema)})
    replace(job, source=nothing, run=SECOND).execute(["orders"], create=False)
    audit = read_audit(spark, job.namespace).select("run_id", "loaded_rows", "n_columns", "status")
    held = _loaded(job, "orders").groupBy(F.col("_ingestion_batch_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("o_totalprice")
    )
    return audit.join(held, "run_id", "left")


# --- conform and stamp ---


@query
def conform_decimal(spark, sf_dir):
    """Products of doubles rounded half up on their decimal text."""
    lineitem = ParquetSource(spark, sf_dir).read(WAREHOUSE["lineitem"])
    net = lineitem.withColumn("l_extendedprice", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return conform(net, WAREHOUSE["lineitem"])


@query
def conform_nan(spark, sf_dir):
    """NaN becomes null in a decimal column."""
    orders = ParquetSource(spark, sf_dir).read(WAREHOUSE["orders"])
    unknown = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return conform(orders.withColumn("o_totalprice", unknown), WAREHOUSE["orders"])


_SHIPMENTS = TableContract(
    "shipments",
    columns(
        """
        l_orderkey bigint
        l_linenumber bigint
        shipped_at timestamp
        shipped_on date
        quantity_text decimal(18,2)
        returned boolean
        """
    ),
    modified=None,
)


@query
def conform_types(spark, sf_dir):
    """Integers widened, times as instants, dates cut in UTC, text parsed."""
    lineitem = ParquetSource(spark, sf_dir).read(WAREHOUSE["lineitem"])
    raw = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("shipped_at"),
        F.col("l_shipdate").alias("shipped_on"),
        F.col("l_quantity").cast("string").alias("quantity_text"),
        (F.col("l_returnflag") == "R").cast("string").alias("returned"),
    )
    return conform(raw, _SHIPMENTS)


@query
def add_lineage(spark, sf_dir):
    contract = WAREHOUSE["orders"]
    return with_lineage(conform(ParquetSource(spark, sf_dir).read(contract), contract), FIRST)


# --- loads ---


def _raw(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE), [table])
    return _loaded(job, table)


def _raw_banking(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _load(_job(spark, FrameSource(banking_frames(spark, sf_dir)), BANKING), [table])
    return _loaded(job, table)


for _table in WAREHOUSE.tables:
    QUERIES[f"load_{_table}"] = partial(_raw, _table)
for _table in BANKING.tables:
    QUERIES[f"load_banking_{_table}"] = partial(_raw_banking, _table)


@query
def truncate_load(spark, sf_dir):
    """Two loads on two dates leave the second only."""
    job = _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE), ["orders"])
    replace(job, run=SECOND).execute(["orders"], create=False)
    return _loaded(job, "orders")


def _after_repair(job: Ingest, table: str) -> DataFrame:
    """What readers see, also once the catalog looked for folders it does not know."""
    job.spark.sql(f"MSCK REPAIR TABLE {table_name(job.namespace, table)}")
    return _loaded(job, table)


@query
def failed_rerun(spark, sf_dir):
    """A run tried again that fails while it writes leaves its published rows."""
    job = _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE), ["orders"])
    price = F.when(F.col("o_orderstatus") == "P", F.lit(float("inf"))).otherwise(F.col("o_totalprice"))
    bad = job.source.read(WAREHOUSE["orders"]).withColumn("o_totalprice", price)
    replace(job, source=FrameSource({"orders": bad})).execute(["orders"], create=False, fail=False)
    return _after_repair(job, "orders")


class _Overcounted(ParquetSource):
    """Counts a row more than it has."""

    def count(self, table: str) -> int:
        return super().count(table) + 1


@query
def strict_refusal(spark, sf_dir):
    """A batch refused for its count is not in the table, nor in a folder that a repair would add."""
    job = _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE), ["orders"])
    strict = replace(job, source=_Overcounted(spark, sf_dir), strict=True, run=SECOND)
    strict.execute(["orders"], create=False, fail=False)
    return _after_repair(job, "orders")


@query
def mismatch_audit(spark, sf_dir):
    """Without ``strict`` the batch is loaded and the audit says that counts differ."""
    job = _job(spark, _Overcounted(spark, sf_dir), WAREHOUSE)
    return read_audit(spark, _load(job, ["orders"]).namespace).select(_AUDIT)


@query
def half_truncation(spark, sf_dir):
    """A truncating load that dies: before its switch the old rows are read, after it the new, never both."""
    job = _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE), ["orders"])
    contract, table = WAREHOUSE["orders"], table_name(job.namespace, "orders")
    rows = with_lineage(conform(job.source.read(contract), contract), SECOND)
    announce(spark, table, SECOND, write_batch(spark, rows, contract, job.namespace, SECOND).folder)
    before = _loaded(job, "orders")
    switch(spark, table, SECOND)
    return before.unionByName(_loaded(job, "orders"))


def _appended(spark, sf_dir) -> Ingest:
    job = _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE, mode="append"), ["orders"])
    replace(job, run=SECOND).execute(["orders"], create=False)
    return job


@query
def append_load(spark, sf_dir):
    """Two loads leave every row twice, under two batch ids."""
    return _loaded(_appended(spark, sf_dir), "orders")


@query
def read_by_ingest_time(spark, sf_dir):
    """Bounds on the ingest instant open only the dates they touch."""
    return _loaded(_appended(spark, sf_dir), "orders", since=SECOND.ingested_at)


@query
def read_by_batch(spark, sf_dir):
    return _loaded(_appended(spark, sf_dir), "orders", batches=[FIRST.run_id])


@query
def clustered_load(spark, sf_dir):
    """Rows per file are narrow key ranges; the rows are the source's."""
    job = _job(spark, ParquetSource(spark, sf_dir), WAREHOUSE, cluster_files=4)
    return (
        _loaded(_load(job, ["orders"]), "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum("o_totalprice").alias("o_totalprice"),
            F.max("o_orderdate").alias("last_order"),
        )
    )


@query
def lookup_files(spark, sf_dir):
    """Whether look-ups by either key open less than half of the files: clustered by the first, and interleaved."""
    found = []
    for layout in ("clustered", "interleaved"):
        orders = replace(WAREHOUSE["orders"], references=(), interleaved=layout == "interleaved")
        job = _job(spark, ParquetSource(spark, sf_dir), Registry(layout, (orders,)), cluster_files=64)
        df = _loaded(_load(job, ["orders"]), "orders")
        rows = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("o_totalprice"))
        for key in orders.cluster:
            found.append(
                files_opened(df, key)
                .unionByName(rows, allowMissingColumns=True)
                .agg(
                    F.lit(layout).alias("layout"),
                    F.lit(key).alias("key"),
                    F.sum("n_rows").alias("n_rows"),
                    F.sum("o_totalprice").alias("o_totalprice"),
                    F.sum("n_values").alias("n_values"),
                    (F.sum("n_opened") * 2 < F.sum("n_values") * F.sum("n_files")).alias("narrow"),
                )
            )
    return reduce(DataFrame.unionByName, found)


# --- table definition ---


@query
def table_columns(spark, sf_dir):
    """Type and comment of each created column of all tables, with the values it holds after a load."""
    frames = FrameSource(banking_frames(spark, sf_dir))
    jobs = [
        _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE, concurrency=4), WAREHOUSE.tables),
        _load(_job(spark, frames, BANKING, concurrency=4), BANKING.tables),
    ]
    described, held = [], []
    for job in jobs:
        for contract in job.registry:
            df = _loaded(job, contract.name)
            counted = df.agg(*(F.count(c).alias(c) for c in df.columns))
            held.append(
                counted.unpivot([], df.columns, "column_name", "n_values").withColumn("table_name", F.lit(contract.name))
            )
            described.append(describe_columns(spark, job.namespace, contract))
    listed = _union(described).select("table_name", "column_name", "data_type", "comment")
    return listed.join(_union(held), ["table_name", "column_name"])


@query
def default_ingested_at(spark, sf_dir):
    """An SQL insert that leaves out the ingest time gets it from the table's default."""
    job = _job(spark, ParquetSource(spark, sf_dir), WAREHOUSE)
    create_tables(spark, job.namespace, WAREHOUSE, job.location, ["orders"])
    contract = WAREHOUSE["orders"]
    named = [*contract.column_names, "_source_system", "_ingestion_batch_id"]
    spark.sql(
        f"INSERT INTO {table_name(job.namespace, 'orders')} ({', '.join(named)}) SELECT {{rows}}.* FROM {{rows}}",
        rows=with_lineage(conform(job.source.read(contract), contract), FIRST).select(named),
    )
    return _loaded(job, "orders").select(
        *contract.column_names,
        (F.col("_ingested_at") <= F.current_timestamp()).alias("stamped"),
        "_source_system",
        "_ingestion_batch_id",
    )


# --- counts, reconciliation, audit ---


@query
def observed_counts(spark, sf_dir):
    """Rows counted while writing beside rows found in the table afterwards."""
    tables = WAREHOUSE.tables
    job = _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE), tables)
    observed = read_audit(spark, job.namespace).select("table_name", "loaded_rows")
    found = counts({t: _loaded(job, t, batches=[FIRST.run_id]) for t in tables}, "target_rows")
    return observed.join(found, "table_name", "full_outer")


@query
def reconcile_counts(spark, sf_dir):
    """Counts that differ, agree, and have no counterpart."""
    source = _warehouse(spark, sf_dir)
    held = {t: df for t, df in source.items() if t != "events"}
    held["orders"] = held["orders"].where("o_orderstatus <> 'P'")
    return reconcile(counts(source), counts(held))


_AUDIT = ["ord", "table_name", "source_rows", "loaded_rows", "n_columns", "status", "matched"]


@query
def full_load_audit(spark, sf_dir):
    job = _job(spark, ParquetSource(spark, sf_dir), WAREHOUSE, concurrency=4)
    return job.execute().select(_AUDIT)


@query
def full_load_banking_audit(spark, sf_dir):
    job = _job(spark, FrameSource(banking_frames(spark, sf_dir)), BANKING, concurrency=4)
    return job.execute().select(_AUDIT)


@query
def dry_run_audit(spark, sf_dir):
    """Every table is read and conformed; no table is made."""
    job = _job(spark, ParquetSource(spark, sf_dir), WAREHOUSE, concurrency=4)
    audit = job.check()
    made = spark.catalog.databaseExists(job.namespace)
    return audit.select(*_AUDIT, F.lit(made).alias("target_made"))


@query
def subset_load_audit(spark, sf_dir):
    """Tables created beforehand; two of them loaded, in the order given."""
    job = _job(spark, ParquetSource(spark, sf_dir), WAREHOUSE)
    job.create()
    return job.execute("orders, customer", create=False).select(_AUDIT)


def _one_broken(spark, sf_dir) -> Ingest:
    """A job whose ``orders`` lack a column and whose list names an unknown table."""
    frames = {c.name: ParquetSource(spark, sf_dir).read(c) for c in WAREHOUSE}
    frames["orders"] = frames["orders"].drop("o_totalprice")
    return _job(spark, FrameSource(frames), WAREHOUSE)


_SOME = ["customer", "orders", "no_such_table", "lineitem"]


@query
def failure_isolation_audit(spark, sf_dir):
    """Tables that fail do not stop the others."""
    audit = _one_broken(spark, sf_dir).execute(_SOME, fail=False)
    told = F.regexp_extract("error", r"missing: (\w+)|'(\w+)' is not a table", 0)
    return audit.select(*_AUDIT, F.nullif(told, F.lit("")).alias("told"))


@query
def run_totals(spark, sf_dir):
    """Totals of a run with failures, and the tables to run again."""
    job = _one_broken(spark, sf_dir)
    job.execute(_SOME, fail=False)
    audit = read_audit(spark, job.namespace)
    return totals(audit).join(failed_tables(audit), "run_id", "left")


@query
def rerun_failed(spark, sf_dir):
    """The failed table alone is loaded again, from a mended source."""
    job = _one_broken(spark, sf_dir)
    job.execute(["customer", "orders", "lineitem"], fail=False)
    mended = replace(job, source=ParquetSource(spark, sf_dir), run=SECOND)
    mended.execute(last_failed(spark, job.namespace))
    return read_audit(spark, job.namespace).select("run_id", *_AUDIT)


# --- extensions ---


@query
def incremental_load(spark, sf_dir):
    """What was known at a cutoff, then what changed since: every row once."""
    orders = ParquetSource(spark, sf_dir).read(WAREHOUSE["orders"])
    known = FrameSource({"orders": orders.where(F.col("o_orderdate") <= F.lit(CUTOFF))})
    job = _load(_job(spark, known, WAREHOUSE, mode="incremental"), ["orders"])
    replace(job, source=ParquetSource(spark, sf_dir), run=SECOND).execute(["orders"], create=False)
    return _loaded(job, "orders")


@query
def content_audit(spark, sf_dir):
    """Loads whose counts and totals agree although two amounts were swapped, a row was lost and another doubled."""
    orders = ParquetSource(spark, sf_dir).read(WAREHOUSE["orders"])
    job = _load(_job(spark, FrameSource({"orders": orders}), WAREHOUSE), ["orders"])
    price = (
        F.when(F.col("o_orderkey") % 100 == 1, F.col("o_totalprice") + 1000)
        .when(F.col("o_orderkey") % 100 == 2, F.col("o_totalprice") - 1000)
        .otherwise(F.col("o_totalprice"))
    )
    copies = F.when(F.col("o_orderkey") % 100 == 3, 0).when(F.col("o_orderkey") % 100 == 4, 2).otherwise(1)
    tampered = orders.withColumn("o_totalprice", price).withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1)))))
    tampered = tampered.where(F.col("o_orderkey") % 100 != 3).drop("copy")
    contract = WAREHOUSE["orders"]
    held = _loaded(job, "orders").select(contract.column_names)
    return differences(conform(tampered, contract), held, contract, ranges=64, leaf_rows=100)


@query
def content_of_loads(spark, sf_dir):
    """Every table with a key is loaded with the content of its source: no key differs."""
    frames = _warehouse(spark, sf_dir)
    job = _load(_job(spark, ParquetSource(spark, sf_dir), WAREHOUSE, concurrency=4), WAREHOUSE.tables)
    return _union(
        differences(frames[c.name], _loaded(job, c.name).select(c.column_names), c).agg(
            F.count(F.lit(1)).alias("n_differences")
        ).withColumn("table_name", F.lit(c.name))
        for c in WAREHOUSE
        if c.key
    )


def _swept(spark, sf_dir) -> Ingest:
    """Orders loaded, then a source from which rows vanished and others changed without a new date, swept."""
    orders = ParquetSource(spark, sf_dir).read(WAREHOUSE["orders"])
    job = _load(_job(spark, FrameSource({"orders": orders}), WAREHOUSE, mode="incremental"), ["orders"])
    later = orders.where("o_orderkey % 7 <> 0").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 11 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    )
    changed = replace(job, source=FrameSource({"orders": later}), run=SECOND)
    # An increment by date finds neither, but for rows at the mark itself.
    changed.execute(["orders"], create=False)
    replace(changed, run=THIRD).sweep(["orders"])
    return changed


@query
def swept_rows(spark, sf_dir):
    """Rows that vanished are gone from the current state, changed ones are new in it."""
    return read_current(spark, _swept(spark, sf_dir).namespace, WAREHOUSE["orders"])


@query
def vanished_keys(spark, sf_dir):
    return vanished(spark, WAREHOUSE["orders"], _swept(spark, sf_dir).namespace)


@query
def dedup_latest(spark, sf_dir):
    contract = WAREHOUSE["lineitem"]
    return latest(_warehouse(spark, sf_dir)["lineitem"], list(contract.key), ["l_shipdate"])


def _standardised(spark, sf_dir):
    """Customers as untidy text: padding, blanks, and balances that are no numbers."""
    customer = ParquetSource(spark, sf_dir).read(WAREHOUSE["customer"])
    untidy = customer.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.when(F.col("c_nationkey") == 7, F.lit(" ")).otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a"))
        .otherwise(F.col("c_acctbal").cast("string"))
        .alias("c_acctbal"),
        F.lower("c_mktsegment").alias("c_mktsegment"),
    )
    return standardise(untidy, WAREHOUSE["customer"], upper=["c_mktsegment"])


@query
def standardise_accepted(spark, sf_dir):
    return accepted(_standardised(spark, sf_dir))


@query
def standardise_rejected(spark, sf_dir):
    return rejected(_standardised(spark, sf_dir)).withColumn("_rejected", F.concat_ws(",", "_rejected"))


@query
def quality_nulls(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    return _union(quality.nulls(frames[c.name], c) for c in BANKING if c.required)


@query
def quality_rules(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    return _union(quality.rule_breaches(frames[c.name], c) for c in BANKING if c.rules)


@query
def quality_keys(spark, sf_dir):
    return quality.repeated_keys(_warehouse(spark, sf_dir)["lineitem"], WAREHOUSE["lineitem"])


@query
def quality_all_keys(spark, sf_dir):
    """Every key of every table; banking keys are unique, line numbers are not everywhere."""
    frames = _banking(spark, sf_dir) | _warehouse(spark, sf_dir)
    return _union(
        quality.repeated_keys(frames[c.name], c).select(
            F.lit(c.name).alias("table_name"), F.concat_ws("|", *c.key).alias("key"), "n_rows"
        )
        for c in [*BANKING, *WAREHOUSE]
        if c.key
    )


@query
def quality_orphans(spark, sf_dir):
    """The fifteen references between the banking tables."""
    return quality.orphans(_banking(spark, sf_dir), BANKING)


@query
def status_chain(spark, sf_dir):
    breaks = chain_breaks(_banking(spark, sf_dir)["transaction_status_history"])
    return breaks.select("transaction_id", "event_id", "event_time", "old_status", "new_status", "expected_status")


@query
def currency_round(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    amounts = ["amount", "fee_amount"]
    rounded = round_to_currency(frames["transactions"], frames["currencies"], amounts)
    return rounded.select("transaction_id", "currency_code", *amounts)


@query
def transaction_summary(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    return summaries.transaction_summary(
        frames["transactions"], frames["transaction_types"], frames["channels"], "month"
    )


@query
def branch_balances(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    return summaries.branch_balances(frames["accounts"], frames["branches"])


@query
def customer_balances(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    return summaries.customer_balances(frames["accounts"], frames["customers"])


class _DiesTwice(Landing):
    """Dies once with its second batch written and not published, and once right after its third is published."""

    died: set[str] = set()

    def _once(self, number: int, wanted: int) -> None:
        if number == wanted and f"{self.checkpoint}{number}" not in self.died:
            self.died.add(f"{self.checkpoint}{number}")
            raise InterruptedError(f"batch {number}")

    def _written(self, number: int) -> None:
        self._once(number, 1)

    def _load(self, rows: DataFrame, number: int) -> None:
        super()._load(rows, number)
        self._once(number, 2)


@query
def streamed_load(spark, sf_dir):
    """Files that arrive in turns are streamed into a table; the stream dies twice and is resumed: every row once."""
    orders = ParquetSource(spark, sf_dir).read(WAREHOUSE["orders"])
    place = f"{shared_folder(spark)}/landing_{uuid.uuid4().hex}"
    landing = _DiesTwice(
        spark, f"{place}/files", WAREHOUSE["orders"], f"raw_{uuid.uuid4().hex}", f"{place}/done", f"{place}/table", files_per_batch=1
    )
    for arrival in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == arrival).repartition(2).write.mode("append").parquet(landing.folder)
        for _ in range(3):
            with suppress(StreamingQueryException):
                landing.run()
    return read_table(spark, landing.namespace, landing.contract).select(landing.contract.column_names)


@query
def widened_load(spark, sf_dir):
    """A table made before its contract had the priority takes it; the rows it had are null there."""
    source, contract = ParquetSource(spark, sf_dir), WAREHOUSE["orders"]
    older = replace(contract, references=(), columns=tuple(c for c in contract.columns if c.name != "o_orderpriority"))
    orders = source.read(contract)
    before = FrameSource({"orders": orders.drop("o_orderpriority")})
    job = _load(_job(spark, before, Registry("older", (older,)), mode="append"), ["orders"])
    replace(job, source=source, registry=WAREHOUSE, run=SECOND).execute(["orders"], create=False)
    return read_table(spark, job.namespace, contract)


def _in_two_batches(
    spark, sf_dir, table: str, between: Callable[[Ingest], object] = lambda job: None, **wrong: str
) -> Ingest:
    """A banking table appended in two batches, of which the second mends and completes the first.

    The first lacks every third key, and every fifth has another value in some columns.
    """
    contract, frame = BANKING[table], banking_frames(spark, sf_dir)[table]
    key = F.col(contract.key[0])
    first = frame.where(key % 3 != 0).withColumns(
        {c: F.when(key % 5 == 0, F.expr(e)).otherwise(F.col(c)) for c, e in wrong.items()}
    )
    second = frame.where((key % 3 == 0) | (key % 5 == 0))
    job = _load(_job(spark, FrameSource({table: first}), BANKING, mode="append"), [table])
    between(job)
    replace(job, source=FrameSource({table: second}), run=SECOND).execute([table], create=False)
    return job


def _kept_up(spark, sf_dir, rollup: rollups.Rollup, **wrong: str) -> DataFrame:
    """The rollup of two batches, refreshed after each, and after the first was loaded again."""

    def refreshed(job: Ingest) -> list[str]:
        return rollups.refresh(spark, job.namespace, rollup)

    job = _in_two_batches(spark, sf_dir, rollup.facts.name, refreshed, **wrong)
    refreshed(job)
    replace(job).execute([rollup.facts.name], create=False)
    refreshed(job)
    return rollups.summary(spark, job.namespace, rollup)


@query
def kept_transaction_summary(spark, sf_dir):
    """The summary from stored partials, though facts were appended late and changed their group and amount."""
    frames = _banking(spark, sf_dir)
    sums = _kept_up(
        spark, sf_dir, summaries.transactions_by("month"), amount="amount + 7", status="'PENDING'", fee_amount="NULL"
    )
    return summaries.transaction_sums(sums, frames["transaction_types"], frames["channels"])


@query
def kept_branch_balances(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    sums = _kept_up(spark, sf_dir, summaries.ACCOUNTS_BY_BRANCH, current_balance="current_balance * 2", branch_id="1")
    return summaries.branch_sums(sums, frames["branches"])


@query
def kept_customer_balances(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    sums = _kept_up(spark, sf_dir, summaries.ACCOUNTS_BY_CUSTOMER, customer_id="1")
    return summaries.customer_sums(sums, frames["customers"])


@query
def appended_branch_balances(spark, sf_dir):
    """Accounts that two batches hold count once, as the last batch has them."""
    job = _in_two_batches(spark, sf_dir, "accounts", current_balance="0")
    return summaries.branch_balances(_loaded(job, "accounts"), _banking(spark, sf_dir)["branches"])


@query
def appended_transaction_summary(spark, sf_dir):
    frames = _banking(spark, sf_dir)
    job = _in_two_batches(spark, sf_dir, "transactions", amount="0")
    return summaries.transaction_summary(
        _loaded(job, "transactions"), frames["transaction_types"], frames["channels"], "month"
    )


def _union(parts) -> DataFrame:
    result, *others = parts
    for part in others:
        result = result.unionByName(part)
    return result


def _run(function: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    return printable(function(engine_session(spark), sf_dir))


def registered() -> dict[str, Query]:
    return {name: partial(_run, function) for name, function in QUERIES.items()}


__all__ = ["CUTOFF", "FIRST", "SECOND", "SOURCE_SYSTEM", "THIRD", "registered"]
