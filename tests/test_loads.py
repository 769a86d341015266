from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from runs import run_on
from quayside.contracts import Registry, TableContract, columns
from quayside.operators import sinks
from quayside.operators.catalog import TableMissing, create_tables, describe_columns, table_location, table_name
from quayside.operators.conform import conform, with_lineage
from quayside.operators.layout import TARGET_FILE_BYTES, cluster, file_count
from quayside.operators.sinks import load, read_table, write_batch

ITEMS = TableContract(
    "items",
    columns("id bigint -- it's the key\nprice decimal(18,2)?\nupdated_at timestamp"),
    key=("id",),
    cluster=("id",),
    comment="Raw copy",
)
PACK = Registry("pack", (ITEMS,))


def items(spark, n, run):
    raw = spark.range(n).select(
        "id", (F.col("id") / 8).alias("price"), F.timestamp_seconds("id").alias("updated_at")
    )
    return with_lineage(conform(raw, ITEMS), run)


@pytest.fixture
def namespace(spark, place):
    create_tables(spark, place[0], PACK, place[1])
    return place[0]


def batches(spark, namespace):
    found = read_table(spark, namespace, ITEMS).groupBy("_ingestion_batch_id").count()
    return {r["_ingestion_batch_id"]: r["count"] for r in found.collect()}


def batch_folders(spark, namespace):
    return Path(table_location(spark, table_name(namespace, "items")).removeprefix("file:") + "__batches")


def test_truncate_replaces_every_earlier_date(spark, namespace):
    load(spark, items(spark, 5, run_on(1)), ITEMS, namespace, run_on(1), "append")
    load(spark, items(spark, 6, run_on(2)), ITEMS, namespace, run_on(2), "append")
    done = load(spark, items(spark, 4, run_on(3)), ITEMS, namespace, run_on(3), "truncate")
    assert (done.rows, done.high_water, done.unmarked) == (4, 3_000_000, 0)
    assert batches(spark, namespace) == {"batch-3": 4}
    folder = batch_folders(spark, namespace)
    assert [p.name for p in folder.rglob("_ingestion_batch_id=*")] == ["_ingestion_batch_id=batch-3"]


def test_truncate_twice_on_one_date(spark, namespace):
    for batch in ("a", "b"):
        load(spark, items(spark, 5, run_on(1, batch)), ITEMS, namespace, run_on(1, batch))
    assert batches(spark, namespace) == {"b": 5}


def test_append_keeps_both_batches(spark, namespace):
    for day in (1, 2):
        load(spark, items(spark, 5, run_on(day)), ITEMS, namespace, run_on(day), "append")
    assert batches(spark, namespace) == {"batch-1": 5, "batch-2": 5}


def test_the_same_run_again_does_not_duplicate(spark, namespace):
    for _ in range(2):
        load(spark, items(spark, 5, run_on(1)), ITEMS, namespace, run_on(1), "append")
    assert batches(spark, namespace) == {"batch-1": 5}


def test_a_written_batch_is_unseen_until_published(spark, namespace):
    load(spark, items(spark, 5, run_on(1)), ITEMS, namespace, run_on(1))
    write_batch(spark, items(spark, 9, run_on(2)), ITEMS, namespace, run_on(2))
    assert batches(spark, namespace) == {"batch-1": 5}


def test_a_failing_load_leaves_the_table(spark, namespace):
    load(spark, items(spark, 5, run_on(1)), ITEMS, namespace, run_on(1))
    bad = items(spark, 5, run_on(2)).withColumn("price", F.raise_error(F.lit("boom")).cast("decimal(18,2)"))
    with pytest.raises(Exception, match="boom"):
        load(spark, bad, ITEMS, namespace, run_on(2))
    assert batches(spark, namespace) == {"batch-1": 5}


def test_a_failing_attempt_at_a_published_run_leaves_its_rows(spark, namespace):
    load(spark, items(spark, 5, run_on(1)), ITEMS, namespace, run_on(1))
    bad = items(spark, 9, run_on(1)).withColumn(
        "price", F.when(F.col("id") == 8, F.raise_error(F.lit("boom")).cast("decimal(18,2)"))
    )
    with pytest.raises(Exception, match="boom"):
        load(spark, bad, ITEMS, namespace, run_on(1))
    spark.sql(f"MSCK REPAIR TABLE {table_name(namespace, 'items')}")
    assert batches(spark, namespace) == {"batch-1": 5}
    load(spark, items(spark, 7, run_on(1)), ITEMS, namespace, run_on(1))
    assert batches(spark, namespace) == {"batch-1": 7}
    assert len(list(batch_folders(spark, namespace).rglob("_ingestion_batch_id=*"))) == 1


@pytest.mark.parametrize("dies_in, seen", [("switch", "batch-1"), ("settle", "batch-2")])
def test_a_truncation_that_dies_shows_one_batch_and_the_next_load_ends_it(spark, namespace, monkeypatch, dies_in, seen):
    load(spark, items(spark, 5, run_on(1)), ITEMS, namespace, run_on(1))
    calls, real = [], getattr(sinks, dies_in)

    def dying(*given):
        calls.append(given)
        if dies_in == "switch" or len(calls) == 2:
            raise RuntimeError("gone")
        return real(*given)

    monkeypatch.setattr(sinks, dies_in, dying)
    with pytest.raises(RuntimeError, match="gone"):
        load(spark, items(spark, 5, run_on(2)), ITEMS, namespace, run_on(2))
    assert batches(spark, namespace) == {seen: 5}
    monkeypatch.undo()
    load(spark, items(spark, 3, run_on(3)), ITEMS, namespace, run_on(3), "append")
    assert batches(spark, namespace) == {seen: 5, "batch-3": 3}
    assert spark.table(table_name(namespace, "items")).count() == 8


def test_no_rows_is_a_load(spark, namespace):
    done = load(spark, items(spark, 0, run_on(1)), ITEMS, namespace, run_on(1))
    assert (done.rows, done.high_water) == (0, None)
    assert read_table(spark, namespace, ITEMS).schema.fieldNames() == ITEMS.loaded_schema.fieldNames()


def test_no_rows_from_a_local_frame(spark, namespace):
    empty = with_lineage(conform(spark.createDataFrame([], ITEMS.schema), ITEMS), run_on(1))
    assert load(spark, empty, ITEMS, namespace, run_on(1)).rows == 0


def test_a_missing_target_is_refused(spark, place):
    create_tables(spark, place[0], PACK, place[1])
    spark.sql(f"DROP TABLE {table_name(place[0], 'items')}")
    with pytest.raises(TableMissing):
        load(spark, items(spark, 1, run_on(1)), ITEMS, place[0], run_on(1))


def test_creating_twice_keeps_the_rows(spark, namespace, place):
    load(spark, items(spark, 5, run_on(1)), ITEMS, namespace, run_on(1))
    assert create_tables(spark, namespace, PACK, place[1]) == 2
    assert batches(spark, namespace) == {"batch-1": 5}


def test_types_and_comments_survive_the_catalog(spark, namespace):
    found = {r["column_name"]: r for r in describe_columns(spark, namespace, ITEMS).collect()}
    for field in ITEMS.loaded_schema:
        assert found[field.name]["data_type"] == field.dataType.simpleString()
        assert found[field.name]["comment"] == field.metadata["comment"]
    assert "it's the key" in found["id"]["comment"]


def test_bounds_on_the_instant_prune_dates(spark, namespace):
    for day in (1, 2, 3):
        load(spark, items(spark, 5, run_on(day)), ITEMS, namespace, run_on(day), "append")
    middle = read_table(spark, namespace, ITEMS, since=run_on(2).ingested_at, until=run_on(3).ingested_at)
    assert {r[0] for r in middle.select("_ingestion_batch_id").distinct().collect()} == {"batch-2"}
    assert {Path(f).parts[-3] for f in middle.inputFiles()} >= {"_ingested_date=2024-01-02"}
    plan = middle._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingested_date" in plan
    one = read_table(spark, namespace, ITEMS, batches=["batch-1"])
    assert one.count() == 5
    assert read_table(spark, namespace, ITEMS, except_batches=["batch-1"]).count() == 10


def file_ranges(spark, df, key, folder):
    df.write.parquet(folder)
    return (
        spark.read.parquet(folder)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        .orderBy("lo", "hi")
        .collect()
    )


def test_clustered_files_hold_narrow_ranges(spark, place):
    df = spark.range(0, 100_000, 1, 16).select(F.hash("id").cast("long").alias("k"))
    files = file_ranges(spark, cluster(df, ("k",), 8), "k", f"{place[1]}/ranges")
    assert len(files) == 8
    assert all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))


def test_a_hot_key_of_exact_copies_is_split(spark, place):
    """A third of the rows are one row; no file may get them all."""
    df = spark.range(0, 90_000, 1, 48).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.lit("same").alias("v")
    )
    files = file_ranges(spark, cluster(df, ("k",), 12), "k", f"{place[1]}/hot")
    assert sum(f["n"] for f in files) == 90_000
    assert max(f["n"] for f in files) < 2 * 90_000 / 12


def test_file_count_follows_the_size():
    assert file_count(ITEMS, 10, None) == 1
    assert file_count(ITEMS, 10, 10 * 1024**3) == 20
    assert file_count(ITEMS, 10**9, None) == 45
    assert file_count(ITEMS, 10, 10**17) == -(-(10**17) // TARGET_FILE_BYTES)
    assert file_count(ITEMS, 600_000, 10**7, cores=8) == 6
    assert file_count(ITEMS, 10**8, 10**9, cores=8000) == 16


def test_unclustered_tables_are_not_shuffled(spark):
    df = spark.range(10)
    assert cluster(df, (), 4) is df
