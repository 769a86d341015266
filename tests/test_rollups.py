"""Summaries kept up batch by batch against ones made anew, and folders of loads that failed."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.contracts import Registry, TableContract, columns
from quayside.operators import sinks
from quayside.operators.rollups import Rollup, current_facts, refresh, summary
from quayside.operators.sinks import clear_dead_batches, read_table
from quayside.plans.job import Ingest, IngestFailed
from quayside.session import list_folders
from quayside.operators.catalog import table_location, table_name
from quayside.sources import FrameSource
from runs import run_on

FACTS = TableContract("facts", columns("id bigint\ng string?\namount decimal(18,2)?\nfee decimal(18,2)?"), key=("id",), modified=None)
REGISTRY = Registry("facts", (FACTS,))
BY_GROUP = Rollup("by_group", FACTS, {"g": "upper(g)"}, ("amount", "fee"))
KINDS = "id bigint, g string, amount decimal(18,2), fee decimal(18,2)"


def load(spark, place, day, rows, mode="append"):
    source = FrameSource({"facts": spark.createDataFrame(rows, KINDS)})
    Ingest(spark, source, REGISTRY, *place, mode=mode, run=run_on(day)).execute()


def both(spark, place):
    facts = read_table(spark, place[0], FACTS)
    anew = BY_GROUP.grouped(current_facts(facts, "id"))
    kept = summary(spark, place[0], BY_GROUP)
    return [sorted(map(tuple, df.select("g", "n", "amount", "fee").collect()), key=str) for df in (kept, anew)]


def some(rng, ids):
    def money():
        return rng.choice([None, Decimal(rng.randint(-500, 500)) / 100])

    return [(i, rng.choice(["a", "A", "b", None]), money(), money()) for i in ids]


def test_appended_changed_and_repeated_batches(spark, place):
    rng = random.Random(1)
    load(spark, place, 1, some(rng, range(40)))
    assert refresh(spark, place[0], BY_GROUP) == ["batch-1"]
    assert refresh(spark, place[0], BY_GROUP) == []
    # A fact without a key, and copies in a batch.
    load(spark, place, 2, some(rng, [*range(30, 60), None, None, 41, 41]))
    load(spark, place, 3, some(rng, range(10, 35)))
    assert refresh(spark, place[0], BY_GROUP) == ["batch-2", "batch-3"]
    kept, anew = both(spark, place)
    assert kept == anew and len(kept) == 3
    # The second batch is loaded again with other rows: it and all after it are done anew.
    load(spark, place, 2, some(rng, range(5, 12)))
    assert refresh(spark, place[0], BY_GROUP) == ["batch-2", "batch-3"]
    kept, anew = both(spark, place)
    assert kept == anew
    # An empty batch, then a truncating load that takes all others away.
    load(spark, place, 4, [])
    load(spark, place, 5, [(1, "only", None, Decimal("1.00"))], mode="truncate")
    assert refresh(spark, place[0], BY_GROUP) == ["batch-5"]
    kept, anew = both(spark, place)
    assert kept == anew == [("ONLY", 1, None, Decimal("1.00"))]


def test_a_refresh_that_died_goes_on(spark, place):
    rng = random.Random(2)
    for day in (1, 2, 3):
        load(spark, place, day, some(rng, range(day, 20 + day)))
    refresh(spark, place[0], BY_GROUP)
    name = table_name(place[0], "by_group")
    stored = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    batch, attempt = (part.split("=") for part in next(p for p in stored if p[0].endswith("batch-2")))
    spark.sql(f"ALTER TABLE {name} DROP PARTITION ({batch[0]} = '{batch[1]}', {attempt[0]} = '{attempt[1]}')")
    assert refresh(spark, place[0], BY_GROUP) == ["batch-2", "batch-3"]
    kept, anew = both(spark, place)
    assert kept == anew


def test_only_files_of_the_batch_keys_are_opened(spark, place):
    """Bounds of a batch's keys reach the scan of earlier batches."""
    load(spark, place, 1, some(random.Random(3), range(100)))
    load(spark, place, 2, some(random.Random(4), [7, 9]))
    from quayside.operators.rollups import _change

    plan = _change(BY_GROUP, read_table(spark, place[0], FACTS), "batch-2", ["batch-1"])
    assert "GreaterThanOrEqual(id,7)" in plan._jdf.queryExecution().executedPlan().toString()


def folders(spark, place):
    table = table_name(place[0], "facts")
    found = list_folders(spark, f"{table_location(spark, table)}__batches")
    return [f for f in found if list_folders(spark, f)]


def held(spark, place):
    return sorted(r["id"] for r in read_table(spark, place[0], FACTS).collect())


@pytest.mark.parametrize("step", ["_add", "announce"])
def test_a_failed_publish_leaves_no_files(spark, place, monkeypatch, step):
    load(spark, place, 1, some(random.Random(1), range(5)))

    def fails(*args):
        raise OSError("the catalog is gone")

    with monkeypatch.context() as m:
        m.setattr(sinks, step, fails)
        with pytest.raises(IngestFailed):
            load(spark, place, 2, some(random.Random(2), range(9)), mode="append" if step == "_add" else "truncate")
    assert len(folders(spark, place)) - clear_dead_batches(spark, place[0], FACTS) <= 1
    assert held(spark, place) == [0, 1, 2, 3, 4]
    parts = [f for f in folders(spark, place) if list_folders(spark, f"{f}/_ingested_date=2024-01-02")]
    assert not parts


def test_a_publish_that_failed_after_its_call_keeps_the_files(spark, place, monkeypatch):
    load(spark, place, 1, some(random.Random(1), range(5)))

    def fails(*args):
        raise OSError("too late")

    with monkeypatch.context() as m:
        m.setattr(sinks, "switch", fails)
        with pytest.raises(IngestFailed):
            load(spark, place, 2, some(random.Random(2), range(9)), mode="truncate")
    # The new batch is hidden still, and goes with the next load.
    assert held(spark, place) == [0, 1, 2, 3, 4]
    load(spark, place, 3, some(random.Random(3), range(7)), mode="truncate")
    assert held(spark, place) == list(range(7))


def test_folders_of_killed_loads_are_cleared(spark, place):
    load(spark, place, 1, some(random.Random(1), range(5)))
    load(spark, place, 2, some(random.Random(2), range(3)))
    table = table_location(spark, table_name(place[0], "facts"))
    spark.range(10).write.parquet(f"{table}__batches/left-behind/_ingested_date=2024-01-09/_ingestion_batch_id=x")
    assert clear_dead_batches(spark, place[0], FACTS) >= 1
    assert len(folders(spark, place)) == 2
    assert held(spark, place) == sorted([*range(5), *range(3)])
    assert clear_dead_batches(spark, place[0], FACTS) == 0
    assert read_table(spark, place[0], FACTS).agg(F.count("id")).first()[0] == 8
