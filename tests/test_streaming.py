"""Streams into tables, and tables of older contracts."""

from __future__ import annotations

import uuid
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quayside.contracts import Registry, TableContract, columns
from quayside.operators.current import read_current
from quayside.operators.drift import EXTRA, MISSING, OTHER_COMMENT, OTHER_TYPE, ContractDrift, drift, widen
from quayside.operators.sinks import read_table
from quayside.plans.audit import read_audit
from quayside.plans.job import Ingest, IngestFailed
from quayside.sources import FrameSource
from quayside.streaming.landing import Landing
from runs import run_on

ITEMS = TableContract("items", columns("id bigint\nv string?\nat timestamp?"), key=("id",), modified="at")


def arrive(spark, landing, ids, v="a"):
    rows = [(i, v) for i in ids]
    df = spark.createDataFrame(rows, "id int, v string").withColumn("at", F.timestamp_seconds("id"))
    df.coalesce(1).write.mode("append").parquet(landing.folder)


def landing_in(spark, place, kind=Landing, **options):
    own = f"{place[1]}/{uuid.uuid4().hex}"
    return kind(spark, f"{own}/files", ITEMS, place[0], f"{own}/checkpoint", place[1], files_per_batch=1, **options)


def held(spark, place):
    return sorted(r["id"] for r in read_table(spark, place[0], ITEMS).collect())


def test_files_are_loaded_once_and_updates_are_the_latest(spark, place):
    landing = landing_in(spark, place)
    arrive(spark, landing, range(5))
    arrive(spark, landing, range(5, 9))
    assert landing.run() == 2
    assert landing.run() == 0
    arrive(spark, landing, range(3), "b")
    assert landing.run() == 1
    assert held(spark, place) == sorted([*range(9), *range(3)])
    now = {r["id"]: r["v"] for r in read_current(spark, place[0], ITEMS).collect()}
    assert now == {i: "b" if i < 3 else "a" for i in range(9)}
    audit = read_audit(spark, place[0])
    assert sorted(r["loaded_rows"] for r in audit.where("mode = 'stream'").collect()) == [3, 4, 5]
    assert audit.agg(F.max("high_water")).first()[0] == 8_000_000


class Dies(Landing):
    """Dies where it is told to, each time once."""

    at: set = set()

    def die(self, step, number):
        if (step, number) in self.at:
            self.at.discard((step, number))
            raise InterruptedError(f"{step} {number}")

    def _written(self, number):
        self.die("written", number)

    def _load(self, rows, number):
        super()._load(rows, number)
        self.die("published", number)


@pytest.mark.parametrize("step", ["written", "published"])
def test_a_stream_that_dies_goes_on(spark, place, step):
    landing = landing_in(spark, place, Dies)
    Dies.at = {(step, 1)}
    for k in range(3):
        arrive(spark, landing, range(10 * k, 10 * k + 4))
    with pytest.raises(StreamingQueryException):
        landing.run()
    assert len(held(spark, place)) == (4 if step == "written" else 8)
    landing.run()
    assert held(spark, place) == [10 * k + i for k in range(3) for i in range(4)]


def test_a_new_checkpoint_is_another_stream(spark, place):
    for k in (1, 2):
        landing = landing_in(spark, place)
        arrive(spark, landing, range(k))
        assert landing.run() == 1
    assert held(spark, place) == [0, 0, 1]


def registry(contract):
    return Registry("items", (contract,))


def load(spark, place, contract, day, df):
    job = Ingest(spark, FrameSource({"items": df}), registry(contract), *place, mode="append", run=run_on(day))
    return job.execute()


def test_an_older_table_takes_new_columns_and_comments(spark, place):
    load(spark, place, ITEMS, 1, spark.createDataFrame([(1, "a", None)], "id long, v string, at timestamp"))
    wider = replace(ITEMS, columns=columns("id bigint\nprice decimal(18,2)?\nv string? -- noted\nat timestamp?"))
    assert drift(spark, place[0], wider) == [("price", MISSING), ("v", OTHER_COMMENT)]
    df = spark.createDataFrame([(2, 1.5, "b", None)], "id long, price double, v string, at timestamp")
    load(spark, place, wider, 2, df)
    assert drift(spark, place[0], wider) == []
    rows = read_table(spark, place[0], wider).orderBy("id").collect()
    assert [(r["id"], None if r["price"] is None else str(r["price"]), r["v"]) for r in rows] == [(1, None, "a"), (2, "1.50", "b")]
    # The older contract still reads and loads; the column it does not know is null in its batch.
    assert drift(spark, place[0], ITEMS) == [("v", OTHER_COMMENT), ("price", EXTRA)]
    load(spark, place, ITEMS, 3, spark.createDataFrame([(3, "c", None)], "id long, v string, at timestamp"))
    assert read_table(spark, place[0], wider).where("price IS NULL").count() == 2


def test_another_type_is_refused_and_changes_nothing(spark, place):
    df = spark.createDataFrame([(1, "a", None)], "id long, v string, at timestamp")
    load(spark, place, ITEMS, 1, df)
    other = replace(ITEMS, columns=columns("id bigint\nextra string?\nv bigint?\nat timestamp?"))
    assert ("v", OTHER_TYPE) in drift(spark, place[0], other)
    with pytest.raises(ContractDrift):
        widen(spark, place[0], other)
    with pytest.raises(IngestFailed):
        load(spark, place, other, 2, spark.createDataFrame([(2, None, 5, None)], "id long, extra string, v long, at timestamp"))
    assert drift(spark, place[0], ITEMS) == []
    assert held(spark, place) == [1]
