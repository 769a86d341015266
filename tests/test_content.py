"""Content compared by digests, and sweeps that use it."""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quayside.contracts import ContractError, Registry, TableContract, columns
from quayside.operators.current import read_current, vanished
from quayside.operators.digests import Differing, differences, differing_ranges, position
from quayside.plans.audit import read_audit
from quayside.plans.job import Ingest
from quayside.sources import FrameSource
from runs import run_on

NUMBERED = TableContract("numbered", columns("k bigint\nv string?\nw string?\nxs array<float>?\nat timestamp?"), key=("k",), modified="at")
NAMED = TableContract("named", columns("a string\nb string?\nv bigint?"), key=("a", "b"), modified=None)
KINDS = "k bigint, v string, w string, xs array<float>, at timestamp"


def brute(left, right, width):
    sides = [Counter(), Counter()]
    for rows, side in zip((left, right), sides):
        for r in rows:
            side[tuple(map(str, r))] += 1
    keys = [{}, {}]
    for side, by_key in zip(sides, keys):
        for row, n in side.items():
            by_key.setdefault(row[:width], Counter())[row] = n
    out = []
    for key in keys[0].keys() | keys[1].keys():
        a, b = keys[0].get(key, Counter()), keys[1].get(key, Counter())
        if a != b:
            kind = "missing" if not b else "extra" if not a else "changed"
            out.append((*key, kind, sum(a.values()), sum(b.values())))
    return sorted(out)


def found(left, right, contract, **options):
    rows = differences(left, right, contract, **options).collect()
    width = len(contract.key)
    return sorted((*map(str, r[:width]), *r[width:]) for r in rows)


@pytest.mark.parametrize("ranges,leaf_rows", [(1024, 100_000), (8, 1), (64, 5)])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_comparison_row_by_row(spark, seed, ranges, leaf_rows):
    rng = random.Random(seed)
    left = [(rng.choice([i, i * 1_000_003 - 10**9]), rng.choice("ab"), None, [1.0, None], None) for i in range(400)]
    left += [(None, "x", None, None, None), (-(2**63), "low", None, [], None), (2**63 - 1, "high", None, None, None)]
    right = [r for r in left if rng.random() > 0.02]
    right += [(r[0], r[2], r[1], *r[3:]) for r in rng.sample(left, 5)] + rng.sample(left, 5) + [(None, "y", None, None, None)]
    right += [(77_777 + i, "new", "w", [None, 1.0], None) for i in range(3)]
    if seed == 2:
        left = [(r[0] if r[0] is None or abs(r[0]) < 2**60 else 5, *r[1:]) for r in left]
        right = [(r[0] if r[0] is None or abs(r[0]) < 2**60 else 5, *r[1:]) for r in right]
    dfs = [spark.createDataFrame(rows, KINDS).repartition(4) for rows in (left, right)]
    got = found(*dfs, NUMBERED, ranges=ranges, leaf_rows=leaf_rows)
    assert got == brute(left, right, 1)
    assert {r[1] for r in got} == {"missing", "extra", "changed"}


def test_text_keys_and_nulls(spark):
    left = [(f"k{i}", None if i % 3 else "b", i) for i in range(200)] + [("dup", None, None)] * 3
    right = [r if r[2] != 50 else (r[0], r[1], 51) for r in left[:-1]]
    dfs = [spark.createDataFrame(rows, "a string, b string, v bigint") for rows in (left, right)]
    assert found(*dfs, NAMED) == brute(left, right, 2)
    assert found(dfs[0], dfs[0].repartition(3), NAMED) == []
    assert found(dfs[0].limit(0), dfs[0].limit(0), NAMED) == []
    assert len(found(dfs[0], dfs[0].limit(0), NAMED)) == 201


def test_tables_without_a_key_are_refused(spark):
    with pytest.raises(ContractError):
        position(replace(NAMED, key=()))


def test_only_differing_ranges_are_read(spark, place):
    """A million rows, three of them changed: the filter of the second reading leaves almost all files' rows out."""
    rows = spark.range(0, 1_000_000, 1, 20).select(
        F.col("id").alias("k"), F.lit("v").alias("v"), F.lit(None).cast("string").alias("w"),
        F.lit(None).cast("array<float>").alias("xs"), F.lit(None).cast("timestamp").alias("at"),
    )
    other = rows.withColumn("v", F.when(F.col("k").isin(5, 400_000, 999_999), "u").otherwise(F.col("v")))
    where = differing_ranges(rows, other, NUMBERED, ranges=256, leaf_rows=1000)
    assert where and len(where.ranges) == 3
    assert rows.where(where.holds(F.col("k"))).count() < 3000
    path = f"{place[1]}/rows"
    rows.write.parquet(path)
    plan = spark.read.parquet(path).where(where.holds(F.col("k")))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
    assert not differing_ranges(rows, rows.repartition(7), NUMBERED)


def test_runs_of_ranges():
    assert Differing(10, (-2, -1, 0, 5), False).ranges == [(-20, 9), (50, 59)]
    assert not Differing(10, (), False) and Differing(10, (), True)


REGISTRY = Registry("swept", (NUMBERED,))


def test_sweeps_repeat_until_nothing_differs(spark, place):
    def source(rows):
        return FrameSource({"numbered": spark.createDataFrame(rows, KINDS)})

    def row(k, v):
        return (k, v, None, None, None)

    def now(day, rows):
        audit = Ingest(spark, source(rows), REGISTRY, *place, run=run_on(day)).sweep()
        held = read_current(spark, place[0], NUMBERED).select("k", "v").collect()
        return sorted(map(tuple, held)), audit.first()["matched"], audit.first()["mode"]

    first = [row(i, "a") for i in range(20)]
    Ingest(spark, source(first), REGISTRY, *place, mode="append", run=run_on(1)).execute()
    assert now(2, first) == ([(i, "a") for i in range(20)], True, "sweep")
    fewer = [row(i, "b" if i == 3 else "a") for i in range(5)]
    assert now(3, fewer) == ([(r[0], r[1]) for r in fewer], False, "sweep")
    assert vanished(spark, NUMBERED, place[0]).count() == 15
    # A key that is back counts again, also with its old values.
    assert now(4, first) == ([(i, "a") for i in range(20)], False, "sweep")
    assert now(5, first)[1]
    assert read_audit(spark, place[0]).where("mode = 'sweep'").count() == 4
    assert now(6, []) == ([], False, "sweep")
