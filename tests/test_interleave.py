"""Files narrow in several keys: what look-ups open, and that no row is lost."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runs import run_on
from quayside.contracts import ContractError, Registry, TableContract, columns
from quayside.operators.interleave import curve, files_opened
from quayside.operators.layout import spread
from quayside.operators.sinks import read_table
from quayside.plans.job import Ingest
from quayside.sources import FrameSource

VISITS = TableContract(
    "visits",
    columns("id bigint\nwho string?\nat timestamp?\nupdated_at timestamp"),
    key=("id",),
    cluster=("who", "at"),
)


def visits(spark, n=20_000):
    """Names that share their start, and times that have nothing to do with them; some are null."""
    name, second = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2_000)), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(500_000))
    return spark.range(0, n, 1, 6).select(
        "id",
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("CUSTOMER-"), F.lpad(name.cast("string"), 8, "0"))).alias("who"),
        F.when(F.col("id") % 70 != 0, F.timestamp_seconds(second)).alias("at"),
        F.timestamp_seconds("id").alias("updated_at"),
    )


def loaded(spark, place, contract, df, files=16):
    job = Ingest(spark, FrameSource({"visits": df}), Registry("visits", (contract,)), *place, run=run_on(1), cluster_files=files)
    assert job.execute().first()["matched"]
    return read_table(spark, place[0], contract)


def share(df, key):
    row = files_opened(df, key, 4).first()
    return row["n_opened"] / (row["n_values"] * row["n_files"])


def test_interleaved_files_are_narrow_in_both_keys(spark, place):
    df = visits(spark)
    found = loaded(spark, place, replace(VISITS, interleaved=True), df, files=64)
    assert found.select(df.columns).exceptAll(df).isEmpty() and found.count() == df.count()
    # Aligned with the shares it is 1/8; files whose borders lie elsewhere on the curve are wider.
    assert share(found, "who") < 0.3
    assert share(found, "at") < 0.3


def test_clustered_files_are_narrow_in_the_first_key_only(spark, place):
    found = loaded(spark, place, VISITS, visits(spark))
    assert share(found, "who") < 0.15
    assert share(found, "at") > 0.9


def test_files_opened_equals_counting_each_value_in_each_file(spark, place):
    found = loaded(spark, place, replace(VISITS, interleaved=True), visits(spark, 700), files=8)
    for key in VISITS.cluster:
        rows = found.select(F.input_file_name().alias("file"), key).where(F.col(key).isNotNull()).collect()
        ends = {}
        for file, value in rows:
            lo, hi = ends.get(file, (value, value))
            ends[file] = min(lo, value), max(hi, value)
        values = {value for _, value in rows}
        opened = sum(lo <= v <= hi for v in values for lo, hi in ends.values())
        assert tuple(files_opened(found, key, 3).first()) == (len(values), len(ends), opened)


def test_places_follow_every_key(spark):
    """With the other keys fixed, a greater value never has a smaller place; null is first."""
    kinds = [T.LongType(), T.DateType(), T.DecimalType(18, 2), T.BooleanType()]
    df = spark.range(1_000).select(
        F.when(F.col("id") > 0, F.col("id") - 500).alias("n"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("d"),
        (F.col("id") / 7).cast("decimal(18,2)").alias("m"),
        (F.col("id") % 2 == 0).alias("b"),
    )
    for name, kind in zip(df.columns, kinds):
        place = curve(df, [F.col(name)], [kind], 8)
        found = df.select(name, place([F.col(name)]).alias("place")).orderBy(F.col(name).asc_nulls_first()).collect()
        places = [r["place"] for r in found]
        assert places == sorted(places)
        assert places[0] == 0 and len(set(places)) == min(128, df.select(name).distinct().count())


def test_empty_tables_and_tables_of_nulls(spark, place):
    none = visits(spark).where("false")
    contract = replace(VISITS, interleaved=True)
    found = loaded(spark, place, contract, none)
    assert found.count() == 0
    assert files_opened(found, "who", 2).first()["n_values"] == 0
    nulls = visits(spark, 100).withColumn("who", F.lit(None).cast("string")).withColumn("at", F.lit(None).cast("timestamp"))
    place = curve(nulls, [F.col("who"), F.col("at")], [T.StringType(), T.TimestampType()], 4)
    assert {r[0] for r in nulls.select(place([F.col("who"), F.col("at")])).collect()} == {0}


def test_a_hot_row_is_split(spark):
    """A third of the rows are one row; no file may get them all."""
    df = spark.range(0, 60_000, 1, 48).select(
        *(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("id", F.lit(i))).alias(f"k{i}") for i in (1, 2))
    )
    keys = [F.col("k1"), F.col("k2")]
    place = curve(df, keys, [T.LongType()] * 2, 12)
    sizes = [r["count"] for r in spread(df, [place(keys)], 12).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000
    assert max(sizes) < 2 * 60_000 / 12


def test_one_key_cannot_be_interleaved():
    with pytest.raises(ContractError, match="interleaved"):
        replace(VISITS, cluster=("who",), interleaved=True)
