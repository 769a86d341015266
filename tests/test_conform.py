from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runs import run_on
from quayside.contracts import ContractError, TableContract, columns
from quayside.contracts.banking import BANKING
from quayside.operators.conform import check_columns, conform, with_lineage


def contract(text):
    return TableContract("t", columns(text), modified=None)


def cast(spark, values, source, target):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", source)]))
    return [r.x for r in conform(df, contract(f"x {target}")).collect()]


@pytest.mark.parametrize("kind", [T.DoubleType(), T.FloatType()])
def test_decimals_round_half_up_on_their_text(spark, kind):
    values = [2.675, -2.675, 1.005, 0.125, 0.0, float("nan"), None]
    wanted = ["2.68", "-2.68", "1.01", "0.13", "0.00", None, None]
    found = cast(spark, values, kind, "decimal(18,2)")
    assert found == [None if w is None else Decimal(w) for w in wanted]


@pytest.mark.parametrize(
    ("value", "kind"),
    [
        (float("inf"), T.DoubleType()),
        (float("-inf"), T.FloatType()),
        (1e17, T.DoubleType()),
        ("abc", T.StringType()),
    ],
)
def test_values_that_do_not_fit_a_decimal_fail(spark, value, kind):
    with pytest.raises(PySparkException):
        cast(spark, [value], kind, "decimal(18,2)")


def test_text_and_wider_decimals_round_half_up(spark):
    assert cast(spark, ["2.675", " 1.005 "], T.StringType(), "decimal(18,2)") == [Decimal("2.68"), Decimal("1.01")]
    assert cast(spark, [Decimal("2.6750")], T.DecimalType(20, 4), "decimal(18,2)") == [Decimal("2.68")]


def test_large_numbers_stay_exact(spark):
    assert cast(spark, [Decimal("1234567890123456.78")], T.DecimalType(18, 2), "decimal(18,2)") == [
        Decimal("1234567890123456.78")
    ]
    assert cast(spark, [9007199254740993, None], T.LongType(), "bigint") == [9007199254740993, None]


def test_integers_are_widened_and_fractions_refused(spark):
    assert cast(spark, [7, None], T.IntegerType(), "bigint") == [7, None]
    assert cast(spark, [7.0, float("nan")], T.DoubleType(), "bigint") == [7, None]
    with pytest.raises(PySparkException, match="fractional"):
        cast(spark, [7.5], T.DoubleType(), "bigint")


def test_nan_is_null_in_a_floating_column(spark):
    assert cast(spark, [float("nan"), 1.5], T.DoubleType(), "double") == [None, 1.5]


def test_times_are_instants_and_dates_are_cut_in_utc(spark):
    late = datetime(2024, 1, 1, 23, 59, 59, 999999)
    df = spark.createDataFrame([(late, late)], "at timestamp_ntz, on timestamp_ntz")
    found = conform(df, contract("at timestamp\non date"))
    assert found.schema["at"].dataType == T.TimestampType()
    row = found.select(F.unix_micros("at").alias("at"), "on").first()
    assert row["at"] == 1704153599999999
    assert row["on"] == date(2024, 1, 1)


def test_columns_are_put_in_contract_order_with_comments(spark):
    df = spark.createDataFrame([("a", 1)], "b string, a int")
    found = conform(df, contract("a bigint -- first\nb string?"))
    assert found.dtypes == [("a", "bigint"), ("b", "string")]
    assert found.schema["a"].metadata["comment"] == "first; not null in source"


def test_conform_is_idempotent(spark):
    df = spark.createDataFrame([(1, 2.675)], "a int, b double")
    wanted = contract("a bigint\nb decimal(18,2)")
    once = conform(df, wanted)
    twice = conform(once, wanted)
    assert once.schema == twice.schema
    assert once.collect() == twice.collect()


def test_drift_names_the_columns():
    with pytest.raises(ContractError, match="missing: b; extra: z, y; repeated: z"):
        check_columns(["a", "z", "z", "y"], contract("a bigint\nb bigint"))


def test_lineage_is_constant_over_the_run(spark):
    run = run_on(2)
    found = with_lineage(spark.range(5), run).select("_ingested_at", "_source_system", "_ingestion_batch_id")
    assert found.dtypes == [
        ("_ingested_at", "timestamp"),
        ("_source_system", "string"),
        ("_ingestion_batch_id", "string"),
    ]
    row = found.select(F.unix_micros("_ingested_at"), "_source_system", "_ingestion_batch_id").distinct().collect()
    assert [tuple(r) for r in row] == [(int(run.ingested_at.timestamp()) * 1_000_000, "test", "batch-2")]


def test_a_run_id_must_name_a_folder():
    with pytest.raises(ValueError, match="run id"):
        run_on(1, "a/b")


@pytest.mark.parametrize("name", BANKING.tables)
def test_every_contract_takes_its_own_nulls(spark, name):
    """A row per nullable column with that column null, and one without any null."""
    wanted = BANKING[name]
    full = {
        c.name: {
            "LongType": 1,
            "StringType": "x",
            "TimestampType": datetime(2024, 1, 1),
            "DateType": date(2024, 1, 1),
            "BooleanType": True,
            "DecimalType": Decimal("1.25"),
        }[type(c.type).__name__]
        for c in wanted.columns
    }
    rows = [full] + [full | {c.name: None} for c in wanted.columns if not c.required]
    df = spark.createDataFrame(rows, wanted.schema)
    found = conform(df, wanted)
    assert [f.dataType for f in found.schema] == [f.dataType for f in wanted.schema]
    assert [r.asDict() for r in found.collect()] == rows
