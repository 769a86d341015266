"""Standard text and types, with rejects set apart."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.contracts import TableContract
from quayside.operators.conform import check_columns


def standardise(df: DataFrame, contract: TableContract, upper: Iterable[str] = ()) -> DataFrame:
    """The contract's columns from text, plus ``_rejected``: columns that did not parse.

    Text is trimmed and empty text becomes null; ``upper`` names the code
    columns to put in capitals.  One projection; split the result with
    ``accepted`` and ``rejected``.
    """
    check_columns(df.columns, contract)
    capitals = set(upper)
    typed, failed = [], []
    for column in contract.columns:
        raw = F.col(column.name)
        if isinstance(df.schema[column.name].dataType, T.StringType):
            raw = F.nullif(F.trim(raw), F.lit(""))
        value = _typed(raw, column.type)
        if column.name in capitals:
            value = F.upper(value)
        typed.append(value.alias(column.name))
        failed.append(F.when(raw.isNotNull() & value.isNull(), F.lit(column.name)))
    return df.select(*typed, F.array_compact(F.array(*failed)).alias("_rejected"))


def _typed(value: Column, target: T.DataType) -> Column:
    return value if isinstance(target, T.StringType) else value.try_cast(target)


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size("_rejected") == 0).drop("_rejected")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.size("_rejected") > 0)
