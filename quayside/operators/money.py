"""Amounts rounded to the digits of their currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.frames import lookup_join
from quayside.operators.dedup import lookup


def round_to_currency(df: DataFrame, currencies: DataFrame, amounts: list[str]) -> DataFrame:
    """Round decimal columns half up to ``decimal_places``; unknown currencies stay as they are."""
    digits = lookup(currencies, "currency_code", "decimal_places").withColumnRenamed("decimal_places", "_digits")
    joined = lookup_join(df, digits, "currency_code")
    rounded = {name: _rounded(df, name) for name in amounts}
    return joined.withColumns(rounded).select(df.columns)


def _rounded(df, name):
    """A case per scale: the scale of a rounding must be a constant."""
    kind = df.schema[name].dataType
    value = F.col(name)
    result = None
    for digits in range(kind.scale):
        branch = F.round(value, digits).cast(kind)
        match = F.col("_digits") == digits
        result = F.when(match, branch) if result is None else result.when(match, branch)
    return value if result is None else result.otherwise(value)
