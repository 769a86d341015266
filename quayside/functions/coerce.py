"""Casting one column to its contract type, without silent loss."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def coerce(value: Column, source: T.DataType, target: T.DataType, label: str) -> Column:
    """``value`` as ``target``; NaN becomes null, anything that does not fit fails.

    Decimals are rounded half up on the number's decimal text, so 1.005 is
    1.01 and not the 1.00 of its binary value.  A double's cast goes through
    that text already; a float is widened first, so its text is taken here.
    """
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return _from_floating(value, source, target, label)
    if isinstance(source, T.DecimalType) and source.scale and isinstance(target, _INTEGRAL):
        return _whole(F.when(value.isNull(), F.lit(None)), value, target, label)
    return value if source == target else value.cast(target)


def _from_floating(value, source, target, label):
    known = F.when(F.isnan(value), F.lit(None))
    if isinstance(target, T.DecimalType):
        exact = value.cast("string") if isinstance(source, T.FloatType) else value
        infinite = F.abs(value) == F.lit(float("inf"))
        refused = F.raise_error(F.lit(f"{label}: infinite value in a decimal column"))
        return known.when(infinite, refused).otherwise(exact.cast(target))
    if isinstance(target, _INTEGRAL):
        return _whole(known, value, target, label)
    if isinstance(target, (T.FloatType, T.DoubleType)):
        return known.otherwise(value.cast(target))
    return known.otherwise(value).cast(target)


def _whole(known, value, target, label):
    refused = F.raise_error(F.lit(f"{label}: fractional value in a whole-number column"))
    return known.when(value != F.floor(value), refused).otherwise(value.cast(target))
