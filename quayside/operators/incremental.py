"""Incremental extract by a high-water mark."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.contracts import TableContract
from quayside.functions.frames import same_row


def high_water_mark(df: DataFrame, contract: TableContract) -> int | None:
    """The highest modified time of a loaded table, in microseconds; reads one column."""
    return df.agg(F.max(F.unix_micros(contract.modified))).first()[0]


def window_start(mark: int, overlap: timedelta) -> int:
    """Where an increment starts: some time before the mark, for rows committed late."""
    return mark - overlap // timedelta(microseconds=1)


def changed_since(contract: TableContract, start: int) -> Column:
    """Rows modified at or after an instant in microseconds, or at an unknown time.

    The instant itself is included: other rows may carry the time of the last one.
    """
    modified = F.col(contract.modified)
    return (modified >= F.timestamp_micros(F.lit(start))) | modified.isNull()


def not_yet_loaded(extract: DataFrame, target: DataFrame, contract: TableContract, window: Column) -> DataFrame:
    """Rows of a conformed extract that the target does not hold unchanged.

    Only the target's rows in the extract's window are compared, so the work
    follows the increment, not the table.
    """
    held = target.where(window).select(contract.column_names).distinct()
    return extract.join(held, same_row(extract, held, contract.column_names), "left_anti")
