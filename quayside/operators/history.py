"""Consistency of a status history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.ranks import PLACE, RANGE, in_ranges

_KEY = "transaction_id"
_ORDER = ["event_time", "event_id", "new_status", "old_status"]


def chain_breaks(events: DataFrame, ranges: int | None = None) -> DataFrame:
    """Events whose ``old_status`` is not the transaction's previous ``new_status``.

    The first event of a transaction must have none.  All histories are laid end to
    end and cut into ranges, so one of any length is walked by many tasks; each
    range gets the last event before it, one row, from the ranges before.
    """
    ranges = ranges or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = in_ranges(events, [F.col(c) for c in (_KEY, *_ORDER)], ranges)
    walk = Window.partitionBy(RANGE).orderBy(PLACE)
    walked = placed.withColumns(
        {
            "_same": F.lag(F.struct(_KEY)).over(walk) == F.struct(_KEY),
            "_previous": F.lag("new_status").over(walk),
        }
    )
    carried = _carried(placed)
    first = F.col(PLACE) == 0
    previous = F.when(first & F.col("_of").eqNullSafe(F.col(_KEY)) & F.col("_carried"), F.col("_last")).when(
        ~first & F.col("_same"), F.col("_previous")
    )
    chained = walked.join(F.broadcast(carried), RANGE, "left").withColumn("expected_status", previous)
    broken = chained.where(~F.col("old_status").eqNullSafe(F.col("expected_status")))
    return broken.select(*events.columns, "expected_status")


def _carried(placed: DataFrame) -> DataFrame:
    """For each range the last event of the ranges before it: its transaction and status."""
    ends = placed.groupBy(RANGE).agg(F.max_by(F.struct(_KEY, "new_status"), PLACE).alias("end")).collect()
    rows, before = [], None
    for r in sorted(ends, key=lambda r: r[RANGE]):
        if before is not None:
            rows.append((r[RANGE], True, before[_KEY], before["new_status"]))
        before = r["end"]
    kind = placed.schema[_KEY].dataType.simpleString()
    return placed.sparkSession.createDataFrame(rows, f"{RANGE} int, _carried boolean, _of {kind}, _last string")
