"""Quality checks read off the contracts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.contracts import Registry, TableContract

#: Rows whose keys are counted in one task, and tasks that share the rows of one key.
ROWS, SHARES = 1 << 20, 16


def _long_form(df: DataFrame, contract: TableContract, measures: dict, name: str, value: str) -> DataFrame:
    """One aggregate over the table, turned into a row per measure."""
    wide = df.agg(*(m.alias(k) for k, m in measures.items()))
    return wide.unpivot([], list(measures), name, value).select(
        F.lit(contract.name).alias("table_name"), name, value
    )


def nulls(df: DataFrame, contract: TableContract) -> DataFrame:
    """Nulls in each column that is NOT NULL in the source; one pass."""
    measures = {c: F.count_if(F.col(c).isNull()) for c in contract.required}
    return _long_form(df, contract, measures, "column_name", "n_nulls")


def rule_breaches(df: DataFrame, contract: TableContract) -> DataFrame:
    """Rows breaking each value rule; one pass.  A rule says nothing of nulls it does not name."""
    measures = {r.name: F.count_if(F.expr(r.breach)) for r in contract.rules}
    return _long_form(df, contract, measures, "rule", "n_breaches")


def repeated_keys(df: DataFrame, contract: TableContract) -> DataFrame:
    """Keys held by more than one row.

    Rows are dealt by key to tasks of about ``ROWS`` rows, so a task's counts
    stay small however large the table.  The rows of one key are dealt to up to
    ``SHARES`` tasks, and their counts added up, so a hot key fills no task.
    """
    tasks = -(-df.count() // ROWS)
    if tasks <= 1:
        counted = df.groupBy(*contract.key).agg(F.count(F.lit(1)).alias("n_rows"))
    else:
        share = F.pmod(F.monotonically_increasing_id(), F.lit(SHARES)).alias("__share")
        counted = (
            df.select(*contract.key, share)
            .repartition(tasks, *contract.key, "__share")
            .groupBy(*contract.key, "__share")
            .agg(F.count(F.lit(1)).alias("n"))
            .repartition(tasks, *contract.key)
            .groupBy(*contract.key)
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
        )
    return counted.where("n_rows > 1")


def orphans(frames: Mapping[str, DataFrame], registry: Registry, tables: list[str] | None = None) -> DataFrame:
    """Per reference: values without a parent, and the rows that carry them.

    Each reference reads one column, and counts its values before the join, so
    a value held by very many rows is one row of it.
    """
    edges = [(name, ref) for name in (tables or registry.tables) for ref in registry[name].references]
    found = [_orphans_of(frames[name], frames[ref.parent], name, ref) for name, ref in edges]
    # A row without a value for each reference, so that those without orphans are listed too.
    listed = found[0].sparkSession.createDataFrame(
        [(name, ref.column, ref.parent, None) for name, ref in edges], found[0].schema
    )
    return (
        reduce(DataFrame.unionByName, [listed, *found])
        .groupBy("table_name", "column_name", "parent")
        .agg(F.count("n").alias("n_values"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    )


def _orphans_of(child, parent, name, ref):
    values = (
        child.select(F.col(ref.column).alias("value"))
        .where("value IS NOT NULL")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(F.col(ref.parent_column).alias("value"))
    return values.join(known, "value", "left_anti").select(
        F.lit(name).alias("table_name"),
        F.lit(ref.column).alias("column_name"),
        F.lit(ref.parent).alias("parent"),
        F.when(F.col("n") > 0, F.col("n")).alias("n"),
    )
