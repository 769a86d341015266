"""Tables that were made from an older contract."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quayside.contracts import LINEAGE, TableContract
from quayside.operators.catalog import PARTITIONS, column_line, require_table

MISSING, EXTRA, OTHER_TYPE, OTHER_COMMENT = "missing", "extra", "other type", "other comment"


class ContractDrift(RuntimeError):
    """A table differs from its contract in a way that cannot be mended in place."""


def drift(spark: SparkSession, namespace: str, contract: TableContract) -> list[tuple[str, str]]:
    """``(column, kind)`` wherever a table is not what its contract would make."""
    held = {f.name: f for f in spark.table(require_table(spark, namespace, contract.name)).schema.fields}
    wanted = [*contract.columns, *LINEAGE]
    found = []
    for column in wanted:
        field = held.get(column.name)
        if field is None:
            found.append((column.name, MISSING))
        elif field.dataType.simpleString() != column.type.simpleString():
            found.append((column.name, OTHER_TYPE))
        elif column.name not in PARTITIONS and field.metadata.get("comment", "") != contract.comment_of(column):
            found.append((column.name, OTHER_COMMENT))
    known = {c.name for c in wanted} | set(PARTITIONS)
    return found + [(name, EXTRA) for name in held if name not in known]


def widen(spark: SparkSession, namespace: str, contract: TableContract) -> list[tuple[str, str]]:
    """Bring an older table up to its contract; returns what differed.

    Columns that it lacks are added and null in the batches it has; comments are
    renewed.  Columns that the contract no longer has stay, null in later
    batches.  A column of another type is refused before anything is changed: files
    of both types could not be read as one table.
    """
    found = drift(spark, namespace, contract)
    refused = [name for name, kind in found if kind == OTHER_TYPE or (kind == MISSING and name in PARTITIONS)]
    if refused:
        raise ContractDrift(f"{contract.name}: cannot change in place: {', '.join(refused)}")
    table = require_table(spark, namespace, contract.name)
    by_name = {c.name: c for c in [*contract.columns, *LINEAGE]}
    added = [column_line(contract, by_name[name]) for name, kind in found if kind == MISSING]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
    for name, kind in found:
        if kind == OTHER_COMMENT:
            line = column_line(contract, by_name[name])
            comment = line[line.index(" COMMENT ") :]
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{name}`{comment}")
    return found
