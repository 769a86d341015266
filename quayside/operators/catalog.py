"""Namespaces and tables made from contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.contracts import LINEAGE, Column, Registry, TableContract

#: Every load is one directory: its date, then its batch.
PARTITIONS = ("_ingested_date", "_ingestion_batch_id")


class TableMissing(LookupError):
    """The target table has not been created."""


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _name(value: str) -> str:
    escaped = value.replace("`", "``")
    return f"`{escaped}`"


def table_name(namespace: str, table: str) -> str:
    return f"{_name(namespace)}.{_name(table)}"


def create_namespace(
    spark: SparkSession, namespace: str, location: str | None = None, comment: str = ""
) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(namespace)} COMMENT {_text(comment)}{where}")


def column_line(contract: TableContract, column: Column, default: str = "") -> str:
    """A column as DDL names it: its type and comment."""
    return f"{_name(column.name)} {column.type.simpleString()}{default} COMMENT {_text(contract.comment_of(column))}"


def table_ddl(namespace: str, contract: TableContract) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for one contract."""
    lines = ["  " + column_line(contract, c) for c in contract.columns]
    for column in LINEAGE:
        default = " DEFAULT current_timestamp()" if column.name == "_ingested_at" else ""
        lines.append("  " + column_line(contract, column, default))
    lines.append("  `_ingested_date` date DEFAULT current_date() COMMENT 'UTC date of _ingested_at'")
    body = ",\n".join(lines)
    properties = f"\nTBLPROPERTIES ('cluster_by' = {_text(','.join(contract.cluster))})" if contract.cluster else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {table_name(namespace, contract.name)} (\n{body}\n)\n"
        f"USING parquet\nPARTITIONED BY ({', '.join(PARTITIONS)})\n"
        f"COMMENT {_text(contract.comment)}{properties}"
    )


def create_tables(
    spark: SparkSession,
    namespace: str,
    registry: Registry,
    location: str | None = None,
    tables: list[str] | None = None,
) -> int:
    """Create the namespace and each table that is absent; returns the statements run."""
    names = registry.tables if tables is None else tables
    if not names:
        raise ValueError(f"{registry.name}: no table to create")
    create_namespace(spark, namespace, location, f"Raw copies of the {registry.name} tables with lineage columns")
    for name in names:
        spark.sql(table_ddl(namespace, registry[name]))
    return 1 + len(names)


def require_table(spark: SparkSession, namespace: str, table: str) -> str:
    """The qualified name of a table that exists."""
    name = table_name(namespace, table)
    if not spark.catalog.tableExists(name):
        raise TableMissing(f"{name} does not exist; create the tables first")
    return name


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def set_properties(spark: SparkSession, name: str, values: dict[str, str]) -> None:
    listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def describe_columns(spark: SparkSession, namespace: str, contract: TableContract) -> DataFrame:
    """Name, type and comment of each column, as the catalog has them."""
    schema = spark.table(require_table(spark, namespace, contract.name)).schema
    rows = [
        (contract.name, i, f.name, f.dataType.simpleString(), f.metadata.get("comment", ""))
        for i, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, ordinal int, column_name string, data_type string, comment string"
    )
