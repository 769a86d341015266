"""Tables of a JDBC database, read in parallel."""

from __future__ import annotations

import logging
import math
import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside.contracts import Registry, TableContract
from quayside.operators.incremental import changed_since
from quayside.sources.base import Source
from quayside.sources.ranges import (
    KeyRange,
    histogram_of,
    ordered_predicates,
    ordered_sql,
    range_predicates,
    split_ranges,
)

log = logging.getLogger(__name__)


class JdbcSource(Source):
    """Tables of one schema, each read as disjoint ranges of its key.

    A range has about ``rows_per_range`` rows, however many ranges that makes.
    Executors open one connection per running task, so the cores given to the
    application bound the connections.  Only names in the registry reach the SQL
    text.  The ranges are separate statements, so a table that changes during
    the load is not one snapshot.
    """

    land_first = True

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        registry: Registry,
        *,
        schema: str = "public",
        properties: dict[str, str] | None = None,
        fetch_size: int = 50_000,
        rows_per_range: int = 1_000_000,
    ):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*)?", schema):
            raise ValueError(f"{schema!r} is not the name of a schema")
        self.spark = spark
        self.url = url
        self.registry = registry
        self.schema = schema
        self.properties = {**(properties or {}), "fetchsize": str(fetch_size)}
        self.rows_per_range = rows_per_range

    def address(self, table: str) -> str:
        return f"{self.schema}.{self.registry[table].name}"

    def probe(self, tables: list[str]) -> str:
        self.query("SELECT 1 AS ok").first()
        return f"JDBC database, schema {self.schema}"

    def count(self, table: str) -> int:
        return int(self.query(f"SELECT COUNT(*) AS n FROM {self.address(table)}").first()[0])

    def read(self, contract: TableContract) -> DataFrame:
        return self.scan(self.address(contract.name), self._predicates(contract, "1 = 1"))

    def read_since(self, contract: TableContract, start: int) -> DataFrame:
        """Ranges sized by the rows in the window; Spark pushes the window itself down.

        The text compares without a time zone, which is near enough for sizes.
        """
        instant = datetime(1970, 1, 1) + timedelta(microseconds=start)
        window = f"({contract.modified} >= TIMESTAMP '{instant}' OR {contract.modified} IS NULL)"
        scanned = self.scan(self.address(contract.name), self._predicates(contract, window))
        return scanned.where(changed_since(contract, start))

    def ranged_by(self, contract: TableContract) -> tuple[str, ...]:
        return tuple(_whole_number_keys(contract)[:1])

    def query(self, sql: str) -> DataFrame:
        reader = self.spark.read.format("jdbc").option("url", self.url).options(**self.properties)
        return reader.option("query", sql).load()

    def scan(self, address: str, predicates: list[str]) -> DataFrame:
        return self.spark.read.jdbc(self.url, address, predicates=predicates, properties=self.properties)

    def _predicates(self, contract: TableContract, window: str) -> list[str]:
        whole = _whole_number_keys(contract)
        keys = [*whole, *(k for k in contract.key if k not in whole)]
        if not keys:
            log.warning("[%s] has no key: it is read by one statement", contract.name)
            return ["1 = 1"]
        return self._ranges(contract, keys, window)

    def _ranges(self, contract: TableContract, keys: list[str], window: str) -> list[str]:
        """Ranges of the first key; a value with too many rows is cut by the next key."""
        address, (key, *others) = self.address(contract.name), keys
        measures = f"COUNT(*) AS n_all, COUNT({key}) AS n, MIN({key}) AS lo, MAX({key}) AS hi"
        found = self.query(f"SELECT {measures} FROM {address} WHERE {window}").first()
        if found["n_all"] <= self.rows_per_range or not found["n"]:
            return ["1 = 1"]
        if isinstance(contract[key].type, T.LongType):
            whole = KeyRange(int(found["lo"]), int(found["hi"]), int(found["n"]))
            ranges = split_ranges(histogram_of(self.query, address, key, window), whole, self.rows_per_range)
            hot = [str(r.lo) if r.rows > self.rows_per_range else None for r in ranges]
            parts = list(zip(range_predicates(key, ranges), hot))
        else:
            shares = math.ceil(found["n"] / self.rows_per_range)
            parts = ordered_predicates(key, self.query(ordered_sql(address, key, shares, window)).collect())
        statements = []
        for predicate, value in parts:
            if others and value is not None:
                finer = self._ranges(contract, others, f"{window} AND {key} = {value}")
                statements += [f"({predicate}) AND ({f})" for f in finer]
            else:
                statements.append(predicate)
        return statements


def _whole_number_keys(contract: TableContract) -> list[str]:
    return [k for k in contract.key if isinstance(contract[k].type, T.LongType)]
