"""What a job asks of a source."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quayside.contracts import TableContract
from quayside.operators.incremental import changed_since


class Source:
    """Whole tables of one system, with their columns as the system has them."""

    #: Whether a second read burdens the source or may see other rows.  Spark
    #: reads the input of a range shuffle twice, once to sample it; tables of
    #: such a source are landed unclustered first.
    land_first = False

    def probe(self, tables: list[str]) -> str:
        """Fail when the source of these tables cannot be reached; else say what answered."""
        raise NotImplementedError

    def count(self, table: str) -> int:
        raise NotImplementedError

    def read(self, contract: TableContract) -> DataFrame:
        """All rows, all columns; 0 rows still have the contract's columns."""
        raise NotImplementedError

    def size_bytes(self, df: DataFrame) -> int | None:
        """Stored size of a table that was read, if the source knows it."""
        return None

    def ranged_by(self, contract: TableContract) -> tuple[str, ...]:
        """Columns by which ``read``'s partitions are disjoint ranges."""
        return ()

    def read_since(self, contract: TableContract, start: int) -> DataFrame:
        """Rows changed since an instant in microseconds; Spark pushes the filter down."""
        return self.read(contract).where(changed_since(contract, start))
