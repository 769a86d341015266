"""Tables kept as parquet files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from quayside.contracts import TableContract
from quayside.operators.layout import scan_bytes
from quayside.sources.base import Source


class ParquetSource(Source):
    """``<root>/<table>.parquet``, a file or a folder of files each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._counted: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}.parquet"

    def probe(self, tables: list[str]) -> str:
        """One table that can be opened is enough; the others fail one by one."""
        missing = None
        for table in tables:
            try:
                self.spark.read.parquet(self.path(table))
            except AnalysisException as error:
                if not _no_files(error):
                    missing = error
                    continue
            return f"parquet files at {self.root}"
        if missing is not None:
            raise missing
        return "no table asked for"

    def count(self, table: str) -> int:
        """Counted from the footers; no column is read.  The next read uses the same files."""
        try:
            df = self.spark.read.parquet(self.path(table))
        except AnalysisException as error:
            if _no_files(error):
                return 0
            raise
        self._counted[table] = df
        return df.count()

    def read(self, contract: TableContract) -> DataFrame:
        counted = self._counted.pop(contract.name, None)
        if counted is not None:
            return counted
        try:
            return self.spark.read.parquet(self.path(contract.name))
        except AnalysisException as error:
            if _no_files(error):
                return self.spark.createDataFrame([], contract.schema)
            raise

    def size_bytes(self, df: DataFrame) -> int:
        return scan_bytes(df)


def _no_files(error: AnalysisException) -> bool:
    """A folder that exists but holds no file: a table with no row."""
    return error.getCondition() == "UNABLE_TO_INFER_SCHEMA"
