"""Tables given as Spark frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from quayside.contracts import ContractError, TableContract
from quayside.sources.base import Source


class FrameSource(Source):
    """Frames by table name, such as views over another system's tables.

    ``land_first`` keeps a costly frame from being computed again for the
    sample its range shuffle needs.
    """

    def __init__(self, frames: Mapping[str, DataFrame], *, land_first: bool = False):
        self.frames = dict(frames)
        self.land_first = land_first

    def _frame(self, table: str) -> DataFrame:
        if table not in self.frames:
            raise ContractError(f"the source has no table {table!r}")
        return self.frames[table]

    def probe(self, tables: list[str]) -> str:
        return f"{len(self.frames)} frames"

    def count(self, table: str) -> int:
        return self._frame(table).count()

    def read(self, contract: TableContract) -> DataFrame:
        return self._frame(contract.name)
