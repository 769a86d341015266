"""Conform a source frame to a contract and stamp its lineage."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.contracts import Column as ContractColumn
from quayside.contracts import ContractError, TableContract
from quayside.functions.coerce import coerce


def check_columns(found: list[str], contract: TableContract) -> None:
    """Fail with the names when columns are missing, extra or repeated."""
    wanted = contract.column_names
    problems = {
        "missing": [c for c in wanted if c not in found],
        "extra": [c for c in dict.fromkeys(found) if c not in wanted],
        "repeated": [c for c in dict.fromkeys(found) if found.count(c) > 1],
    }
    told = "; ".join(f"{kind}: {', '.join(names)}" for kind, names in problems.items() if names)
    if told:
        raise ContractError(f"{contract.name}: columns differ from the contract, {told}")


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """The contract's columns, in its order and of its types, with comments.

    One projection that fuses into the scan; the columns to round are found in
    the contract, never in the data.
    """
    check_columns(df.columns, contract)
    return df.select(
        [
            conformed(df, contract, c).alias(c.name, metadata={"comment": contract.comment_of(c)})
            for c in contract.columns
        ]
    )


def conformed(df: DataFrame, contract: TableContract, column: ContractColumn) -> Column:
    """One column of a source frame in its contract's type."""
    kind = df.schema[column.name].dataType
    return coerce(df[f"`{column.name}`"], kind, column.type, f"{contract.name}.{column.name}")


@dataclass(frozen=True)
class Run:
    """Identity of a run: one id and one instant for all its tables."""

    source_system: str
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    ingested_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", self.run_id):
            raise ValueError(f"run id {self.run_id!r} cannot name a partition")
        if self.ingested_at.tzinfo is None:
            raise ValueError("ingested_at needs a time zone")

    @property
    def ingested_date(self) -> str:
        return self.ingested_at.astimezone(timezone.utc).date().isoformat()


def with_lineage(df: DataFrame, run: Run) -> DataFrame:
    """Add the three lineage columns, constant over the run."""
    return df.withColumns(
        {
            "_ingested_at": F.lit(run.ingested_at).cast("timestamp"),
            "_source_system": F.lit(run.source_system),
            "_ingestion_batch_id": F.lit(run.run_id),
        }
    )
