"""Typed table contracts and the registries that order them."""

from quayside.contracts.model import (
    LINEAGE,
    Column,
    ContractError,
    Reference,
    Registry,
    Rule,
    TableContract,
    columns,
)

__all__ = [
    "LINEAGE",
    "Column",
    "ContractError",
    "Reference",
    "Registry",
    "Rule",
    "TableContract",
    "columns",
]
