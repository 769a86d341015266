"""A table contract: columns, keys, references, value rules and layout."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import types as T


class ContractError(ValueError):
    """A table name, a frame or a registry breaks its contract."""


_TYPES = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "array<float>": T.ArrayType(T.FloatType()),
}


def _type(text: str) -> T.DataType:
    if text == "decimal":
        return T.DecimalType(38, 2)  # no scale given: two places
    if text.startswith("decimal("):
        precision, scale = text[len("decimal(") : -1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _TYPES[text]


@dataclass(frozen=True)
class Column:
    """One column; ``required`` is the source's NOT NULL, never enforced on write."""

    name: str
    type: T.DataType
    required: bool = True
    note: str = ""


def columns(text: str) -> tuple[Column, ...]:
    """Columns from lines of ``name type``; ``?`` after the type allows nulls.

    Text after ``--`` becomes the column's note.
    """
    found = []
    for line in text.strip().splitlines():
        spec, _, note = line.partition("--")
        name, kind = spec.split()
        found.append(Column(name, _type(kind.rstrip("?")), not kind.endswith("?"), note.strip()))
    return tuple(found)


@dataclass(frozen=True)
class Reference:
    """A foreign key on one column."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Rule:
    """A value rule; ``breach`` is the SQL predicate that is true for a bad row."""

    name: str
    breach: str


#: Columns the engine adds to every table.
LINEAGE = (
    Column("_ingested_at", T.TimestampType(), note="instant of the load, one per run"),
    Column("_source_system", T.StringType(), note="system the row was read from"),
    Column("_ingestion_batch_id", T.StringType(), note="id of the run that loaded the row"),
)


@dataclass(frozen=True)
class TableContract:
    """``cluster`` orders a table's files by these keys, the first before the others, or, ``interleaved``, by all alike."""

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    rules: tuple[Rule, ...] = ()
    modified: str | None = "updated_at"
    comment: str = ""
    interleaved: bool = False

    def __post_init__(self) -> None:
        names = set(self.column_names)
        used = {*self.key, *self.cluster, *(r.column for r in self.references)}
        if self.modified:
            used.add(self.modified)
        if len(names) != len(self.columns) or used - names:
            raise ContractError(f"{self.name}: repeated or unknown columns {sorted(used - names)}")
        if self.interleaved and len(self.cluster) < 2:
            raise ContractError(f"{self.name}: one cluster key cannot be interleaved")

    def __getitem__(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def decimals(self) -> list[Column]:
        """Columns whose values need exact, half-up rounding."""
        return [c for c in self.columns if isinstance(c.type, T.DecimalType)]

    def comment_of(self, column: Column) -> str:
        """A description made of what the contract knows about the column."""
        parts = [column.note] if column.note else []
        if column.name in self.key:
            parts.append("key")
        parts += [
            f"references {r.parent}.{r.parent_column}"
            for r in self.references
            if r.column == column.name
        ]
        if column.name == self.modified:
            parts.append("high-water mark of incremental loads")
        if column not in LINEAGE:
            parts.append("not null in source" if column.required else "may be null in source")
        return "; ".join(parts)

    @property
    def schema(self) -> T.StructType:
        """Target schema without lineage; every column is nullable."""
        return self._struct(self.columns)

    @property
    def loaded_schema(self) -> T.StructType:
        """Target schema with lineage."""
        return self._struct(self.columns + LINEAGE)

    def _struct(self, cols: tuple[Column, ...]) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.type, True, {"comment": self.comment_of(c)}) for c in cols]
        )


@dataclass(frozen=True)
class Registry:
    """Contracts in load order, parents before the tables that refer to them."""

    name: str
    contracts: tuple[TableContract, ...]
    _by_name: dict[str, TableContract] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        seen: dict[str, TableContract] = {}
        for contract in self.contracts:
            late = {r.parent for r in contract.references} - seen.keys() - {contract.name}
            if late:
                raise ContractError(f"{contract.name} is listed before {sorted(late)}")
            if contract.name in seen:
                raise ContractError(f"{contract.name} is listed twice")
            seen[contract.name] = contract
        object.__setattr__(self, "_by_name", seen)

    def __iter__(self) -> Iterator[TableContract]:
        return iter(self.contracts)

    def __getitem__(self, name: str) -> TableContract:
        try:
            return self._by_name[name]
        except KeyError:
            raise ContractError(f"{name!r} is not a table of {self.name}") from None

    @property
    def tables(self) -> list[str]:
        return [c.name for c in self.contracts]

    def select(self, tables: str | list[str] | None) -> list[str]:
        """Names to load: all in load order, or the given ones as given.

        A comma-separated text is accepted.  Names are not checked here: an
        unknown one must fail alone, as that table's row of the audit.
        """
        if tables is None:
            return self.tables
        names = tables.split(",") if isinstance(tables, str) else list(tables)
        return [n.strip() for n in names if n.strip()]
