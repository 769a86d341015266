from __future__ import annotations

import pytest
from pyspark.sql import types as T

from quayside.contracts import ContractError, Reference, Registry, TableContract, columns
from quayside.contracts.banking import BANKING


def test_banking_pack_has_the_documented_shape():
    assert BANKING.tables == [
        "currencies",
        "channels",
        "transaction_types",
        "branches",
        "products",
        "merchants",
        "customers",
        "accounts",
        "cards",
        "transactions",
        "transaction_status_history",
    ]
    assert [len(c.columns) for c in BANKING] == [6, 6, 6, 9, 8, 8, 12, 12, 9, 17, 8]
    assert sum(len(c.references) for c in BANKING) == 15
    assert sum(not c.required for t in BANKING for c in t.columns) == 17
    kinds = [type(c.type).__name__ for t in BANKING for c in t.columns]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "LongType": 23,
        "StringType": 39,
        "TimestampType": 28,
        "DateType": 2,
        "BooleanType": 6,
        "DecimalType": 3,
    }


def test_cluster_keys():
    assert {c.name: c.cluster for c in BANKING if c.cluster} == {
        "branches": ("branch_id",),
        "products": ("product_id",),
        "merchants": ("merchant_id",),
        "customers": ("customer_id",),
        "accounts": ("account_id",),
        "cards": ("account_id",),
        "transactions": ("source_account_id", "transaction_time"),
        "transaction_status_history": ("transaction_id",),
    }


def test_target_schema_is_nullable_and_carries_lineage():
    schema = BANKING["accounts"].loaded_schema
    assert all(f.nullable for f in schema)
    assert schema.fieldNames()[-3:] == ["_ingested_at", "_source_system", "_ingestion_batch_id"]
    assert "references customers.customer_id" in schema["customer_id"].metadata["comment"]


def test_decimals_come_from_the_contract():
    assert [c.name for c in BANKING["transactions"].decimals] == ["amount", "fee_amount"]


def test_decimal_without_scale_keeps_two_places():
    assert columns("x decimal")[0].type == T.DecimalType(38, 2)


def test_select_keeps_the_given_order_and_unknown_names():
    assert BANKING.select(None) == BANKING.tables
    assert BANKING.select(" cards , nope,accounts") == ["cards", "nope", "accounts"]
    with pytest.raises(ContractError, match="nope"):
        BANKING["nope"]


def test_a_child_before_its_parent_is_refused():
    child = TableContract("c", columns("id bigint"), references=(Reference("id", "p", "id"),), modified=None)
    parent = TableContract("p", columns("id bigint"), modified=None)
    with pytest.raises(ContractError, match="before"):
        Registry("r", (child, parent))


def test_unknown_key_column_is_refused():
    with pytest.raises(ContractError, match="nope"):
        TableContract("t", columns("id bigint"), key=("nope",), modified=None)
