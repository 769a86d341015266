"""Reporting tables over the banking tables.

Each has two forms: from the facts, of which the last loaded row of each counts, and
from the sums of a rollup that is kept up with every batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.contracts.banking import BANKING
from quayside.operators.dedup import lookup
from quayside.operators.rollups import Rollup, current_facts


def transactions_by(period: str = "day") -> Rollup:
    return Rollup(
        f"transactions_by_{period}",
        BANKING["transactions"],
        {
            "period": f"CAST(date_trunc('{period}', transaction_time) AS date)",
            "transaction_type_id": "transaction_type_id",
            "channel_id": "channel_id",
            "currency_code": "currency_code",
            "status": "status",
        },
        ("amount", "fee_amount"),
    )


ACCOUNTS_BY_BRANCH = Rollup(
    "accounts_by_branch",
    BANKING["accounts"],
    {"branch_id": "branch_id", "currency_code": "currency_code"},
    ("current_balance",),
)

ACCOUNTS_BY_CUSTOMER = Rollup(
    "accounts_by_customer", BANKING["accounts"], {"customer_id": "customer_id"}, ("current_balance",)
)


def transaction_summary(
    transactions: DataFrame, transaction_types: DataFrame, channels: DataFrame, period: str = "day"
) -> DataFrame:
    """Count, amount and fee by period, type, channel, currency and status.

    Transactions are summed by their ids first; only the sums are joined.
    """
    sums = transactions_by(period).grouped(current_facts(transactions, "transaction_id"))
    return transaction_sums(sums, transaction_types, channels)


def transaction_sums(sums: DataFrame, transaction_types: DataFrame, channels: DataFrame) -> DataFrame:
    """The same from the sums of ``transactions_by``."""
    named = sums.join(
        lookup(transaction_types, "transaction_type_id", "transaction_type_code"), "transaction_type_id", "left"
    ).join(lookup(channels, "channel_id", "channel_code"), "channel_id", "left")
    return named.groupBy("period", "transaction_type_code", "channel_code", "currency_code", "status").agg(
        F.sum("n").alias("n_transactions"),
        F.sum("amount").cast("decimal(38,2)").alias("amount"),
        F.sum("fee_amount").cast("decimal(38,2)").alias("fee_amount"),
    )


def branch_balances(accounts: DataFrame, branches: DataFrame) -> DataFrame:
    """Accounts and balance per currency: by branch, rolled up to region and to all.

    ``level`` is 0 for a branch, 1 for a region, 3 for the currency.
    """
    return branch_sums(ACCOUNTS_BY_BRANCH.grouped(current_facts(accounts, "account_id")), branches)


def branch_sums(sums: DataFrame, branches: DataFrame) -> DataFrame:
    """The same from the sums of ``ACCOUNTS_BY_BRANCH``."""
    placed = sums.join(lookup(branches, "branch_id", "branch_name", "region"), "branch_id", "left")
    by = ["currency_code", "region", "branch_name"]
    return placed.groupingSets([by, by[:2], by[:1]], *by).agg(
        F.sum("n").alias("n_accounts"),
        F.sum("current_balance").cast("decimal(38,2)").alias("balance"),
        F.grouping_id().cast("int").alias("level"),
    )


def customer_balances(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Accounts and balance of each customer, customers without accounts too."""
    return customer_sums(ACCOUNTS_BY_CUSTOMER.grouped(current_facts(accounts, "account_id")), customers)


def customer_sums(sums: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from the sums of ``ACCOUNTS_BY_CUSTOMER``."""
    known = lookup(customers, "customer_id", "full_name", "customer_segment")
    return known.join(sums, "customer_id", "left").select(
        "customer_id",
        "full_name",
        "customer_segment",
        F.coalesce("n", F.lit(0)).alias("n_accounts"),
        F.coalesce("current_balance", F.lit(0).cast("decimal(38,2)")).alias("balance"),
    )
