"""Contracts of the eleven banking tables, in load order."""

from __future__ import annotations

from quayside.contracts.model import Reference, Registry, Rule, TableContract, columns

_TIMES = """
created_at timestamp
updated_at timestamp
"""


def _table(name, cols, *, cluster=(), references=(), rules=()):
    """The first column is the key; ``references`` maps a column to its parent's key."""
    cols = columns(cols.strip() + _TIMES)
    return TableContract(
        name=name,
        columns=cols,
        key=(cols[0].name,),
        cluster=tuple(cluster),
        references=tuple(Reference(c, *target.split(".")) for c, target in dict(references).items()),
        rules=tuple(Rule(n, breach) for n, breach in dict(rules).items()),
        comment=f"Raw copy of {name}",
    )


# Table, column and type names must equal those of the source
# database; the accepted values are the ones it documents.
BANKING = Registry(
    "banking",
    (
        _table(
            "currencies",
            """
            currency_code string -- currency code
            currency_name string
            decimal_places bigint -- digits kept when amounts are rounded
            is_active boolean
            """,
            rules={"decimal_places_not_negative": "decimal_places < 0"},
        ),
        _table(
            "channels",
            """
            channel_id bigint
            channel_code string
            channel_name string
            is_active boolean
            """,
        ),
        _table(
            "transaction_types",
            """
            transaction_type_id bigint
            transaction_type_code string
            transaction_type_name string
            is_active boolean
            """,
        ),
        _table(
            "branches",
            """
            branch_id bigint
            branch_code string
            branch_name string
            city string
            region string
            opened_date date
            is_active boolean
            """,
            cluster=["branch_id"],
        ),
        _table(
            "products",
            """
            product_id bigint
            product_code string
            product_name string
            product_type string
            currency_code string
            is_active boolean
            """,
            cluster=["product_id"],
            references={"currency_code": "currencies.currency_code"},
            rules={
                "product_type_accepted": "product_type NOT IN"
                " ('CURRENT_ACCOUNT', 'SAVINGS_ACCOUNT', 'CREDIT_ACCOUNT')"
            },
        ),
        _table(
            "merchants",
            """
            merchant_id bigint
            merchant_code string
            merchant_name string
            merchant_category string
            city string
            is_active boolean
            """,
            cluster=["merchant_id"],
        ),
        _table(
            "customers",
            """
            customer_id bigint
            customer_code string
            full_name string
            date_of_birth date
            gender string
            phone_number string?
            email string?
            city string
            customer_segment string
            kyc_status string
            """,
            cluster=["customer_id"],
        ),
        _table(
            "accounts",
            """
            account_id bigint
            account_number string
            customer_id bigint
            branch_id bigint
            product_id bigint
            currency_code string
            account_status string
            opened_at timestamp
            closed_at timestamp? -- empty while the account is open
            current_balance decimal(18,2)
            """,
            cluster=["account_id"],
            references={
                "customer_id": "customers.customer_id",
                "branch_id": "branches.branch_id",
                "product_id": "products.product_id",
                "currency_code": "currencies.currency_code",
            },
            rules={"closed_at_empty_while_active": "account_status = 'ACTIVE' AND closed_at IS NOT NULL"},
        ),
        _table(
            "cards",
            """
            card_id bigint
            masked_card_number string -- never the full number
            account_id bigint
            card_type string
            card_status string
            issued_at timestamp
            expired_at timestamp
            """,
            cluster=["account_id"],
            references={"account_id": "accounts.account_id"},
        ),
        _table(
            "transactions",
            """
            transaction_id bigint
            transaction_reference string
            source_account_id bigint?
            destination_account_id bigint? -- transfers only
            card_id bigint?
            merchant_id bigint?
            branch_id bigint?
            channel_id bigint?
            transaction_type_id bigint?
            currency_code string?
            amount decimal(18,2)?
            fee_amount decimal(18,2)?
            status string?
            failure_reason string? -- failed transactions only
            transaction_time timestamp?
            """,
            cluster=["source_account_id", "transaction_time"],
            references={
                "source_account_id": "accounts.account_id",
                "destination_account_id": "accounts.account_id",
                "card_id": "cards.card_id",
                "merchant_id": "merchants.merchant_id",
                "branch_id": "branches.branch_id",
                "channel_id": "channels.channel_id",
                "transaction_type_id": "transaction_types.transaction_type_id",
                "currency_code": "currencies.currency_code",
            },
            rules={
                "status_accepted": "status NOT IN ('SUCCESS', 'PENDING', 'FAILED')",
                "failure_reason_only_when_failed": "failure_reason IS NOT NULL AND NOT (status <=> 'FAILED')",
            },
        ),
        _table(
            "transaction_status_history",
            """
            event_id bigint
            transaction_id bigint
            old_status string? -- empty on the first event
            new_status string
            event_time timestamp
            source_system string -- system that recorded the event
            """,
            cluster=["transaction_id"],
            references={"transaction_id": "transactions.transaction_id"},
        ),
    ),
)
