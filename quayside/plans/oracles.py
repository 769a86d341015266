"""The registered queries as ANSI SQL over views of the test tables."""

from __future__ import annotations

from pyspark.sql import types as T

from quayside.contracts import Registry, TableContract
from quayside.contracts.banking import BANKING
from quayside.contracts.warehouse import WAREHOUSE
from quayside.plans.banking_shape import shape_sql
from quayside.plans.registered import CUTOFF, FIRST, SECOND, THIRD

_SQL_TYPES = {
    T.LongType: "BIGINT",
    T.StringType: "VARCHAR",
    T.TimestampType: "TIMESTAMP",
    T.DateType: "DATE",
    T.BooleanType: "BOOLEAN",
    T.DoubleType: "DOUBLE",
}


def _money(value: str) -> str:
    """Exact half-up rounding: through the number's text, not its binary value."""
    return f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(18,2))"


def _typed(column, value: str | None = None) -> str:
    value = value or column.name
    if isinstance(column.type, T.DecimalType):
        return _money(value)
    return f"CAST({value} AS {_SQL_TYPES[type(column.type)]})"


def _shown(column, value: str | None = None) -> str:
    typed = _typed(column, value)
    if isinstance(column.type, (T.DecimalType, T.DateType)):
        typed = f"CAST({typed} AS VARCHAR)"
    return f"{typed} AS {column.name}"


def _conformed(contract: TableContract, relation: str, *extra: str, **values: str) -> str:
    listed = [_shown(c, values.get(c.name)) for c in contract.columns]
    return f"SELECT {', '.join([*listed, *extra])} FROM {relation}"


def _lineage(run) -> list[str]:
    instant = run.ingested_at.strftime("%Y-%m-%d %H:%M:%S")
    return [
        f"TIMESTAMP '{instant}' AS _ingested_at",
        f"'{run.source_system}' AS _source_system",
        f"'{run.run_id}' AS _ingestion_batch_id",
    ]


def _loaded(contract: TableContract, relation: str, run=FIRST) -> str:
    return _conformed(contract, relation, *_lineage(run))


def _typed_table(name: str) -> str:
    """A banking table with its contract's types, as a subquery."""
    listed = ", ".join(f"{_typed(c)} AS {c.name}" for c in BANKING[name].columns)
    return f"(SELECT {listed} FROM ({shape_sql(name)}) {name}_raw)"


def _counts(names, column: str = "n_rows") -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS {column} FROM {t}" for t in names)


def _audit(registry: Registry, names, status: str, matched: str, relation=str) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS ord, '{t}' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows, "
        f"{len(registry[t].columns)} AS n_columns, '{status}' AS status, {matched} AS matched FROM {relation(t)}"
        for i, t in enumerate(names)
    )


def _failed(i: int, table: str, told: str | None = None) -> str:
    extra = f", '{told}' AS told" if told else ""
    return (
        f"SELECT {i} AS ord, '{table}' AS table_name, CAST(NULL AS BIGINT) AS source_rows, "
        f"CAST(NULL AS BIGINT) AS loaded_rows, CAST(NULL AS INT) AS n_columns, 'FAILED' AS status, "
        f"CAST(NULL AS BOOLEAN) AS matched{extra}"
    )


def _ok(i: int, table: str, extra: str = "") -> str:
    return (
        f"SELECT {i} AS ord, '{table}' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows, "
        f"{len(WAREHOUSE[table].columns)} AS n_columns, 'OK' AS status, TRUE AS matched{extra} FROM {table}"
    )


def _orphans(table: str, ref) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{ref.column}' AS column_name, '{ref.parent}' AS parent, "
        f"count(DISTINCT c.{ref.column}) AS n_values, count(*) AS n_rows "
        f"FROM {_typed_table(table)} c WHERE c.{ref.column} IS NOT NULL "
        f"AND c.{ref.column} NOT IN (SELECT {ref.parent_column} FROM {_typed_table(ref.parent)} p)"
    )


def _shares(table: str, key: str, parts: int) -> str:
    return f"""
        SELECT '{key}' AS key, CAST((rows_before // size) AS BIGINT) AS bucket, CAST(sum(n) AS BIGINT) AS n_rows,
               min(k) AS lo, max(k) AS hi
        FROM (SELECT *, coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                     AS rows_before,
                     CAST(ceil((SELECT count({key}) FROM {table}) / {parts}.0) AS BIGINT) AS size
              FROM (SELECT {key} AS k, count(*) AS n FROM {table} WHERE {key} IS NOT NULL GROUP BY 1) c) r
        GROUP BY rows_before // size, n >= size"""


#: The type a column must get, by the type that SQL finds in the source: money is exact, a measured value is not.
_EXPECTED = """CASE CASE column_name WHEN 'value' THEN 'MEASURED' ELSE kind END WHEN 'MEASURED' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'DATE' THEN 'date'
    WHEN 'BOOLEAN' THEN 'boolean' WHEN 'FLOAT[]' THEN 'array<float>'
    WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'bigint' ELSE 'decimal(18,2)' END"""


def _columns_of(contract: TableContract, relation: str) -> str:
    """Every column with the type SQL expects, its comment, and its values."""
    rows = [
        f"SELECT '{c.name}' AS column_name, any_value(typeof({c.name})) AS kind, "
        f"'{contract.comment_of(c)}' AS comment, count({c.name}) AS n_values FROM {relation} r"
        for c in contract.columns
    ]
    rows += [
        f"SELECT '{name}', '{kind}', '{comment}', count(*) FROM {relation} r"
        for name, kind, comment in (
            ("_ingested_at", "TIMESTAMP", "instant of the load, one per run"),
            ("_source_system", "VARCHAR", "system the row was read from"),
            ("_ingestion_batch_id", "VARCHAR", "id of the run that loaded the row"),
        )
    ]
    return (
        f"SELECT '{contract.name}' AS table_name, column_name, {_EXPECTED} AS data_type, comment, n_values "
        f"FROM ({' UNION ALL '.join(rows)}) {contract.name}_columns"
    )


def oracles() -> dict[str, str]:
    orders, lineitem, customer = WAREHOUSE["orders"], WAREHOUSE["lineitem"], WAREHOUSE["customer"]
    cutoff = f"TIMESTAMP '{CUTOFF:%Y-%m-%d %H:%M:%S}'"
    broken = "missing: o_totalprice"
    sql = {
        "scan_full": "SELECT * FROM lineitem",
        "scan_range_plan": """
            SELECT CAST((o_orderkey - b.lo) // b.width AS BIGINT) AS bucket, count(*) AS n_rows,
                   min(o_orderkey) AS lo, max(o_orderkey) AS hi
            FROM orders, (SELECT min(o_orderkey) AS lo,
                                 CAST(ceil((max(o_orderkey) - min(o_orderkey) + 1) / 16.0) AS BIGINT) AS width
                          FROM orders) b
            GROUP BY 1""",
        "scan_ranges": "SELECT 1 AS statements, count(*) AS n_rows FROM lineitem",
        "scan_text_ranges": "SELECT 1 AS statements, count(*) AS n_rows FROM customer",
        "scan_hot_ranges": "SELECT 1 AS statements, count(*) AS n_rows FROM orders",
        "scan_text_shares": f"{_shares('customer', 'c_name', 16)} UNION ALL {_shares('lineitem', 'l_returnflag', 5)}",
        "source_counts": _counts(WAREHOUSE.tables),
        "empty_batch_append": f"""
            SELECT '{FIRST.run_id}' AS run_id, count(*) AS loaded_rows, 6 AS n_columns, 'OK' AS status,
                   count(*) AS n_rows, CAST(sum({_money('o_totalprice')}) AS VARCHAR) AS o_totalprice FROM orders
            UNION ALL SELECT '{SECOND.run_id}', 0, 6, 'OK', NULL, NULL""",
        "conform_decimal": _conformed(lineitem, "lineitem", l_extendedprice="(l_extendedprice * (1 - l_discount))"),
        "conform_nan": _conformed(
            orders, "orders", o_totalprice="(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END)"
        ),
        "conform_types": f"""
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate AS shipped_at,
                   CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped_on,
                   CAST({_money('l_quantity')} AS VARCHAR) AS quantity_text, l_returnflag = 'R' AS returned
            FROM lineitem""",
        "add_lineage": _loaded(orders, "orders"),
        "truncate_load": _loaded(orders, "orders", SECOND),
        "failed_rerun": _loaded(orders, "orders"),
        "strict_refusal": _loaded(orders, "orders"),
        "mismatch_audit": """
            SELECT 0 AS ord, 'orders' AS table_name, count(*) + 1 AS source_rows, count(*) AS loaded_rows,
                   6 AS n_columns, 'OK' AS status, FALSE AS matched FROM orders""",
        "half_truncation": f"{_loaded(orders, 'orders')} UNION ALL {_loaded(orders, 'orders', SECOND)}",
        "append_load": f"{_loaded(orders, 'orders')} UNION ALL {_loaded(orders, 'orders', SECOND)}",
        "read_by_ingest_time": _loaded(orders, "orders", SECOND),
        "read_by_batch": _loaded(orders, "orders", FIRST),
        "clustered_load": f"""
            SELECT o_custkey, count(*) AS n_orders, CAST(sum({_money('o_totalprice')}) AS VARCHAR) AS o_totalprice,
                   max(o_orderdate) AS last_order
            FROM orders GROUP BY o_custkey""",
        "lookup_files": " UNION ALL ".join(
            f"""SELECT '{layout}' AS layout, '{key}' AS key, count(*) AS n_rows,
                   CAST(sum({_money('o_totalprice')}) AS VARCHAR) AS o_totalprice,
                   count(DISTINCT {key}) AS n_values, {narrow} AS narrow FROM orders"""
            for layout, key, narrow in (
                ("clustered", "o_custkey", True),
                ("clustered", "o_orderdate", False),
                ("interleaved", "o_custkey", True),
                ("interleaved", "o_orderdate", True),
            )
        ),
        "table_columns": " UNION ALL ".join(
            [_columns_of(c, c.name) for c in WAREHOUSE] + [_columns_of(c, f"({shape_sql(c.name)})") for c in BANKING]
        ),
        "default_ingested_at": _conformed(orders, "orders", "TRUE AS stamped", *_lineage(FIRST)[1:]),
        "observed_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS loaded_rows, count(*) AS target_rows FROM {t}"
            for t in WAREHOUSE.tables
        ),
        "reconcile_counts": f"""
            WITH s AS ({_counts(WAREHOUSE.tables)}),
                 h AS ({_counts([t for t in WAREHOUSE.tables if t not in ('events', 'orders')])}
                       UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderstatus <> 'P')
            SELECT coalesce(s.table_name, h.table_name) AS table_name, s.n_rows AS source_rows,
                   h.n_rows AS loaded_rows, coalesce(h.n_rows, 0) - coalesce(s.n_rows, 0) AS difference,
                   s.n_rows IS NOT DISTINCT FROM h.n_rows AS matched
            FROM s FULL OUTER JOIN h ON s.table_name = h.table_name""",
        "full_load_audit": _audit(WAREHOUSE, WAREHOUSE.tables, "OK", "TRUE"),
        "full_load_banking_audit": _audit(
            BANKING, BANKING.tables, "OK", "TRUE", lambda t: f"({shape_sql(t)}) {t}_raw"
        ),
        "dry_run_audit": f"""
            SELECT *, FALSE AS target_made
            FROM ({_audit(WAREHOUSE, WAREHOUSE.tables, 'DRY-RUN', 'CAST(NULL AS BOOLEAN)')}) a""",
        "subset_load_audit": _audit(WAREHOUSE, ["orders", "customer"], "OK", "TRUE"),
        "failure_isolation_audit": " UNION ALL ".join(
            [
                _ok(0, "customer", ", CAST(NULL AS VARCHAR) AS told"),
                _failed(1, "orders", broken),
                _failed(2, "no_such_table", "''no_such_table'' is not a table"),
                _ok(3, "lineitem", ", CAST(NULL AS VARCHAR) AS told"),
            ]
        ),
        "run_totals": f"""
            SELECT '{FIRST.run_id}' AS run_id, CAST(4 AS BIGINT) AS n_tables, CAST(2 AS BIGINT) AS n_ok,
                   CAST(2 AS BIGINT) AS n_failed,
                   (SELECT count(*) FROM customer) + (SELECT count(*) FROM lineitem) AS n_rows,
                   'orders,no_such_table' AS failed_tables""",
        "rerun_failed": f"""
            SELECT '{FIRST.run_id}' AS run_id, * FROM ({_ok(0, 'customer')}) a
            UNION ALL SELECT '{FIRST.run_id}', * FROM ({_failed(1, 'orders')}) b
            UNION ALL SELECT '{FIRST.run_id}', * FROM ({_ok(2, 'lineitem')}) c
            UNION ALL SELECT '{SECOND.run_id}', * FROM ({_ok(0, 'orders')}) d""",
        "incremental_load": f"{_loaded(orders, 'orders')} WHERE o_orderdate <= {cutoff} UNION ALL "
        f"{_loaded(orders, 'orders', SECOND)} WHERE o_orderdate > {cutoff}",
        "content_audit": """
            SELECT o_orderkey, CASE o_orderkey % 100 WHEN 3 THEN 'extra' ELSE 'changed' END AS kind,
                   CAST(CASE o_orderkey % 100 WHEN 3 THEN 0 WHEN 4 THEN 2 ELSE 1 END AS BIGINT) AS left_rows,
                   CAST(1 AS BIGINT) AS right_rows
            FROM orders WHERE o_orderkey % 100 BETWEEN 1 AND 4""",
        "content_of_loads": " UNION ALL ".join(
            f"SELECT '{c.name}' AS table_name, CAST(0 AS BIGINT) AS n_differences" for c in WAREHOUSE if c.key
        ),
        "swept_rows": f"""
            {_loaded(orders, 'orders')} WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
            UNION ALL {_loaded(orders, "(SELECT * REPLACE ('X' AS o_orderstatus) FROM orders) x", SECOND)}
            WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0 AND o_orderdate = (SELECT max(o_orderdate) FROM orders)
            UNION ALL {_loaded(orders, "(SELECT * REPLACE ('X' AS o_orderstatus) FROM orders) x", THIRD)}
            WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0 AND o_orderdate < (SELECT max(o_orderdate) FROM orders)""",
        "vanished_keys": f"SELECT o_orderkey, {', '.join(_lineage(THIRD))} FROM orders WHERE o_orderkey % 7 = 0",
        "streamed_load": _conformed(orders, "orders"),
        "widened_load": f"""
            SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM ({_loaded(orders, 'orders')}) a
            UNION ALL {_loaded(orders, 'orders', SECOND)}""",
        "dedup_latest": f"""
            SELECT * EXCLUDE (r, q, p, d, t) FROM (
                SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
                    l_partkey DESC, l_suppkey DESC, q DESC, p DESC, d DESC, t DESC, l_returnflag DESC,
                    l_linestatus DESC) AS r
                FROM (SELECT *, l_quantity::DECIMAL(18,2) AS q, l_extendedprice::DECIMAL(18,2) AS p,
                             l_discount::DECIMAL(18,2) AS d, l_tax::DECIMAL(18,2) AS t
                      FROM ({_conformed(lineitem, 'lineitem')}) c) v) w
            WHERE r = 1""",
        "standardise_accepted": _conformed(
            customer,
            "customer WHERE c_mktsegment <> 'BUILDING'",
            c_nationkey="nullif(c_nationkey, 7)",
        ),
        "standardise_rejected": f"""
            SELECT c_custkey, c_name, CAST(nullif(c_nationkey, 7) AS BIGINT) AS c_nationkey,
                   CAST(NULL AS VARCHAR) AS c_acctbal, c_mktsegment, 'c_acctbal' AS _rejected
            FROM customer WHERE c_mktsegment = 'BUILDING'""",
        "quality_nulls": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS n_nulls "
            f"FROM {_typed_table(t)} t"
            for t in BANKING.tables
            for c in BANKING[t].required
        ),
        "quality_rules": f"""
            SELECT 'currencies' AS table_name, 'decimal_places_not_negative' AS rule,
                   count(*) FILTER (decimal_places < 0) AS n_breaches FROM {_typed_table('currencies')} a
            UNION ALL SELECT 'products', 'product_type_accepted',
                   count(*) FILTER (product_type NOT IN ('CURRENT_ACCOUNT', 'SAVINGS_ACCOUNT', 'CREDIT_ACCOUNT'))
                   FROM {_typed_table('products')} b
            UNION ALL SELECT 'accounts', 'closed_at_empty_while_active',
                   count(*) FILTER (account_status = 'ACTIVE' AND closed_at IS NOT NULL)
                   FROM {_typed_table('accounts')} c
            UNION ALL SELECT 'transactions', 'status_accepted',
                   count(*) FILTER (status NOT IN ('SUCCESS', 'PENDING', 'FAILED'))
                   FROM {_typed_table('transactions')} d
            UNION ALL SELECT 'transactions', 'failure_reason_only_when_failed',
                   count(*) FILTER (failure_reason IS NOT NULL AND status IS DISTINCT FROM 'FAILED')
                   FROM {_typed_table('transactions')} e""",
        "quality_keys": """
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows
            FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
        "quality_all_keys": " UNION ALL ".join(
            f"SELECT '{c.name}' AS table_name, concat_ws('|', {', '.join(c.key)}) AS key, count(*) AS n_rows "
            f"FROM {_typed_table(c.name) if c.name in BANKING.tables else c.name} t "
            f"GROUP BY {', '.join(c.key)} HAVING count(*) > 1"
            for c in [*BANKING, *WAREHOUSE]
            if c.key
        ),
        "quality_orphans": " UNION ALL ".join(_orphans(c.name, ref) for c in BANKING for ref in c.references),
        "status_chain": f"""
            SELECT transaction_id, event_id, event_time, old_status, new_status, expected_status FROM (
                SELECT *, lag(new_status) OVER (PARTITION BY transaction_id ORDER BY event_time, event_id)
                    AS expected_status
                FROM {_typed_table('transaction_status_history')} h) v
            WHERE old_status IS DISTINCT FROM expected_status""",
        "currency_round": f"""
            SELECT transaction_id, t.currency_code, {_rounded('amount')}, {_rounded('fee_amount')}
            FROM {_typed_table('transactions')} t
            LEFT JOIN {_typed_table('currencies')} c ON t.currency_code = c.currency_code""",
        "transaction_summary": f"""
            SELECT CAST(CAST(date_trunc('month', transaction_time) AS DATE) AS VARCHAR) AS period,
                   transaction_type_code, channel_code, t.currency_code, status, count(*) AS n_transactions,
                   CAST(sum(amount) AS VARCHAR) AS amount, CAST(sum(fee_amount) AS VARCHAR) AS fee_amount
            FROM {_typed_table('transactions')} t
            LEFT JOIN {_typed_table('transaction_types')} y ON t.transaction_type_id = y.transaction_type_id
            LEFT JOIN {_typed_table('channels')} c ON t.channel_id = c.channel_id
            GROUP BY ALL""",
        "branch_balances": f"""
            SELECT currency_code, region, branch_name, count(*) AS n_accounts,
                   CAST(sum(current_balance) AS VARCHAR) AS balance,
                   CAST(grouping(currency_code, region, branch_name) AS INT) AS level
            FROM {_typed_table('accounts')} a
            LEFT JOIN (SELECT branch_id AS b_id, branch_name, region FROM {_typed_table('branches')} r) b
                   ON branch_id = b_id
            GROUP BY GROUPING SETS ((currency_code, region, branch_name), (currency_code, region), (currency_code))""",
        "customer_balances": f"""
            SELECT c.customer_id, full_name, customer_segment, count(account_id) AS n_accounts,
                   CAST(coalesce(sum(current_balance), CAST(0 AS DECIMAL(18,2))) AS VARCHAR) AS balance
            FROM {_typed_table('customers')} c LEFT JOIN {_typed_table('accounts')} a ON c.customer_id = a.customer_id
            GROUP BY ALL""",
    }
    sql["kept_transaction_summary"] = sql["appended_transaction_summary"] = sql["transaction_summary"]
    sql["kept_branch_balances"] = sql["appended_branch_balances"] = sql["branch_balances"]
    sql["kept_customer_balances"] = sql["customer_balances"]
    for contract in WAREHOUSE:
        if contract.name != "embeddings":
            sql[f"load_{contract.name}"] = _loaded(contract, contract.name)
    sql["load_embeddings"] = f"""
        SELECT vec_id, CAST(label AS BIGINT) AS label, {', '.join(_lineage(FIRST))},
               CAST(pos - 1 AS INT) AS embedding_pos, CAST(embedding[pos] AS DOUBLE) AS embedding
        FROM (SELECT *, unnest(CASE WHEN len(embedding) > 0 THEN range(1, len(embedding) + 1)
                                    ELSE [CAST(NULL AS BIGINT)] END) AS pos FROM embeddings) e"""
    for contract in BANKING:
        sql[f"load_banking_{contract.name}"] = _loaded(contract, f"({shape_sql(contract.name)}) s")
    return sql


def _rounded(name: str) -> str:
    return (
        f"CAST(CAST(CASE decimal_places WHEN 0 THEN round({name}, 0) WHEN 1 THEN round({name}, 1) "
        f"ELSE {name} END AS DECIMAL(18,2)) AS VARCHAR) AS {name}"
    )
