"""The test tables in the shape of the eleven banking tables.

Each text is a source table, as raw as a database would give it; it reads the
same in Spark SQL and ANSI SQL, with ``{name}`` standing for a test table.  The
data breaks some of its contracts' rules on purpose, so the checks find rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_TIMES = "TIMESTAMP '1995-01-01 00:00:00' AS created_at, TIMESTAMP '1996-01-01 00:00:00' AS updated_at"

SHAPES = {
    "currencies": f"""
        SELECT upper(substr(r_name, 1, 3)) AS currency_code, r_name AS currency_name,
               r_regionkey % 3 AS decimal_places, r_regionkey < 4 AS is_active, {_TIMES}
        FROM {{region}}""",
    "channels": f"""
        SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS channel_id,
               substr(o_orderpriority, 3) AS channel_code, lower(substr(o_orderpriority, 3)) AS channel_name,
               count(*) > 0 AS is_active, {_TIMES}
        FROM {{orders}} GROUP BY o_orderpriority""",
    "transaction_types": f"""
        SELECT r_regionkey + 1 AS transaction_type_id, r_name AS transaction_type_code,
               lower(r_name) AS transaction_type_name, TRUE AS is_active, {_TIMES}
        FROM {{region}}""",
    "branches": f"""
        SELECT n_nationkey AS branch_id, concat('BR', CAST(n_nationkey AS VARCHAR(20))) AS branch_code,
               n_name AS branch_name, lower(n_name) AS city, r_name AS region,
               DATE '1990-01-01' + CAST(n_nationkey AS INT) AS opened_date, TRUE AS is_active, {_TIMES}
        FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey""",
    "products": f"""
        SELECT p_partkey AS product_id, p_brand AS product_code, p_name AS product_name,
               CASE p_type WHEN 'ECONOMY' THEN 'SAVINGS_ACCOUNT' WHEN 'STANDARD' THEN 'CURRENT_ACCOUNT'
                           WHEN 'PROMO' THEN 'PROMO' ELSE 'CREDIT_ACCOUNT' END AS product_type,
               upper(substr(r_name, 1, 3)) AS currency_code, p_size > 10 AS is_active, {_TIMES}
        FROM {{part}} JOIN {{region}} ON p_size % 5 = r_regionkey""",
    "merchants": f"""
        SELECT s_suppkey AS merchant_id, concat('M', CAST(s_suppkey AS VARCHAR(20))) AS merchant_code,
               s_name AS merchant_name, concat('Category ', CAST(s_nationkey AS VARCHAR(20))) AS merchant_category,
               concat('City ', CAST(s_nationkey AS VARCHAR(20))) AS city, s_acctbal > 0 AS is_active, {_TIMES}
        FROM {{supplier}}""",
    "customers": f"""
        SELECT c_custkey AS customer_id, concat('C', CAST(c_custkey AS VARCHAR(20))) AS customer_code,
               c_name AS full_name, DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT) AS date_of_birth,
               CASE c_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender,
               CASE WHEN c_acctbal > 0 THEN concat('+', CAST(c_custkey AS VARCHAR(20))) END AS phone_number,
               CASE WHEN c_nationkey > 10 THEN concat(CAST(c_custkey AS VARCHAR(20)), '@example.com') END AS email,
               concat('City ', CAST(c_nationkey AS VARCHAR(20))) AS city,
               nullif(c_mktsegment, 'BUILDING') AS customer_segment, 'VERIFIED' AS kyc_status, {_TIMES}
        FROM {{customer}}""",
    "accounts": f"""
        SELECT c_custkey AS account_id, concat('A', CAST(c_custkey AS VARCHAR(20))) AS account_number,
               c_custkey - c_custkey % 2 AS customer_id, c_nationkey AS branch_id, c_custkey AS product_id,
               upper(substr(r_name, 1, 3)) AS currency_code,
               CASE WHEN c_acctbal < -500 THEN 'CLOSED' ELSE 'ACTIVE' END AS account_status,
               TIMESTAMP '1995-01-01 00:00:00' AS opened_at,
               CASE WHEN c_acctbal < 0 THEN TIMESTAMP '1999-12-31 23:59:59.999999' END AS closed_at,
               c_acctbal AS current_balance, {_TIMES}
        FROM {{customer}} JOIN {{region}} ON c_nationkey % 5 = r_regionkey""",
    "cards": f"""
        SELECT c_custkey AS card_id, concat('****', CAST(c_custkey AS VARCHAR(20))) AS masked_card_number,
               CAST(floor(c_custkey / 2) AS BIGINT) AS account_id, c_mktsegment AS card_type, 'ACTIVE' AS card_status,
               TIMESTAMP '1995-01-01 00:00:00' AS issued_at, TIMESTAMP '2005-01-01 00:00:00' AS expired_at, {_TIMES}
        FROM {{customer}}""",
    "transactions": """
        SELECT o_orderkey AS transaction_id, concat('T', CAST(o_orderkey AS VARCHAR(20))) AS transaction_reference,
               o_custkey AS source_account_id,
               CASE WHEN o_orderkey % 5 = 0 THEN CAST(floor(o_custkey / 2) AS BIGINT) END AS destination_account_id,
               CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS card_id,
               CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_orderkey % 10 END AS merchant_id,
               o_orderkey % 25 AS branch_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS channel_id,
               o_orderkey % 5 + 1 AS transaction_type_id, upper(substr(r_name, 1, 3)) AS currency_code,
               o_totalprice AS amount, o_totalprice * CAST(0.001 AS DOUBLE) AS fee_amount,
               CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'P' THEN 'FAILED'
                    WHEN o_orderpriority = '5-LOW' THEN 'UNKNOWN' ELSE 'PENDING' END AS status,
               CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' THEN 'LIMIT' END AS failure_reason,
               o_orderdate AS transaction_time, o_orderdate AS created_at,
               o_orderdate + INTERVAL '1' DAY AS updated_at
        FROM {orders} JOIN {region} ON o_custkey % 5 = r_regionkey""",
    "transaction_status_history": """
        SELECT event_id, user_id AS transaction_id,
               CASE event_type WHEN 'click' THEN 'view' WHEN 'purchase' THEN 'click'
                               WHEN 'signup' THEN 'purchase' WHEN 'error' THEN 'signup' END AS old_status,
               event_type AS new_status, ts AS event_time, 'events' AS source_system,
               ts AS created_at, ts AS updated_at
        FROM {events}""",
}

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "events")


def banking_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eleven tables as Spark frames over the parquet files."""
    inputs = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES}
    return {
        name: spark.sql(text, **{t: df for t, df in inputs.items() if f"{{{t}}}" in text})
        for name, text in SHAPES.items()
    }


def shape_sql(name: str) -> str:
    """The same table as ANSI SQL over views of the test tables' names."""
    return SHAPES[name].format_map({t: t for t in _TABLES}).strip()
