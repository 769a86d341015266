from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.contracts import Reference, Registry, Rule, TableContract, columns
from quayside.functions import frames
from quayside.functions.frames import lookup_join
from quayside.functions.ranks import in_ranges, known_rows, ranked
from quayside.operators import quality
from quayside.operators.dedup import latest
from quayside.operators.history import chain_breaks
from quayside.operators.incremental import changed_since, not_yet_loaded
from quayside.operators.money import round_to_currency
from quayside.operators.reconcile import counts, reconcile
from quayside.operators.standardise import accepted, rejected, standardise
from quayside.operators.summaries import branch_balances, customer_balances
from quayside.sources.ranges import ordered_predicates, ordered_shares


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ACCOUNTS = TableContract(
    "accounts",
    columns("account_id bigint\ncustomer_id bigint\nstatus string?\nreason string?"),
    key=("account_id",),
    references=(Reference("customer_id", "customers", "customer_id"),),
    rules=(
        Rule("status_accepted", "status NOT IN ('OK', 'FAILED')"),
        Rule("reason_only_when_failed", "reason IS NOT NULL AND NOT (status <=> 'FAILED')"),
    ),
    modified=None,
)
CUSTOMERS = TableContract("customers", columns("customer_id bigint"), key=("customer_id",), modified=None)
PACK = Registry("pack", (CUSTOMERS, ACCOUNTS))


@pytest.fixture
def accounts(spark):
    return spark.createDataFrame(
        [
            (1, 1, "OK", None),
            (1, 9, "UNKNOWN", "x"),
            (2, None, None, "y"),
            (3, 9, "FAILED", "z"),
        ],
        ACCOUNTS.schema,
    )


def test_nulls_of_required_columns(accounts):
    assert bag(quality.nulls(accounts, ACCOUNTS)) == [
        ("accounts", "account_id", 0),
        ("accounts", "customer_id", 1),
    ]


def test_rules_say_nothing_of_nulls_they_do_not_name(accounts):
    assert bag(quality.rule_breaches(accounts, ACCOUNTS)) == [
        ("accounts", "reason_only_when_failed", 2),
        ("accounts", "status_accepted", 1),
    ]


def test_repeated_keys(accounts):
    assert bag(quality.repeated_keys(accounts, ACCOUNTS)) == [(1, 2)]


def test_repeated_keys_are_counted_in_as_many_tasks_as_the_rows_ask_for(spark, monkeypatch):
    monkeypatch.setattr(quality, "ROWS", 100, raising=False)
    keys = [i // 2 if i < 600 else -1 if i < 990 else None if i < 995 else i for i in range(1000)]
    accounts = spark.createDataFrame([(k,) for k in keys], "account_id bigint")
    found = quality.repeated_keys(accounts, ACCOUNTS)
    assert found.rdd.getNumPartitions() == 10
    assert {tuple(r) for r in found.collect()} == {(i, 2) for i in range(300)} | {(-1, 390), (None, 5)}
    assert found.schema == quality.repeated_keys(accounts.limit(50), ACCOUNTS).schema


def test_orphans_leave_out_nulls(spark, accounts):
    customers = spark.createDataFrame([(1,)], CUSTOMERS.schema)
    found = quality.orphans({"accounts": accounts, "customers": customers}, PACK)
    assert bag(found) == [("accounts", "customer_id", "customers", 1, 2)]


def test_orphans_count_a_hot_value_before_a_large_join(spark):
    hot = spark.range(0, 10_000, 1, 8).selectExpr("id AS account_id", "if(id % 3 = 0, -1, id) AS customer_id")
    customers = spark.range(0, 5_000).withColumnRenamed("id", "customer_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = quality.orphans({"accounts": hot, "customers": customers}, PACK)
        text = plan(found)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert text.index("LeftAnti") < text.index("partial_count(1)")
        wanted = hot.where("customer_id = -1 OR customer_id >= 5000")
        row = found.first()
        assert (row["n_values"], row["n_rows"]) == (wanted.select("customer_id").distinct().count(), wanted.count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_latest_row_per_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "b"), (1, 3, "c"), (2, None, "d"), (2, 1, "e"), (None, 1, "f")],
        "id int, at int, v string",
    )
    assert bag(latest(df, ["id"], ["at"])) == [(1, 3, "c"), (2, 1, "e"), (None, 1, "f")]


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS at")
    found = latest(df, ["k"], ["at"])
    text = plan(found)
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]
    assert found.where("k = 0").first()["at"] == 99_999


def history(spark, n=200):
    """Four transactions, one with a third of all events, one event in six out of chain."""
    kinds = ["NEW", "CHECKED", "DONE"]
    rows, last = [], {}
    for i in range(n):
        key = 0 if i % 3 == 0 else i % 4
        old = last.get(key) if i % 6 else "LOST"
        last[key] = kinds[i % 3]
        rows.append((i, key, old, last[key], datetime(2024, 1, 1 + i // 24 % 28, i % 24)))
    return spark.createDataFrame(
        rows, "event_id long, transaction_id long, old_status string, new_status string, event_time timestamp"
    ).repartition(5)


def test_first_event_has_no_old_status(spark):
    df = spark.createDataFrame(
        [
            (1, 1, None, "A", datetime(2024, 1, 1)),
            (2, 1, "A", "B", datetime(2024, 1, 1)),
            (3, 2, "A", "B", datetime(2024, 1, 1)),
        ],
        "event_id long, transaction_id long, old_status string, new_status string, event_time timestamp",
    )
    assert [(r["event_id"], r["expected_status"]) for r in chain_breaks(df).collect()] == [(3, None)]


def by_lag(events):
    """Breaks by a plain window over each transaction."""
    walk = Window.partitionBy("transaction_id").orderBy("event_time", "event_id", "new_status", "old_status")
    chained = events.withColumn("expected_status", F.lag("new_status").over(walk))
    return chained.where(~F.col("old_status").eqNullSafe(F.col("expected_status")))


@pytest.mark.parametrize("ranges", [1, 3, 8, 40])
def test_histories_cut_into_ranges_give_the_breaks_of_a_window(spark, ranges):
    events = history(spark)
    assert not by_lag(events).isEmpty()
    assert bag(chain_breaks(events, ranges)) == bag(by_lag(events))


def test_one_hot_transaction_is_walked_by_many_tasks(spark):
    events = history(spark, 300).withColumn("transaction_id", F.lit(5).cast("long"))
    assert bag(chain_breaks(events, 16)) == bag(by_lag(events))
    placed = in_ranges(events, [F.col("transaction_id"), F.col("event_time"), F.col("event_id")], 16)
    assert placed.select("_range").distinct().count() > 8


def test_copies_of_an_event_survive_the_cut(spark):
    events = history(spark, 60)
    copied = events.unionByName(events).unionByName(events.where("transaction_id = 0"))
    assert bag(chain_breaks(copied, 9)) == bag(by_lag(copied))
    assert chain_breaks(events.limit(0)).count() == 0


def test_events_of_no_transaction_are_cut_too(spark):
    events = history(spark, 90).withColumn(
        "transaction_id", F.when(F.col("transaction_id") != 0, F.col("transaction_id"))
    )
    assert not by_lag(events).where("transaction_id IS NULL").isEmpty()
    assert bag(chain_breaks(events, 7)) == bag(by_lag(events))


def test_ranks_of_rows_with_ties(spark):
    df = spark.range(0, 1000, 1, 7).select(F.expr("CASE WHEN id % 3 = 0 THEN 5 ELSE id % 50 END").alias("k"), "id")
    got = ranked(df, [F.col("k").desc()], 9).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 1001))
    assert [r["k"] for r in got] == sorted((r["k"] for r in got), reverse=True)
    assert sorted(r["id"] for r in got) == list(range(1000))
    assert ranked(df.limit(0), [F.col("k")], 9).count() == 0


def test_known_rows(spark):
    rows = [(1, None, True, "a'\"\\n"), (-(2**31), 2**63 - 1, False, None), (5, -(2**63), None, "é")]
    found = known_rows(spark, rows, "a int, b bigint, c boolean, d string")
    assert [tuple(r) for r in found.collect()] == rows
    assert known_rows(spark, [], "a int").collect() == []


def test_shares_of_a_text_key(spark):
    values = ["a"] * 3 + ["hot"] * 500 + [f"x{i:03}" for i in range(200)] + [None] * 9
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(6)
    shares = ordered_shares(df, "k", 10, 5).orderBy("lo").collect()
    assert sum(s["n_rows"] for s in shares) == 703
    assert ("hot", "hot", 500) in {(s["lo"], s["hi"], s["n_rows"]) for s in shares}
    assert all(s["n_rows"] <= 2 * 71 or s["lo"] == s["hi"] for s in shares)
    assert all(a["hi"] < b["lo"] for a, b in zip(shares, shares[1:]))
    statements = [p for p, _ in ordered_predicates("k", shares)]
    hits = df.select(sum((F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in statements), F.lit(0)).alias("n"))
    assert {r["n"] for r in hits.collect()} == {1}


def test_amounts_round_to_their_currency(spark):
    df = spark.createDataFrame(
        [
            (1, "VND", Decimal("10.50")),
            (2, "USD", Decimal("10.55")),
            (3, "KWD", Decimal("10.55")),
            (4, "JPX", Decimal("-2.50")),
            (5, None, Decimal("1.23")),
            (6, "ONE", Decimal("1.25")),
            (7, "VND", None),
        ],
        "id int, currency_code string, amount decimal(18,2)",
    )
    digits = spark.createDataFrame(
        [("VND", 0), ("USD", 2), ("KWD", 3), ("JPX", 0), ("ONE", 1)], "currency_code string, decimal_places long"
    )
    found = {r["id"]: r["amount"] for r in round_to_currency(df, digits, ["amount"]).collect()}
    assert found == {
        1: Decimal("11.00"),
        2: Decimal("10.55"),
        3: Decimal("10.55"),
        4: Decimal("-3.00"),
        5: Decimal("1.23"),
        6: Decimal("1.30"),
        7: None,
    }


def test_a_lookup_is_broadcast_only_within_its_bound(spark, monkeypatch):
    df, lookup = spark.range(100), spark.range(50).withColumn("v", F.lit(1))
    assert "BroadcastHashJoin" in plan(lookup_join(df, lookup, "id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bound, value in (("BROADCAST_ROWS", 10), ("BROADCAST_BYTES", 200)):
            with monkeypatch.context() as m:
                m.setattr(frames, bound, value)
                beyond = lookup_join(df, lookup, "id")
                assert "Broadcast" not in plan(beyond)
                assert beyond.where("v = 1").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_untidy_text_is_standardised_or_rejected(spark):
    wanted = TableContract(
        "t", columns("id bigint\ncode string\nprice decimal(18,2)?\non date?\nflag boolean?"), modified=None
    )
    df = spark.createDataFrame(
        [
            ("1", " usd ", "2.675", "2024-01-31", "true"),
            ("2", "eur", " ", "", None),
            ("x", "vnd", "1,5", "2024-02-30", "maybe"),
        ],
        "id string, code string, price string, on string, flag string",
    )
    done = standardise(df, wanted, upper=["code"])
    good = accepted(done).collect()
    assert [(r["id"], r["code"], r["price"]) for r in good] == [(1, "USD", Decimal("2.68")), (2, "EUR", None)]
    bad = rejected(done).collect()
    assert [(r["code"], r["_rejected"]) for r in bad] == [("VND", ["id", "price", "on", "flag"])]


def test_reconcile_tells_missing_tables(spark):
    source = counts({"a": spark.range(3), "b": spark.range(2)})
    target = counts({"a": spark.range(3), "c": spark.range(1)})
    assert bag(reconcile(source, target)) == [
        ("a", 3, 3, 0, True),
        ("b", 2, None, -2, False),
        ("c", None, 1, 1, False),
    ]


def test_the_window_is_pushed_down_and_the_comparison_is_a_hash_join(spark, place):
    wanted = TableContract("t", columns("id bigint\nv string?\nupdated_at timestamp"), key=("id",))
    spark.range(100).selectExpr("id", "string(id) v", "timestamp_seconds(id) updated_at").write.parquet(f"{place[1]}/t")
    df = spark.read.parquet(f"{place[1]}/t")
    window = changed_since(wanted, 90_000_000)
    found = not_yet_loaded(df.where(window), df.where("id < 95"), wanted, window)
    text = plan(found)
    assert "GreaterThanOrEqual(updated_at" in text
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert sorted(r["id"] for r in found.collect()) == [95, 96, 97, 98, 99]


def test_balances(spark):
    accounts = spark.createDataFrame(
        [
            (1, 1, 1, "X", Decimal("1.10")),
            (2, 1, 2, "X", Decimal("2.20")),
            (3, 2, 1, "Y", Decimal("-1.00")),
            (4, 9, 7, "X", Decimal("5.00")),
        ],
        "account_id long, customer_id long, branch_id long, currency_code string, current_balance decimal(18,2)",
    )
    branches = spark.createDataFrame([(1, "b1", "r"), (2, "b2", "r")], "branch_id long, branch_name string, region string")
    found = {
        (r["currency_code"], r["region"], r["branch_name"], r["level"]): r["balance"]
        for r in branch_balances(accounts, branches).collect()
    }
    assert found[("X", "r", None, 1)] == Decimal("3.30")
    assert found[("X", None, None, 0)] == Decimal("5.00")  # a branch that does not exist
    assert found[("X", None, None, 3)] == Decimal("8.30")
    customers = spark.createDataFrame(
        [(1, "a", "s"), (2, "b", "s"), (3, "c", "s")], "customer_id long, full_name string, customer_segment string"
    )
    held = customer_balances(accounts, customers).orderBy("customer_id").collect()
    assert [(r["customer_id"], r["n_accounts"], r["balance"]) for r in held] == [
        (1, 2, Decimal("3.30")),
        (2, 1, Decimal("-1.00")),
        (3, 0, Decimal("0.00")),
    ]
