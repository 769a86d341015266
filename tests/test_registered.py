"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference
from runs import SF
from quayside.plans.oracles import oracles
from quayside.plans.registered import registered

QUERIES = registered()
SQL = oracles()


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    assert difference(QUERIES[name](spark, SF), oracle, SQL[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_another_time_zone_does_not_change_results(spark, oracle):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    for name in ("conform_types", "load_orders", "transaction_summary"):
        assert difference(QUERIES[name](other, SF), oracle, SQL[name]) is None
