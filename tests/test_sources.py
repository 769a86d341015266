from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runs import SF, run_on
from quayside.contracts import ContractError, Registry, TableContract, columns
from quayside.contracts.warehouse import WAREHOUSE
from quayside.operators.sinks import read_table
from quayside.plans.job import Ingest
from quayside.sources import FrameSource, JdbcSource, ParquetSource
from quayside.sources.ranges import KeyRange, range_predicates, split_ranges

ITEMS = TableContract(
    "items", columns("id bigint\ncode string\nupdated_at timestamp"), key=("id",), cluster=("id",)
)
CODES = TableContract("codes", columns("code string\nupdated_at timestamp"), key=("code",))
LINES = TableContract(
    "lines", columns("id bigint\nline bigint\nupdated_at timestamp"), key=("id", "line"), cluster=("id",)
)
NOTES = TableContract("notes", columns("code string\nkind string\nupdated_at timestamp"), key=("code", "kind"))
PACK = Registry("pack", (ITEMS, CODES, LINES, NOTES))


class SqlSource(JdbcSource):
    """The JDBC source with Spark itself in the database's place: same SQL, same predicates."""

    def query(self, sql):
        self.asked = [*getattr(self, "asked", []), sql]
        return self.spark.sql(sql)

    def scan(self, address, predicates):
        self.predicates = predicates
        return reduce(DataFrame.unionByName, [self.spark.table(address).where(p) for p in predicates])


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{spark.conf.get('spark.checkpoint.dir')}/{name}'")
    # Ids with a dense run, a wide gap and a far end: equal strides would put nearly all in one range.
    ids = spark.range(1000).select("id").union(spark.range(10**12, 10**12 + 500)).union(spark.range(-5, 0))
    ids.selectExpr("id", "concat('c', id) AS code", "timestamp_seconds(id % 1000) AS updated_at").write.saveAsTable(
        f"{name}.items"
    )
    spark.range(3).selectExpr("cast(id as string) AS code", "timestamp_seconds(id) AS updated_at").write.saveAsTable(
        f"{name}.codes"
    )
    # One code holds a third of the notes.
    spark.range(900).selectExpr(
        "if(id % 3 = 0, 'hot', concat('c', id)) AS code", "concat('k', id) AS kind", "timestamp_seconds(id) AS updated_at"
    ).write.saveAsTable(f"{name}.notes")
    # One id holds a third of the lines.
    spark.range(900).selectExpr(
        "if(id % 3 = 0, 7L, id) AS id", "id AS line", "timestamp_seconds(id) AS updated_at"
    ).write.saveAsTable(f"{name}.lines")
    return name


def source(spark, database, **options):
    return SqlSource(spark, "jdbc:none:", PACK, schema=database, **options)


def test_a_large_table_is_read_in_even_ranges(spark, database):
    jdbc = source(spark, database, rows_per_range=200)
    found = jdbc.read(ITEMS)
    assert found.select("id").distinct().count() == found.count() == 1505
    sizes = [spark.table(f"{database}.items").where(p).count() for p in jdbc.predicates]
    assert sum(sizes) == 1505
    assert len(sizes) >= 8
    assert max(sizes) <= 200


def test_a_hot_value_is_cut_by_the_next_key(spark, database):
    jdbc = source(spark, database, rows_per_range=60)
    found = jdbc.read(LINES)
    assert found.select("id", "line").distinct().count() == found.count() == 900
    sizes = [spark.table(f"{database}.lines").where(p).count() for p in jdbc.predicates]
    assert sum(sizes) == 900
    assert max(sizes) <= 61


def test_ranges_follow_the_rows_however_many(spark, database):
    jdbc = source(spark, database, rows_per_range=10)
    jdbc.read(ITEMS)
    assert 151 <= len(jdbc.predicates) <= 302


def test_a_small_table_is_one_statement(spark, database):
    jdbc = source(spark, database)
    assert jdbc.read(CODES).count() == 3
    assert jdbc.predicates == ["1 = 1"]


def test_a_table_without_a_numeric_key_is_read_in_ranges_of_its_text(spark, database):
    jdbc = source(spark, database, rows_per_range=2)
    assert sorted(r["code"] for r in jdbc.read(CODES).collect()) == ["0", "1", "2"]
    sizes = [spark.table(f"{database}.codes").where(p).count() for p in jdbc.predicates]
    assert (sum(sizes), max(sizes)) == (3, 2)


def test_a_hot_text_is_cut_by_the_next_key(spark, database):
    jdbc = source(spark, database, rows_per_range=60)
    found = jdbc.read(NOTES)
    assert found.select("code", "kind").distinct().count() == found.count() == 900
    sizes = [spark.table(f"{database}.notes").where(p).count() for p in jdbc.predicates]
    assert sum(sizes) == 900
    assert max(sizes) <= 120


def test_a_table_without_a_key_is_one_statement(spark, database):
    jdbc = source(spark, database, rows_per_range=2)
    assert jdbc.read(replace(CODES, key=())).count() == 3
    assert jdbc.predicates == ["1 = 1"]


def test_counts_and_probe(spark, database):
    jdbc = source(spark, database)
    assert jdbc.count("items") == 1505
    assert database in jdbc.probe(["items"])
    with pytest.raises(ContractError):
        jdbc.count("items; DROP TABLE items")


def test_a_window_sizes_its_own_ranges(spark, database):
    jdbc = source(spark, database, rows_per_range=200)
    found = jdbc.read_since(ITEMS, 900_000_000)
    wanted = spark.table(f"{database}.items").where("updated_at >= timestamp_seconds(900)")
    assert found.count() == wanted.count() == 100
    assert jdbc.predicates == ["1 = 1"]


def test_a_jdbc_load_needs_no_shuffle_when_read_by_its_cluster_key(spark, database, place):
    jdbc = source(spark, database, rows_per_range=200)
    assert jdbc.ranged_by(ITEMS) == ITEMS.cluster
    job = Ingest(spark, jdbc, PACK, *place, run=run_on(1))
    audit = {r["table_name"]: r for r in job.execute().collect()}
    assert {t: r["loaded_rows"] for t, r in audit.items()} == {"items": 1505, "codes": 3, "lines": 900, "notes": 900}
    assert read_table(spark, place[0], ITEMS).select("id").distinct().count() == 1505


def test_jdbc_reader_options(spark):
    """What reaches Spark's reader; no database is opened."""

    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, kind):
            self.seen["format"] = kind
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def options(self, **given):
            self.seen |= given
            return self

        def load(self):
            return self.seen

        def jdbc(self, url, table, predicates, properties):
            return url, table, predicates, properties

    class Session:
        read = Reader()

    jdbc = JdbcSource(Session(), "jdbc:x://h/db", PACK, properties={"user": "u"}, fetch_size=10)
    assert jdbc.query("SELECT 1") == {
        "format": "jdbc",
        "url": "jdbc:x://h/db",
        "user": "u",
        "fetchsize": "10",
        "query": "SELECT 1",
    }
    assert jdbc.scan("public.items", ["a", "b"]) == (
        "jdbc:x://h/db",
        "public.items",
        ["a", "b"],
        {"user": "u", "fetchsize": "10"},
    )


keys = st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=200)


@settings(max_examples=60, deadline=None)
@given(keys=keys, copies=st.integers(1, 50), per_range=st.integers(1, 60))
def test_ranges_cover_every_key_once_and_stay_small(keys, copies, per_range):
    held = sorted(keys + [keys[0]] * copies)

    def histogram(lo, hi, width):
        buckets = {}
        for k in held:
            if lo <= k <= hi:
                buckets.setdefault((k - lo) // width, []).append(k)
        return [KeyRange(min(b), max(b), len(b)) for b in buckets.values()]

    ranges = split_ranges(histogram, KeyRange(held[0], held[-1], len(held)), per_range)
    assert sum(r.rows for r in ranges) == len(held)
    assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))
    assert all(r.rows <= per_range or r.lo == r.hi for r in ranges)


def test_predicates_are_disjoint_and_hold_for_nulls(spark):
    ranges = [KeyRange(0, 9, 10), KeyRange(20, 29, 10), KeyRange(30, 30, 5)]
    assert range_predicates("k", ranges) == ["k < 20 OR k IS NULL", "k >= 20 AND k < 30", "k >= 30"]
    df = spark.createDataFrame([(k,) for k in (None, -1, 5, 19, 20, 29, 30, 99)], "k int")
    hits = [F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in range_predicates("k", ranges)]
    assert {r[0] for r in df.select(sum(hits, F.lit(0))).collect()} == {1}
    assert range_predicates("k", ranges[:1]) == ["1 = 1"]


def test_parquet_counts_and_sizes(spark):
    files = ParquetSource(spark, SF)
    assert files.count("orders") == spark.read.parquet(f"{SF}/orders.parquet").count()
    stored = (Path(SF) / "orders.parquet").stat().st_size
    assert files.size_bytes(files.read(WAREHOUSE["orders"])) == stored
    assert SF in files.probe(["no_such_table", "orders"])
    with pytest.raises(AnalysisException):
        files.probe(["no_such_table"])


def test_an_empty_folder_is_a_typed_table_without_rows(spark, place, tmp_path):
    (tmp_path / "items.parquet").mkdir()
    files = ParquetSource(spark, str(tmp_path))
    assert files.count("items") == 0
    assert files.read(ITEMS).schema == ITEMS.schema
    job = Ingest(spark, files, Registry("one", (ITEMS,)), *place, run=run_on(1))
    row = job.execute().first()
    assert (row["status"], row["source_rows"], row["loaded_rows"], row["n_columns"]) == ("OK", 0, 0, 3)


def test_a_table_of_several_files_is_their_union(spark, place):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.repartition(5).write.parquet(f"{place[1]}/orders.parquet")
    found = ParquetSource(spark, place[1]).read(WAREHOUSE["orders"])
    assert found.exceptAll(orders).isEmpty()
    assert orders.exceptAll(found).isEmpty()


def test_frames_know_their_tables(spark):
    frames = FrameSource({"items": spark.range(3)})
    assert frames.count("items") == 3
    with pytest.raises(ContractError):
        frames.count("codes")


@pytest.mark.parametrize("schema", ["public; DROP TABLE x", "a b", "", "a.b.c", "1x", 'p"'])
def test_a_schema_is_a_name(schema):
    with pytest.raises(ValueError):
        JdbcSource(None, "jdbc:x://h/db", PACK, schema=schema)
