"""Summaries of appended facts, kept up batch by batch.

For every batch of the facts a partial is stored: per group what the batch changed.  Facts
that are new count for their group; a fact that an earlier batch holds is taken out
of the group of its last row there.  Partials are sums, so a summary is their sum, and a
new batch costs its own rows and the earlier rows of the same keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.contracts import TableContract
from quayside.functions.frames import same_row
from quayside.operators.catalog import require_table, table_name
from quayside.operators.dedup import latest
from quayside.operators.sinks import read_table

_BATCH, _ATTEMPT = "_ingestion_batch_id", "_attempt"


@dataclass(frozen=True)
class Rollup:
    """Rows and sums of ``sums``, decimal columns of the facts, by ``by``: name to SQL expression."""

    name: str
    facts: TableContract
    by: dict[str, str]
    sums: tuple[str, ...]

    def grouped(self, rows: DataFrame) -> DataFrame:
        """The summary of given rows: the groups, ``n``, and the sums."""
        groups = [F.expr(e).alias(c) for c, e in self.by.items()]
        return rows.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("n"), *(F.sum(c).cast("decimal(38,2)").alias(c) for c in self.sums)
        )

    def added(self, partials: list[DataFrame]) -> DataFrame:
        """Partials of the same groups as one; groups without a row are gone.

        A sum is null where no row of the group has a value, so values are counted beside it.
        """
        whole = partials[0]
        for part in partials[1:]:
            whole = whole.unionByName(part)
        total = whole.groupBy(*self.by).agg(
            F.sum("n").alias("n"),
            *(F.sum(c).cast("decimal(38,2)").alias(c) for c in self.sums),
            *(F.sum(f"n_{c}").alias(f"n_{c}") for c in self.sums),
        )
        return total.where("n <> 0 OR " + " OR ".join([*(f"{c} <> 0" for c in self.sums), *(f"n_{c} <> 0" for c in self.sums)]))

    def partial(self, rows: DataFrame, sign: int) -> DataFrame:
        groups = [F.expr(e).alias(c) for c, e in self.by.items()]
        return rows.groupBy(*groups).agg(
            (sign * F.count(F.lit(1))).alias("n"),
            *((sign * F.coalesce(F.sum(c), F.lit(0))).cast("decimal(38,2)").alias(c) for c in self.sums),
            *((sign * F.count(c)).alias(f"n_{c}") for c in self.sums),
        )

    def columns(self, rows: DataFrame) -> str:
        groups = rows.select(*(F.expr(e).alias(c) for c, e in self.by.items())).schema
        kinds = [(f.name, f.dataType.simpleString()) for f in groups.fields]
        kinds += [("n", "bigint"), *((c, "decimal(38,2)") for c in self.sums), *((f"n_{c}", "bigint") for c in self.sums)]
        return ", ".join(f"`{c}` {k}" for c, k in kinds)


def current_facts(facts: DataFrame, key: str) -> DataFrame:
    """The last loaded row of each fact; frames that were never appended are taken as they are."""
    if "_ingested_at" not in facts.columns:
        return facts
    return latest(facts, [key], ["_ingested_at", _BATCH])


def _batches(spark: SparkSession, namespace: str, contract: TableContract) -> list[tuple[str, str]]:
    """Batches in the order they were loaded, each with a name for its published attempt."""
    table = require_table(spark, namespace, contract.name)
    rows = read_table(spark, namespace, contract)
    loaded = rows.groupBy(_BATCH).agg(F.min("_ingested_at").alias("at")).orderBy("at", _BATCH).collect()
    found = []
    for r in loaded:
        spec = f"_ingested_date = DATE'{r['at'].date()}', {_BATCH} = '{r[_BATCH]}'"
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})")
        folder = described.where("col_name = 'Location'").first()["data_type"]
        found.append((r[_BATCH], sha256(folder.encode()).hexdigest()[:16]))
    return found


def _change(rollup: Rollup, facts: DataFrame, batch: str, earlier: list[str]) -> DataFrame:
    """What a batch changes in the summary of the batches before it."""
    key = rollup.facts.key[0]
    new = latest(facts.where(F.col(_BATCH) == batch), [key], [])
    parts = [rollup.partial(new, 1)]
    if earlier:
        # Bounds of the batch's keys leave out files of facts that it cannot touch.
        bounds = new.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
        held = facts.where(F.col(_BATCH).isin(earlier))
        if bounds["lo"] is not None:
            inside = (F.col(key) >= F.lit(bounds["lo"])) & (F.col(key) <= F.lit(bounds["hi"]))
            # A fact without a key is one fact to ``latest`` too.
            held = held.where(inside | F.col(key).isNull())
        keys = new.select(key)
        before = latest(held.join(keys, same_row(held, keys, [key]), "left_semi"), [key], ["_ingested_at", _BATCH])
        parts.append(rollup.partial(before, -1))
    return rollup.added(parts)


def refresh(spark: SparkSession, namespace: str, rollup: Rollup) -> list[str]:
    """Store the partials that are missing; returns the batches they are of.

    Batches that were loaded again or are gone, and all after them, are done
    anew: what a later batch took out may be another row now.  A refresh that dies leaves whole
    partials only, and the next goes on from there.
    """
    facts = read_table(spark, namespace, rollup.facts)
    name = table_name(namespace, rollup.name)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({rollup.columns(facts)}, {_BATCH} string, {_ATTEMPT} string) "
        f"USING parquet PARTITIONED BY ({_BATCH}, {_ATTEMPT})"
    )
    held = {tuple(p.split("=", 1)[1] for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    batches = _batches(spark, namespace, rollup.facts)
    good = 0
    while good < len(batches) and batches[good] in held:
        good += 1
    for batch, attempt in held - set(batches[:good]):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_BATCH} = '{batch}', {_ATTEMPT} = '{attempt}')")
    for i, (batch, attempt) in enumerate(batches[good:], good):
        change = _change(rollup, facts, batch, [b for b, _ in batches[:i]])
        partition = f"PARTITION ({_BATCH} = '{batch}', {_ATTEMPT} = '{attempt}')"
        spark.sql(f"INSERT OVERWRITE {name} {partition} SELECT {{change}}.* FROM {{change}}", change=change)
        # A batch that changes nothing has a partition too.
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {partition}")
    return [b for b, _ in batches[good:]]


def summary(spark: SparkSession, namespace: str, rollup: Rollup) -> DataFrame:
    """The groups, ``n``, and the sums, from the stored partials."""
    stored = spark.table(require_table(spark, namespace, rollup.name)).drop(_BATCH, _ATTEMPT)
    sums = [F.when(F.col(f"n_{c}") > 0, F.col(c)).alias(c) for c in rollup.sums]
    return rollup.added([stored]).where("n > 0").select(*rollup.by, "n", *sums)
