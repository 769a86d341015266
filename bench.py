"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from quayside.plans.registered import registered

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "scan_full",
    "source_counts",
    "conform_decimal",
    "add_lineage",
    "load_lineitem",
    "load_orders",
    "load_documents",
    "load_banking_transactions",
    "load_banking_transaction_status_history",
    "truncate_load",
    "append_load",
    "full_load_audit",
    "full_load_banking_audit",
    "dry_run_audit",
    "reconcile_counts",
    "incremental_load",
    "dedup_latest",
    "standardise_accepted",
    "quality_nulls",
    "quality_keys",
    "quality_orphans",
    "status_chain",
    "currency_round",
    "transaction_summary",
    "branch_balances",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("quayside-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    queries["load_region"](spark, SF_DIR).collect()  # start the JVM's paths once

    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        seconds[name] = round(best, 3)

    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, best of two, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "lineitem_rows_per_sec": round(rows / seconds["load_lineitem"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
