"""Time the registered queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run to completion with every output column computed (``noop`` sink),
after one small warm-up query. Names given as arguments select queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from duebook.catalog import QUERIES

HEADLINE = [
    "join_inner_equi",
    "collections_by_portfolio_month",
    "collections_by_case_month",
    "running_collections",
    "join_scd2_rate",
    "fct_investing",
    "fct_servicing",
    "fct_servicing_daily_rate",
    "conform_contract",
    "dedupe_latest",
    "dq_evaluate",
    "dq_clean",
    "dq_quarantine",
    "dq_metrics",
    "dq_payments",
    "silver_cases",
    "pseudonymise",
    "mask_last4",
    "apply_pii_policy",
    "payment_gaps",
    "payment_gap_stats",
    "trailing_window_sums",
    "distinct_months_paid",
    "features_naive",
    "features_pit",
    "label_90d",
    "training_set",
    "training_set_backfill",
    "leakage_check",
    "measure_skew",
    "salted_join",
    "aggregate_skewed",
    "scan_landing_csv",
    "capture_malformed_rows",
    "ingest_cases",
    "table_health",
    "quarantine_append",
    "csv_roundtrip",
    "table_roundtrip",
    "inject_defects",
    "generate_payments",
    "snapshot_fingerprint",
    "ingest_payments",
    "features_from_buckets",
    "digests_by_month",
    "hot_keys",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("duebook-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(cpus)
    QUERIES["snapshot_fingerprint"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
