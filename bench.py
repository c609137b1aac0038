"""Headline queries, timed; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
cores. Each query runs once to warm up and once for the clock; the whole result
is produced and thrown away by Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txlake.plans import load_queries  # noqa: E402
from txlake.session import build_session  # noqa: E402

HEADLINE = [
    "daily_summary",
    "customer_month_stats",
    "merchant_fee_settlement",
    "settlement_ledger",
    "tumbling_by_type",
    "sliding_by_type",
    "session_by_user",
    "inactivity_gaps",
    "trailing_fraud_alerts",
    "record_risk_rules",
    "late_split_dlq",
    "standardize_union",
    "validation_split",
    "quality_report",
    "quality_quarantine",
    "dedupe_keep_latest",
    "null_profile",
    "reconcile_verdict",
    "merge_upsert",
    "version_diff",
    "full_export",
    "incremental_append",
    "bucketed_upsert",
    "cdc_apply_one_batch",
    "compact_zorder",
    "medallion_gold",
    "stream_tumbling",
    "stream_fraud_batches",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    extra = {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}
    spark = build_session("bench", f"local[{cpus}]", int(cpus), extra)
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = load_queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {took[name]}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
