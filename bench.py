"""Times the headline queries and prints one JSON line.

Settings by environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores),
BENCH_QUERIES (comma-separated names, default the headline set).
Each query is built, planned and run to the end into a sink that keeps nothing. The
first pass over all queries warms the session up; the best of the later passes counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.session import build_session  # noqa: E402
from workload.registry import REGISTERED  # noqa: E402

PASSES = 4
HEADLINE = (
    "messages_to_velocity",
    "type_transactions",
    "latest_state",
    "rule_velocity",
    "rule_zscore",
    "rule_large_amount",
    "rule_high_risk",
    "rule_multi_currency",
    "rule_fail_spike",
    "rules_all",
    "alert_tick",
    "rules_all_from_log",
    "alert_tick_from_log",
    "alert_feed",
    "volume_per_minute",
    "top_merchants",
    "type_breakdown",
    "ingestion_lag",
    "latency_quantiles",
    "health_summary",
    "rule_confusion",
    "apply_ledger",
    "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = dict.fromkeys(names, float("inf"))
    for attempt in range(PASSES):
        for name in names:
            start = time.perf_counter()
            REGISTERED[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                seconds[name] = min(seconds[name], round(time.perf_counter() - start, 3))
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "events": rows,
                "rows_per_sec": {n: round(rows / s) for n, s in seconds.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
