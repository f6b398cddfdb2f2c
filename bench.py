"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     warm runs per query, of which the median counts (default 3)
BENCH_QUERIES  comma-separated names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import statistics
import time

import pyspark

from driftledger.plans.registry import QUERIES
from driftledger.session import build_session

HEADLINE = [
    "export_flatten", "json_project", "dedup_fact", "replay_landed", "total_fact_rows", "by_severity", "trend",
    "delta", "aging", "first_seen", "register_current", "register_transitions", "poam_status", "by_owner",
    "worst_overdue", "assess_controls", "control_evidence", "correlate", "uncovered", "stream_register",
]
SLOW = {"stream_register"}  # three deliveries through the load job: timed once


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "driftledger-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        if name not in SLOW:
            timed(spark, sf_dir, name)  # warm-up: code generation and file listing
        seconds[name] = round(statistics.median(timed(spark, sf_dir, name) for _ in range(1 if name in SLOW else runs)), 4)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "spark": pyspark.__version__,
                "cores": int(cpus),
                "shuffle_partitions": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
