"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Read-only queries are
evaluated completely through the ``noop`` sink (no collect to the driver);
sink and job queries write fresh tables each time.  Every query is warmed up
once and the median of ``$BENCH_REPEAT`` runs is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terrace.plans.registry import QUERIES  # noqa: E402
from terrace.session import build_session  # noqa: E402

READ_QUERIES = (
    "gold_daily_metrics",
    "point_in_time_join",
    "rule_flags",
    "quality_log",
    "quarantine_reasons",
    "discard_counts",
    "full_row_dedup",
    "tenant_isolation",
    "routine_extract",
)
WRITE_QUERIES = (
    "upsert_fact_state",
    "replace_partitions_state",
    "run_status",
)


def evaluate(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="terrace-bench")
    times: dict[str, float] = {}
    for name in READ_QUERIES + WRITE_QUERIES:
        if only and name not in only:
            continue
        fn = QUERIES[name]
        evaluate(fn(spark, sf_dir))
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            evaluate(fn(spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "master": f"local[{cpus}]",
        "spark": spark.version,
        "shuffle_partitions": 2 * cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
