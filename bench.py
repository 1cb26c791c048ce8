"""Benchmark: run the headline load queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default the headline set),
BENCH_REPEAT (default 1; the best of N runs is reported), BENCH_WARM_DIR
(default /root/testdata/sf0.001: every query runs once there before timing).

Each query runs to completion through the ``noop`` sink: the full plan is
executed and no rows go to the driver.  Queries that exercise a sink write
their table as part of the query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadwright.queries import QUERIES  # noqa: E402
from loadwright.session import build_session  # noqa: E402

HEADLINE = [
    "upsert",
    "upsert_dedup",
    "upsert_accumulate",
    "upsert_partial",
    "upsert_partitioned",
    "upsert_partitioned_table",
    "latest_per_key",
    "upsert_hot_key",
    "upsert_accumulate_hot_key",
    "update_where",
    "update_from",
    "delete_where",
    "delete_from",
    "append_distinct",
    "full_refresh",
    "not_in_null_aware",
    "history_load",
    "swap_in",
    "with_sequence",
    "with_sequence_hot_key_salted",
    "run_load_upsert",
    "delete_partitioned",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            # One machine: keep every core busy rather than filling 256 MB
            # partitions (the cluster setting in session.CLUSTER_CONF).
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
        },
    )
    # Warm-up: JVM start, class loading and code generation are not part of
    # any query's time, so every query runs once on the smallest tables first.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_load_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
