"""Per-stage task skew of one registered query, from Spark's event log.

Usage: python tools/skew_report.py QUERY [sf_dir] [--salt ROWS_PER_TASK]

Runs the query through the noop sink with broadcast joins off (so key joins
shuffle, as they do at scale), writes the event log to a fresh folder under
/tmp, and prints for the stages with the largest tasks: the largest task's
shuffle-read records and its ratio to the stage median.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loadwright.operators.skew import MIN_ROWS_CONF, ROWS_PER_TASK_CONF  # noqa: E402
from loadwright.queries import QUERIES  # noqa: E402
from loadwright.session import build_session  # noqa: E402


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
        return io.TextIOWrapper(raw, encoding="utf-8")
    return open(path, encoding="utf-8")


def main() -> None:
    args = sys.argv[1:]
    salt = None
    if "--salt" in args:
        i = args.index("--salt")
        salt = args[i + 1]
        args = args[:i] + args[i + 2:]
    name = args[0]
    sf = args[1] if len(args) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="run-skew-")
    extra = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": logdir,
    }
    if salt:
        extra.update({MIN_ROWS_CONF: "0", ROWS_PER_TASK_CONF: salt})
    spark = build_session("local[8]", 64, extra=extra)
    t0 = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    spark.stop()
    per_stage = collections.defaultdict(list)
    for path in glob.glob(os.path.join(logdir, "*", "events_*")) + glob.glob(os.path.join(logdir, "local-*")):
        for line in _lines(path):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                per_stage[e["Stage ID"]].append((m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0))
    rows = sorted(
        ((max(r), round(max(r) / max(1, statistics.median(r)), 1), sid, len(r))
         for sid, r in per_stage.items() if len(r) >= 8 and max(r) > 0),
        reverse=True,
    )
    print(json.dumps({"query": name, "salted": bool(salt), "sec": round(elapsed, 2),
                      "largest_tasks": [dict(zip(("records", "x_median", "stage", "tasks"), r)) for r in rows[:4]]}))


if __name__ == "__main__":
    main()
