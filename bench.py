"""Bench: time the headline queries on the ``events`` tables of one scale.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and
``BENCH_CPUS`` (default 8).  Each query runs to completion through the
``noop`` sink (every row computed, nothing collected); the first pass
warms the JVM and is discarded, the reported time is the best of the
next ``BENCH_REPEAT`` (default 3) passes.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logsift.config import local_session  # noqa: E402
from logsift.plans.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "parsed_records",
    "unparseable_lines",
    "card_search_count",
    "quick_search_opens",
    "session_summary",
    "profile_summary",
    "profile_record_types",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="logsift-bench")
    times = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)
        times[name] = round(min(run_once(spark, name, sf_dir) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
