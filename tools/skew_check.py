"""Hot-session check: one session holds a third of all lines.

Writes a synthetic ``log_lines`` table into a fresh scratch folder, runs
Task 1 with the single-pass plan and with the chunked plan, and reads
Spark's event log (in the same scratch folder) for the largest window task
of each.  Usage: python tools/skew_check.py [lines] [chunk_rows]
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import tempfile
import time

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from logsift.operators import metrics  # noqa: E402
from logsift.operators.parse import parse_log_lines  # noqa: E402
from logsift.operators.sessions import session_events, session_sizes  # noqa: E402

VOCAB = [
    "CARD_SEARCH_START 01.02.2024_10:00:00", "$0 ACC_45616", "$3 text", "1 ACC_45616 ACC_1", "2 ACC_1 ACC_2",
    "QS 01.02.2024_10:00:00 {a}", "DOC_OPEN 01.02.2024_10:00:00 1 ACC_1", "DOC_OPEN  1 ACC_2",
    "SESSION_START 01.02.2024_10:00:00", "GARBAGE",
]


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    chunk_rows = int(sys.argv[2]) if len(sys.argv) > 2 else 100_000
    run = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", run)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sid = F.when(F.col("id") < n // 3, F.lit("0")).otherwise(((F.col("id") - n // 3) % 20000 + 1).cast("string"))
    pick = (F.pmod(F.xxhash64("id"), F.lit(len(VOCAB))) + 1).cast("int")
    spark.range(n).select(
        sid.alias("source_file_id"),
        (F.col("id") + 1).cast("int").alias("line_number"),
        F.element_at(F.array(*[F.lit(v) for v in VOCAB]), pick).alias("line"),
    ).write.parquet(f"{run}/log_lines")
    table = spark.read.parquet(f"{run}/log_lines")
    result = {}
    for label, rows in (("single_pass", 10 * n), ("chunked", chunk_rows)):
        spark.sparkContext.setJobGroup(label, label)
        t = time.time()
        events = session_events(parse_log_lines(table), chunk_rows=rows, sizes=session_sizes(table))
        result[label] = {"task1": metrics.card_search_count(events).collect()[0][1], "seconds": round(time.time() - t, 2)}
    spark.stop()

    group_of, reads = {}, collections.defaultdict(list)
    for path in glob.glob(f"{run}/eventlog_v2_*/events_*"):
        raw = open(path, "rb").read()
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read() if path.endswith(".zstd") else raw
        for line in text.decode().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    group_of[s] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            elif e["Event"] == "SparkListenerTaskEnd":
                shuffle = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics", {})
                reads[e["Stage ID"]].append(shuffle.get("Total Records Read", 0))
    for label in result:
        stages = [s for s in reads if group_of.get(s) == label]
        result[label]["largest_task_rows"] = max(max(reads[s]) for s in stages)
    print(json.dumps({"lines": n, "hot_session_lines": n // 3, "chunk_rows": chunk_rows, **result}))


if __name__ == "__main__":
    main()
