import os
import tempfile

from logsift.operators.parse import parse_log_lines
from logsift.sources.session_files import read_session_files
from logsift.streaming.ingest import start_record_ingest

TS = "01.02.2024_10:00:00"


def test_stream_ingest_matches_batch_parse(spark):
    root = tempfile.mkdtemp(prefix="logsift-stream-in-")
    for sid, text in {"1": f"SESSION_START {TS}\nQS {TS} {{x}}\n5 ACC_1\nGARBAGE\n", "2": "DOC_OPEN  1 ACC_1\n\n$0 ACC_45616\n"}.items():
        with open(os.path.join(root, sid), "w") as f:
            f.write(text)
    out = tempfile.mkdtemp(prefix="logsift-stream-out-")
    q = start_record_ingest(spark, root, f"{out}/records", checkpoint=f"{out}/_checkpoint", available_now=True)
    q.awaitTermination(120)
    streamed = sorted(tuple(r) for r in spark.read.parquet(f"{out}/records").drop("source_path").collect())
    batch = sorted(tuple(r) for r in parse_log_lines(read_session_files(spark, root)).drop("source_path").collect())
    assert streamed == batch and len(batch) == 6


def test_stream_ingest_picks_up_files_as_they_arrive(spark):
    root = tempfile.mkdtemp(prefix="logsift-stream-in-")
    out = tempfile.mkdtemp(prefix="logsift-stream-out-")
    q = start_record_ingest(spark, root, f"{out}/records", checkpoint=f"{out}/_checkpoint", processing_time="1 second")
    try:
        for batch in range(3):
            for s in range(batch * 5, batch * 5 + 5):
                with open(os.path.join(root, str(s)), "w") as f:
                    f.write(f"SESSION_START {TS}\nQS {TS} {{x}}\n{s} ACC_1\n")
            q.processAllAvailable()
        records = spark.read.parquet(f"{out}/records")
        assert records.count() == 15 * 3
        assert records.select("source_file_id").distinct().count() == 15
    finally:
        q.stop()


def test_restarted_ingest_goes_on_from_its_checkpoint(spark):
    root = tempfile.mkdtemp(prefix="logsift-stream-in-")
    out = tempfile.mkdtemp(prefix="logsift-stream-out-")
    for sid in ("1", "2"):
        with open(os.path.join(root, sid), "w") as f:
            f.write(f"SESSION_START {TS}\n")
        q = start_record_ingest(spark, root, f"{out}/records", checkpoint=f"{out}/_checkpoint", max_files_per_trigger=1, available_now=True)
        q.awaitTermination(120)
    assert sorted(r[0] for r in spark.read.parquet(f"{out}/records").select("source_file_id").collect()) == ["1", "2"]
