"""Session-file scan, sinks and the jobs, on real files in a scratch tree."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from logsift.functions import fixed
from logsift.plans.job import run_metrics_job, run_profile_job
from logsift.sources.session_files import read_profile_files, read_session_files
from logsift.sources.tables import log_lines_from_sf_dir

TS = "01.02.2024_10:00:00"


def _tree():
    root = tempfile.mkdtemp(prefix="logsift-files-")
    os.makedirs(f"{root}/a/b")
    os.makedirs(f"{root}/c")
    files = {
        "a/12": b"\xef\xbb\xbfSESSION_START x\r\nline2\rline3\n\nbad\xff\xc3 end\n",
        "a/b/12": b"other\n",
        "a/x1": b"not a session\n",
        "a/7": b"",
        "c/7": b"only\n\n",
        "c/8": b"no final break",
        "c/99999": b"big name\n",
    }
    for name, data in files.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
    return root


def test_scan_lines_breaks_bytes_and_names(spark):
    root = _tree()
    got = sorted(
        (r.source_file_id, r.source_path.split(root)[1], r.line_number, r.line)
        for r in read_session_files(spark, root).collect()
    )
    assert got == [
        ("12", "/a/12", 1, "﻿SESSION_START x"),
        ("12", "/a/12", 2, "line2"),
        ("12", "/a/12", 3, "line3"),
        ("12", "/a/12", 4, ""),
        ("12", "/a/12", 5, "bad�� end"),
        ("12", "/a/b/12", 1, "other"),
        ("7", "/c/7", 1, "only"),
        ("7", "/c/7", 2, ""),
        ("8", "/c/8", 1, "no final break"),
        ("99999", "/c/99999", 1, "big name"),
    ]


def test_profile_scan_is_flat_and_its_bound_an_option(spark):
    root = _tree()

    def names(**options):
        return {r[0] for r in read_profile_files(spark, f"{root}/c", **options).select("source_file_id").distinct().collect()}

    assert names() == {"7", "8", "99999"}
    assert names(name_pattern=fixed.PROFILE_FILE_NAME) == {"7", "8"}


def _write_sessions(spark, sf_dir):
    """Render the events fixture as one file per session in nested folders."""
    root = tempfile.mkdtemp(prefix="logsift-sessions-")
    pdf = log_lines_from_sf_dir(spark, sf_dir).toPandas().sort_values(["source_file_id", "line_number"])
    for sid, grp in pdf.groupby("source_file_id"):
        sub = f"{root}/part{int(sid) % 3}"
        os.makedirs(sub, exist_ok=True)
        with open(f"{sub}/{sid}", "w", encoding="utf-8", newline="") as f:
            f.write("\r\n".join(grp["line"]) + "\r\n")
    return root


def test_metrics_job_writes_reference_layout(spark):
    root = _write_sessions(spark, "/root/testdata/sf0.001")
    out = tempfile.mkdtemp(prefix="logsift-out-")
    counts = run_metrics_job(spark, root, out, single_file=True)
    assert counts == {"unparseable_lines": 96, "card_search_count": 7, "task2_rows": 58}
    for sub in ("unparseable_lines", "task2_quick_search_opens_csv"):
        assert len([p for p in os.listdir(f"{out}/{sub}") if p.endswith(".csv")]) == 1
    task1 = [p for p in os.listdir(f"{out}/task1_card_search_acc45616") if p.endswith(".csv")]
    assert len(task1) == 1
    with open(f"{out}/task1_card_search_acc45616/{task1[0]}") as f:
        assert f.read().splitlines() == ["document_id,card_search_count", "ACC_45616,7"]
    t2 = spark.read.parquet(f"{out}/task2_quick_search_opens")
    assert t2.columns == ["date", "document_id", "open_count"]
    rows = [tuple(r) for r in t2.collect()]
    assert rows == sorted(rows) and sum(r[2] for r in rows) == 62
    csv = spark.read.option("header", True).csv(f"{out}/task2_quick_search_opens_csv")
    assert csv.count() == 58
    # default: many writers; Task 2 part files in name order are globally sorted
    out2 = tempfile.mkdtemp(prefix="logsift-out-")
    assert run_metrics_job(spark, root, out2, keep="checkpoint") == counts
    parts = sorted(p for p in os.listdir(f"{out2}/task2_quick_search_opens") if p.endswith(".parquet"))
    in_order = [tuple(r) for p in parts for r in spark.read.parquet(f"{out2}/task2_quick_search_opens/{p}").collect()]
    assert in_order == sorted(in_order) and len(in_order) == 58


def test_empty_rejects_write_header_only(spark):
    root = tempfile.mkdtemp(prefix="logsift-clean-")
    with open(f"{root}/1", "w") as f:
        f.write(f"SESSION_START {TS}\nCARD_SEARCH_START {TS}\n$0 ACC_45616\n5 ACC_1\n")
    out = tempfile.mkdtemp(prefix="logsift-out-")
    counts = run_metrics_job(spark, root, out, single_file=True)
    assert counts["unparseable_lines"] == 0 and counts["card_search_count"] == 1
    parts = [p for p in os.listdir(f"{out}/unparseable_lines") if p.endswith(".csv")]
    text = "".join(open(f"{out}/unparseable_lines/{p}").read() for p in parts)
    assert text.splitlines() == ["source_file_id,line_number,parse_error,raw_line"]


def test_profile_job_writes_json_tables(spark):
    root = _write_sessions(spark, "/root/testdata/sf0.001")
    flat = tempfile.mkdtemp(prefix="logsift-flat-")
    for sub in os.listdir(root):
        for name in os.listdir(f"{root}/{sub}"):
            os.link(f"{root}/{sub}/{name}", f"{flat}/{name}")
    out = tempfile.mkdtemp(prefix="logsift-out-")
    run_profile_job(spark, flat, out, report="tables")
    summary = spark.read.json(f"{out}/profile/summary").collect()[0]
    assert summary["total_events"] + summary["empty_lines"] == 1000  # every rendered line is profiled
    assert summary["files_processed"] == 15
    types = spark.read.json(f"{out}/profile/record_types")
    assert types.agg(F.sum("records")).collect()[0][0] == summary["total_events"]
    import json

    samples = {(r["record_type"], r["sample_rank"]): json.loads(r["fields"]) for r in spark.read.json(f"{out}/profile/type_samples").collect()}
    assert list(samples[("SEARCH_RESULTS", 1)]) == ["search_id", "document_ids", "document_count"]
    assert not [t for t, _ in samples if t == "EMPTY"]
    assert list(samples[("DOCUMENT_OPEN", 1)]) == ["timestamp", "search_id", "document_id"]


def test_split_mode_numbers_lines_like_whole_mode(spark):
    root = tempfile.mkdtemp(prefix="logsift-split-")
    os.makedirs(f"{root}/x")
    with open(f"{root}/5", "w") as f:
        for i in range(1, 801):
            f.write(f"line {i}\n" if i % 7 else "\n")
    with open(f"{root}/x/5", "w", newline="") as f:
        f.write("".join(f"copy {i}\r\n" for i in range(1, 300)))
    with open(f"{root}/6", "wb") as f:
        f.write(b"a\rb\r\nc\n\nbad\xff end")
    whole = sorted(tuple(r) for r in read_session_files(spark, root).collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        split = sorted(tuple(r) for r in read_session_files(spark, root, mode="split").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert split == whole


def test_job_reads_table_and_streamed_records(spark):
    from logsift.sinks.writers import write_log_lines_table
    from logsift.streaming.ingest import start_record_ingest

    table = tempfile.mkdtemp(prefix="logsift-table-") + "/log_lines"
    write_log_lines_table(log_lines_from_sf_dir(spark, "/root/testdata/sf0.001"), table)
    out = tempfile.mkdtemp(prefix="logsift-out-")
    assert run_metrics_job(spark, table, out, source="table") == {"unparseable_lines": 96, "card_search_count": 7, "task2_rows": 58}

    root = _write_sessions(spark, "/root/testdata/sf0.001")
    ingest = tempfile.mkdtemp(prefix="logsift-ingest-")
    q = start_record_ingest(spark, root, f"{ingest}/records", checkpoint=f"{ingest}/_ckpt", available_now=True)
    q.awaitTermination(300)
    out2 = tempfile.mkdtemp(prefix="logsift-out-")
    assert run_metrics_job(spark, f"{ingest}/records", out2, source="records") == {
        "unparseable_lines": 96, "card_search_count": 7, "task2_rows": 58,
    }


def test_empty_input_writes_headers_and_zero(spark):
    root = tempfile.mkdtemp(prefix="logsift-empty-")
    with open(f"{root}/notes.txt", "w") as f:
        f.write("not a session\n")
    out = tempfile.mkdtemp(prefix="logsift-out-")
    assert run_metrics_job(spark, root, out) == {"unparseable_lines": 0, "card_search_count": 0, "task2_rows": 0}
    csv = [p for p in os.listdir(f"{out}/task2_quick_search_opens_csv") if p.endswith(".csv")]
    text = "".join(open(f"{out}/task2_quick_search_opens_csv/{p}").read() for p in csv)
    assert text.splitlines() == ["date,document_id,open_count"]


def test_missing_root_fails(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_session_files(spark, "/tmp/logsift-no-such-dir-" + os.urandom(4).hex()).collect()


BOM = b"\xef\xbb\xbf"


@pytest.mark.parametrize("block_bytes", ["3", "7", "64", "1048576"])
@pytest.mark.parametrize("decode", ["java", "python"])
def test_whole_split_and_auto_give_the_same_rows(spark, block_bytes, decode):
    """Byte-order marks, every line break, bad bytes and a missing last
    break, whatever the blocks; the size limit changes nothing."""
    texts = [
        b"SESSION_START 01.02.2024_10:00:00\nDOC_OPEN 5 ACC_1\n",
        b"a\rb\r\nc\n\nd\r\r\ne\r",
        b"\r\r\n\r",
        b"\n",
        b"bad\xff\xc3 end\n\xe2\x82\nx\xf0\x9f\x98",
        b"no break",
        b"",
        "ключ\r\nслово".encode() * 9,
    ]
    root = tempfile.mkdtemp(prefix="logsift-modes-")
    for i, text in enumerate(texts):
        for mark in (0, 1, 2):
            with open(f"{root}/{i}{mark}", "wb") as f:
                f.write(BOM * mark + text)

    def rows(**options):
        return sorted(tuple(r) for r in read_session_files(spark, root, decode=decode, **options).collect())

    whole = rows(mode="whole")
    assert ("01", 1, "\ufeffSESSION_START 01.02.2024_10:00:00") in {r[:3] for r in whole}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
    try:
        assert rows(mode="split") == whole
        assert rows(mode="auto", split_above_bytes=20) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("line_break", ["\r", "\n", "\r\n"])
def test_a_large_file_of_any_line_break_is_read_by_many_tasks(spark, line_break):
    root = tempfile.mkdtemp(prefix="logsift-cr-")
    n = 60_000
    with open(f"{root}/1", "w", newline="") as f:
        f.write("".join(f"line {i}{line_break}" for i in range(1, n + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        lines = read_session_files(spark, root, mode="auto", split_above_bytes=65536)
        wrong = lines.filter(F.col("line") != F.concat(F.lit("line "), F.col("line_number")))
        assert lines.count() == n and wrong.count() == 0
        blocks = spark.read.text(root).groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
        assert blocks[0] >= 10 and blocks[1] < n / 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_blocks_are_scanned_once(spark):
    root = tempfile.mkdtemp(prefix="logsift-once-")
    with open(f"{root}/1", "w") as f:
        f.write("line\n" * 500)
    lines = read_session_files(spark, root, mode="split").filter("line_number > 0")
    lines.collect()
    plan = lines._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert plan.count("ReusedExchange") == 1
    assert plan.count("FileScan text") == 2  # one of whole files, one of blocks


def test_malformed_utf8_is_replaced_like_a_java_reader(spark):
    """Expected strings are what java.io.BufferedReader over a UTF-8 decoder
    with CodingErrorAction.REPLACE returns for the same bytes (checked with
    the JDK): one U+FFFD per malformed sequence as the JDK delimits them."""
    cases = {
        b"\xf0\x9f\x98x": "A�xZ",
        b"\xe2\x82": "A�Z",
        b"\x80\x80": "A��Z",
        b"\xed\xa0\x80": "A�Z",
        b"\xf4\x90\x80\x80": "A����Z",
        b"\xc0\xaf": "A��Z",
        b"\xe2\x82\xac": "A€Z",
    }
    root = tempfile.mkdtemp(prefix="logsift-utf8-")
    for i, data in enumerate(cases, start=1):
        with open(f"{root}/{i}", "wb") as f:
            f.write(b"A" + data + b"Z\nnext\n")
    for mode in ("whole", "split"):
        got = {(int(r.source_file_id), r.line_number): r.line for r in read_session_files(spark, root, mode=mode).collect()}
        for i, expected in enumerate(cases.values(), start=1):
            assert got[(i, 1)] == expected, (mode, i, got[(i, 1)])
            assert got[(i, 2)] == "next"


def test_profile_reader_replaces_malformed_utf8_like_python(spark):
    root = tempfile.mkdtemp(prefix="logsift-utf8p-")
    data = b"A\xed\xa0\x80Z\n"
    with open(f"{root}/1", "wb") as f:
        f.write(data)
    line = read_profile_files(spark, root).collect()[0].line
    assert line == data.decode("utf-8", "replace").rstrip("\n")  # three U+FFFD, as Python decodes it
    assert read_session_files(spark, root).collect()[0].line == "A�Z"  # one, as a Java reader decodes it


def test_auto_mode_reads_each_file_once_by_size(spark):
    """Small files are read whole and large ones in blocks; together they
    give exactly the whole-mode lines."""
    root = tempfile.mkdtemp(prefix="logsift-auto-")
    os.makedirs(f"{root}/d")
    with open(f"{root}/1", "w") as f:
        f.write("SESSION_START 01.02.2024_10:00:00\r\nQS x\n")
    with open(f"{root}/d/2", "w") as f:
        f.write("".join(f"line {i}\n" for i in range(1, 2000)))
    with open(f"{root}/d/1", "w") as f:
        f.write("copy\n\nlast")
    whole = sorted(tuple(r) for r in read_session_files(spark, root, mode="whole").collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        auto = read_session_files(spark, root, mode="auto", split_above_bytes=100)
        got = sorted(tuple(r) for r in auto.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == whole and len(got) == 2 + 1999 + 3


def test_compacted_table_gives_the_same_metrics(spark):
    from logsift.plans.job import compact_session_files

    root = _write_sessions(spark, "/root/testdata/sf0.001")
    table = tempfile.mkdtemp(prefix="logsift-compact-") + "/log_lines"
    assert compact_session_files(spark, root, table) == 1000
    out = tempfile.mkdtemp(prefix="logsift-out-")
    assert run_metrics_job(spark, table, out, source="table") == {"unparseable_lines": 96, "card_search_count": 7, "task2_rows": 58}
