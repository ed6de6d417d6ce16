"""Incremental compaction: only new files are read, each exactly once."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from logsift.plans import compaction
from logsift.plans.compaction import compact_new_files, manifest, new_files, read_compacted
from logsift.plans.job import run_metrics_job


def put(root, name, text):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "w") as f:
        f.write(text)


def lines_of(df):
    return sorted((r.source_file_id, r.line_number, r.line) for r in df.collect())


@pytest.fixture
def folders():
    base = tempfile.mkdtemp(prefix="logsift-compact-")
    os.makedirs(f"{base}/in")
    return f"{base}/in", f"{base}/table"


def test_a_second_run_reads_only_new_files(spark, folders):
    root, table = folders
    put(root, "1", "a\nb\n")
    put(root, "x [y] {z}/2", "c\n")
    put(root, "notes.txt", "no session\n")
    assert compact_new_files(spark, root, table) == {"files": 2, "lines": 3}
    assert compact_new_files(spark, root, table) == {"files": 0, "lines": 0}
    put(root, "x [y] {z}/3", "d\n\ne")
    put(root, "z/1", "copy\n")
    assert {os.path.basename(r.path) for r in new_files(spark, root, table).collect()} == {"3", "1"}
    assert compact_new_files(spark, root, table, max_files=1) == {"files": 2, "lines": 4}
    want = [("1", 1, "a"), ("1", 1, "copy"), ("1", 2, "b"), ("2", 1, "c"), ("3", 1, "d"), ("3", 2, ""), ("3", 3, "e")]
    assert lines_of(read_compacted(spark, table)) == want
    assert manifest(spark, table).agg(F.max("run"), F.count("*")).first()[:] == (3, 4)


@pytest.mark.parametrize("fail_at", ["lines", "manifest"])
def test_a_failed_run_leaves_every_file_in_the_table_once(spark, folders, monkeypatch, fail_at):
    root, table = folders
    put(root, "1", "a\n")
    compact_new_files(spark, root, table)
    put(root, "2", "b\nc\n")
    real = compaction.write_log_lines_table

    def broken(lines, path):
        n = real(lines, path)
        raise RuntimeError(f"lost after {n} lines")

    with monkeypatch.context() as m:
        m.setattr(compaction, "write_log_lines_table", broken if fail_at == "lines" else real)
        if fail_at == "manifest":
            m.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            compact_new_files(spark, root, table)
    assert os.path.exists(f"{table}/lines/run=2")  # written, not committed
    assert lines_of(read_compacted(spark, table)) == [("1", 1, "a")]
    put(root, "3", "d\n")
    assert compact_new_files(spark, root, table) == {"files": 2, "lines": 3}
    assert lines_of(read_compacted(spark, table)) == [("1", 1, "a"), ("2", 1, "b"), ("2", 2, "c"), ("3", 1, "d")]


def test_a_changed_file_is_an_error(spark, folders):
    root, table = folders
    put(root, "1", "a\n")
    compact_new_files(spark, root, table)
    put(root, "1", "a\nmore\n")
    with pytest.raises(Exception, match="changed after it was compacted"):
        compact_new_files(spark, root, table)


def test_no_files_and_no_table(spark, folders):
    root, table = folders
    assert compact_new_files(spark, root, table) == {"files": 0, "lines": 0}
    assert lines_of(read_compacted(spark, table)) == []


def test_the_metrics_job_reads_a_compacted_table(spark, folders):
    root, table = folders
    stamp = "01.02.2024_10:00:00"
    put(root, "1", f"CARD_SEARCH_START {stamp}\n$0 ACC_45616\njunk\n")
    compact_new_files(spark, root, table)
    put(root, "2", f"QS {stamp} {{x}}\n1 ACC_1\nDOC_OPEN {stamp} 1 ACC_1\n")
    compact_new_files(spark, root, table)
    out = tempfile.mkdtemp(prefix="logsift-out-")
    assert run_metrics_job(spark, table, out, source="compacted") == {"unparseable_lines": 1, "card_search_count": 1, "task2_rows": 1}
