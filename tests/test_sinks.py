"""Session-file sink, counts observed by the writes, session keys."""

import glob
import os
import tempfile

import pytest
from conftest import lines_df
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from logsift.plans.job import compact_session_files, run_metrics_job
from logsift.sinks.session_files import write_session_files
from logsift.sinks.writers import card_search_folder
from logsift.sources.session_files import read_session_files

TS = "01.02.2024_10:00:00"
COPIES = "source_file_id string, line_number int, line string, source_path string"


def new_folder(name):
    return tempfile.mkdtemp(prefix="logsift-sink-") + "/" + name


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_session_files_come_back(spark):
    sessions = {str(s): [f"line {i} é 한 \t" for i in range(s % 7 + 1)] for s in range(60)} | {"77": ["", "", "x", ""], "0007": ["a"]}
    lines = lines_df(spark, sessions)
    folder = new_folder("files")
    write_session_files(lines, folder)
    for mode in ("whole", "split", "auto"):
        back = read_session_files(spark, folder, mode=mode)
        assert rows_of(back, "source_file_id", "line_number", "line") == rows_of(lines, "source_file_id", "line_number", "line")
    assert os.path.exists(f"{folder}/_SUCCESS") and not glob.glob(f"{folder}/_attempt*")
    names = [os.path.basename(p) for p in glob.glob(f"{folder}/part-*/*")]
    assert sorted(names) == sorted(sessions)


def test_copies_of_a_session_stay_files_of_their_own(spark):
    rows = [("9", i + 1, f"{d} {i}", f"/data/{d}/9") for d in "abc" for i in range(4)] + [("9", 1, "no path", None)]
    folder = new_folder("copies")
    write_session_files(spark.createDataFrame(rows, COPIES), folder)
    back = read_session_files(spark, folder)
    assert rows_of(back, "source_file_id", "line_number", "line") == sorted(r[:3] for r in rows)
    assert back.select("source_path").distinct().count() == 4


def test_null_lines_are_empty_and_no_lines_give_no_files(spark):
    folder = new_folder("null")
    write_session_files(spark.createDataFrame([("1", 1, None), ("1", 2, "x")], "source_file_id string, line_number int, line string"), folder)
    assert rows_of(read_session_files(spark, folder), "line_number", "line") == [(1, ""), (2, "x")]
    empty = new_folder("empty")
    write_session_files(lines_df(spark, {"1": ["x"]}).limit(0), empty)
    assert os.listdir(empty) == ["_SUCCESS"]


@pytest.mark.parametrize("rows", [[("1", 2, "gap")], [("1", 1, "a\nb")], [("1", 1, "a\rb")], [("1", 1, "twice"), ("1", 1, "twice")]])
def test_lines_that_would_not_come_back_are_an_error(spark, rows):
    folder = new_folder("bad")
    os.makedirs(folder)
    with pytest.raises(Exception, match="session 1"):
        write_session_files(spark.createDataFrame(rows, "source_file_id string, line_number int, line string"), folder)
    assert not os.path.exists(f"{folder}/_SUCCESS")
    assert read_session_files(spark, folder).count() == 0  # what the attempt left is not listed


def test_job_counts_are_those_of_the_written_rows_without_reading_them(spark, monkeypatch):
    lines = lines_df(spark, {"1": [f"QS {TS} {{x}}", "1 ACC_1 ACC_2", f"DOC_OPEN {TS} 1 ACC_1", "junk", "junk 2"], "2": [f"CARD_SEARCH_START {TS}", "$0 XY_7", "3 ACC_9"]})
    table, out = new_folder("table"), new_folder("out")
    lines.write.parquet(table)
    read = []
    for kind in ("csv", "parquet", "json", "text"):
        real = getattr(DataFrameReader, kind)
        monkeypatch.setattr(DataFrameReader, kind, lambda self, path, *a, _real=real, **k: (read.append(path), _real(self, path, *a, **k))[1])
    counts = run_metrics_job(spark, table, out, source="table", target="XY_7")
    assert not [p for p in read if str(p).startswith(out)]
    monkeypatch.undo()
    csv = spark.read.option("header", True).csv
    assert counts == {"unparseable_lines": 2, "card_search_count": 1, "task2_rows": 1}
    assert csv(f"{out}/unparseable_lines").count() == 2
    assert [tuple(r) for r in csv(f"{out}/task1_card_search_xy7").collect()] == [("XY_7", "1")]
    assert spark.read.parquet(f"{out}/task2_quick_search_opens").count() == csv(f"{out}/task2_quick_search_opens_csv").count() == 1


def test_card_search_folder_follows_the_target():
    assert card_search_folder("ACC_45616") == "task1_card_search_acc45616"
    assert card_search_folder("Law_12") == "task1_card_search_law12"


def test_session_key_path_keeps_equal_names_apart(spark):
    root = tempfile.mkdtemp(prefix="logsift-key-")
    for d, text in (("a", f"CARD_SEARCH_START {TS}\n"), ("b", "\n$0 ACC_45616\n1 ACC_1\n")):
        os.makedirs(f"{root}/{d}")
        with open(f"{root}/{d}/7", "w") as f:
            f.write(text)
    by_name, by_path = new_folder("name"), new_folder("path")
    # as one session the start of one file opens a block for the other's query
    assert run_metrics_job(spark, root, by_name)["card_search_count"] == 1
    assert run_metrics_job(spark, root, by_path, session_key="path")["card_search_count"] == 0
    for mode in ("whole", "split"):
        keyed = read_session_files(spark, root, mode=mode, session_key="path")
        assert keyed.select("source_file_id").distinct().count() == 2
        assert keyed.filter(F.col("source_file_id") != F.col("source_path")).count() == 0
    table = new_folder("compact")
    assert compact_session_files(spark, root, table, session_key="path") == 4 == spark.read.parquet(table).count()
    with pytest.raises(ValueError, match="session_key"):
        read_session_files(spark, root, session_key="folder")


def test_a_bucketed_events_table_needs_no_session_exchange(spark):
    from logsift.operators import metrics
    from logsift.operators.parse import parse_log_lines
    from logsift.operators.sessions import session_events
    from logsift.sinks.writers import write_events_table
    from logsift.sources.tables import log_lines_from_sf_dir

    events = session_events(parse_log_lines(log_lines_from_sf_dir(spark, "/root/testdata/sf0.001")))
    name = "session_events_" + os.urandom(4).hex()
    write_events_table(events, name, new_folder("events"), buckets=8)
    try:
        table = spark.table(name)
        summary = metrics.session_summary(table)
        got = rows_of(summary, *summary.columns)
        plan = summary._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        assert got == rows_of(metrics.session_summary(events), *summary.columns)
        joined = table.join(spark.table(name).filter("hit").select("source_file_id").distinct(), "source_file_id", "left_semi")
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        assert metrics.card_search_count(table).first()["card_search_count"] == 7
    finally:
        spark.sql(f"DROP TABLE {name}")
