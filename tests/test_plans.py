"""Plan shape: the properties the design relies on at scale."""

import re
import tempfile

from pyspark.sql import functions as F

from logsift.operators.parse import parse_log_lines
from logsift.operators.metrics import document_opens
from logsift.operators.sessions import session_dates, session_events, session_sizes
from logsift.plans.catalog import QUERIES
from logsift.sinks.writers import write_log_lines_table
from logsift.sources.tables import log_lines_from_sf_dir, read_log_lines_table


def _table(spark):
    path = tempfile.mkdtemp(prefix="logsift-table-") + "/log_lines"
    write_log_lines_table(log_lines_from_sf_dir(spark, "/root/testdata/sf0.001"), path)
    return read_log_lines_table(spark, path)


def _physical(df):
    """Physical plan text without attribute ids (``col#12L`` -> ``col``)."""
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_parse_splits_each_line_once(spark):
    rec = parse_log_lines(_table(spark)).filter(F.col("record_type") != "UNPARSEABLE")
    optimized = rec._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("split(") == 1


def _final(df):
    """The plan that ran, after adaptive execution."""
    df.collect()
    plan = _physical(df)
    return plan[plan.index("Final Plan") : plan.index("Initial Plan")]


def test_session_scan_is_one_exchange_and_narrow(spark):
    lines = _table(spark)
    plan = _final(session_events(parse_log_lines(lines), sizes=session_sizes(lines)))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert "hashpartitioning(source_file_id" in plan
    # only the narrow columns cross the shuffle: no raw text, no query text
    exchange_line = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln][0]
    assert "raw" not in exchange_line and "query_text" not in exchange_line


def _jobs_of(spark, build):
    """Jobs that run while ``build`` is called."""
    sc = spark.sparkContext
    sc.setJobGroup("building", "plan building")
    try:
        built = build()
        return built, list(sc.statusTracker().getJobIdsForGroup("building"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_building_the_session_plans_runs_no_job(spark):
    lines = _table(spark)
    for chunk_rows in (1_000_000, 10, 1):
        _, jobs = _jobs_of(spark, lambda n=chunk_rows: session_events(parse_log_lines(lines), sizes=session_sizes(lines), chunk_rows=n))
        assert jobs == []
    _, jobs = _jobs_of(spark, lambda: session_events(parse_log_lines(lines)).count())
    assert jobs  # the tracker sees jobs of this group


def test_filters_and_columns_reach_the_scan(spark):
    lines = _table(spark)
    plan = _physical(lines.filter(F.col("source_file_id") == "3").select("line"))
    assert "PushedFilters: [IsNotNull(source_file_id), EqualTo(source_file_id,3)]" in plan
    assert "ReadSchema: struct<source_file_id:string,line:string>" in plan


def test_one_logical_plan_for_all_session_sizes(spark):
    lines = _table(spark)

    def shape(chunk_rows):
        plan = session_events(parse_log_lines(lines), sizes=session_sizes(lines), chunk_rows=chunk_rows)._jdf.queryExecution()
        return re.sub(r"#\d+L?|\b\d+\b", "", plan.optimizedPlan().toString())

    assert shape(1_000_000) == shape(10)


def test_large_sessions_are_exchanged_by_segment(spark):
    lines = _table(spark)
    plan = _final(session_events(parse_log_lines(lines), sizes=session_sizes(lines), chunk_rows=10))
    assert "hashpartitioning(source_file_id, chunk_line, chunk_part" in plan
    assert "BroadcastExchange" in plan


def test_registered_queries_stay_in_the_jvm_and_avoid_cross_joins(spark):
    banned = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF",
              "CartesianProduct", "BroadcastNestedLoopJoin")
    for name, fn in QUERIES.items():
        plan = _physical(fn(spark, "/root/testdata/sf0.001"))
        found = [b for b in banned if b in plan]
        assert not found, (name, found)


def test_a_session_filter_after_the_parser_reaches_the_scan(spark):
    records = parse_log_lines(_table(spark)).filter(F.col("source_file_id") == "3")
    assert "EqualTo(source_file_id,3)" in _physical(records)


def test_session_dates_and_opens_read_once_and_aggregate_by_hash(spark):
    records = parse_log_lines(_table(spark))
    for result, reads in ((session_dates(records), 1), (document_opens(records), 3)):
        plan = _final(result)
        # the opens' three uses read one exchange
        assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == reads - 1
        assert "SortAggregate" not in plan
        assert "regexp_extract_all" not in plan  # the id lists are not computed


def test_a_hot_sessions_undated_opens_are_split(spark):
    """A third of all rows are undated opens of one session: adaptive
    execution cuts its side of the join with the one start row."""
    rows = [("hot", 1, "SESSION_START 01.02.2024_10:00:00")]
    rows += [("hot", 2 + k, f"DOC_OPEN  1 ACC_{k}") for k in range(30_000)]
    rows += [(f"s{k % 3000}", 1 + k // 3000, "SESSION_START 02.02.2024_10:00:00" if k < 3000 else f"DOC_OPEN  1 ACC_{k}") for k in range(60_000)]
    lines = spark.createDataFrame(rows, "source_file_id string, line_number int, line string")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        opens = document_opens(parse_log_lines(lines))
        assert opens.agg(F.sum("open_count")).first()[0] == 30_000 + 57_000
        assert "skewed" in _final(opens)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
