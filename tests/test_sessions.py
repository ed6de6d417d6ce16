"""Session fold: hand-made transitions and a brute-force property check of
the window plans (single pass and chunked) against a plain-Python fold."""

import random

from conftest import lines_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logsift.operators import metrics
from logsift.operators.parse import parse_log_lines
from logsift.operators.sessions import session_dates, session_events, session_sizes, with_order_keys
from model import parse as model_parse
from model import task_results

TS = "01.02.2024_10:00:00"
TS2 = "02.02.2024_10:00:00"
T = "ACC_45616"


def run(spark, sessions, chunk_rows=1_000_000):
    rec = parse_log_lines(lines_df(spark, sessions))
    ev = session_events(rec, chunk_rows=chunk_rows)
    task1 = metrics.card_search_count(ev).collect()[0]["card_search_count"]
    task2 = [tuple(r) for r in metrics.quick_search_opens(ev).collect()]
    return task1, task2


def expected(sessions):
    parsed = {sid: [r for r in (model_parse(x) for x in ls) if r is not None] for sid, ls in sessions.items()}
    return task_results(parsed)


HAND = {
    # block closed by results that hold the target
    "1": [f"CARD_SEARCH_START {TS}", "$0 ACC_1", f"10 {T}"],
    # block closed by a quick search: the query text hit still counts (substring, Q1)
    "2": [f"CARD_SEARCH_START {TS}", f"$1 about {T}0", f"QS {TS} {{x}}", "11 ACC_2"],
    # second results after a card block go to the last quick search (Q4)
    "3": [f"QS {TS} {{x}}", f"CARD_SEARCH_START {TS}", "12 ACC_3", "13 ACC_4", f"DOC_OPEN {TS} 1 ACC_4"],
    # invalid quick-search date blocks attribution, no fallback to the older date (Q3)
    "4": [f"QS {TS} {{x}}", "14 ACC_5", "QS 31.02.2024_10:00:00 {y}", "15 ACC_6", f"DOC_OPEN {TS} 1 ACC_6"],
    # open without timestamp before SESSION_START takes the session date
    "5": ["DOC_OPEN  1 ACC_5", f"SESSION_START {TS}", f"QS {TS} {{x}}", "16 ACC_5"],
    # no SESSION_START: undated open is not counted; results before any quick search dropped (Q6)
    "6": ["17 ACC_7", "DOC_OPEN  1 ACC_7", f"QS {TS2} {{x}}", f"DOC_OPEN {TS} 1 ACC_7"],
    # a lone target id must match exactly; new card start closes the previous block
    "7": [f"CARD_SEARCH_START {TS}", f"$0 {T}0", f"CARD_SEARCH_START {TS}", f"$0 {T}", "CARD_SEARCH_END", f"18 ACC_1"],
    # block left open at end of session still counts
    "8": [f"CARD_SEARCH_START {TS}", f"$5 {T}"],
}


def test_hand_sessions(spark):
    exp = expected(HAND)
    assert exp[0] == 4  # sessions 1, 2, 7 (second block) and 8
    assert run(spark, HAND) == exp
    assert run(spark, HAND, chunk_rows=2) == exp


def test_session_dates_first_start_only(spark):
    sessions = {"1": ["SESSION_START 31.02.2024_10:00:00", f"SESSION_START {TS}"], "2": [f"QS {TS} {{}}"], "3": [f"SESSION_START {TS2}"]}
    got = {r[0]: r[1] for r in session_dates(parse_log_lines(lines_df(spark, sessions))).collect()}
    assert got == {"1": None, "2": None, "3": "2024-02-02"}


VOCAB = [
    f"CARD_SEARCH_START {TS}", f"CARD_SEARCH_START {TS2}", "CARD_SEARCH_END", f"$0 {T}", f"$0 {T}1", f"$3 see {T}1",
    "$3 other", "$7", f"1 {T} ACC_1", "2 ACC_1 ACC_2", "-3", f"QS {TS} {{a}}", f"QS {TS2} {{b}}",
    "QS 30.02.2024_10:00:00 {c}", f"DOC_OPEN {TS} 1 ACC_1", f"DOC_OPEN {TS2} 1 ACC_2", "DOC_OPEN  1 ACC_1",
    "DOC_OPEN  1 ACC_2", f"SESSION_START {TS}", f"SESSION_START {TS2}", "SESSION_START 31.02.2024_10:00:00",
    "", "GARBAGE", f"SESSION_END {TS}",
]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(min_value=0, max_value=2**32 - 1))
def test_random_sessions_match_fold(spark, seed):
    rnd = random.Random(seed)
    sessions = {str(s): [rnd.choice(VOCAB) for _ in range(rnd.randint(0, 25))] for s in range(40)}
    exp = expected(sessions)
    assert run(spark, sessions) == exp
    assert run(spark, sessions, chunk_rows=rnd.choice([1, 2, 3, 5])) == exp


def test_copies_of_one_session_are_ordered_by_path(spark):
    """Equal base names in several directories form one session; rows are
    ordered by (line, path hash, path), and the chunked plan that splits
    the copies gives the same result as the single pass."""
    rnd = random.Random(7)
    rows = []
    for c in range(6):
        for i in range(rnd.randint(3, 12)):
            rows.append(("9", i + 1, rnd.choice(VOCAB), f"/data/d{c}/9"))
    lines = spark.createDataFrame(rows, "source_file_id string, line_number int, line string, source_path string")
    rec = parse_log_lines(lines)
    ordered = with_order_keys(rec).orderBy("line_number", "path_rank", "source_path").collect()
    keys = {"record_type", "timestamp", "document_id", "document_ids", "query_text", "parse_error", "raw_line"}
    exp = task_results({"9": [{k: r[k] for k in keys} for r in ordered]})
    for chunk_rows in (1_000_000, 4, 1):
        ev = session_events(rec, chunk_rows=chunk_rows)
        got1 = metrics.card_search_count(ev).collect()[0][1]
        got2 = [tuple(r) for r in metrics.quick_search_opens(ev).collect()]
        assert (got1, got2) == exp, chunk_rows


def test_fixture_task_numbers(spark):
    from logsift.sources.tables import log_lines_from_sf_dir

    rec = parse_log_lines(log_lines_from_sf_dir(spark, "/root/testdata/sf0.001"))
    ev = session_events(rec)
    assert metrics.card_search_count(ev).collect()[0][1] == 7
    agg = metrics.quick_search_opens(ev).agg(F.count("*"), F.sum("open_count")).collect()[0]
    assert tuple(agg) == (58, 62)


def test_hot_session_is_split_into_bounded_chunks(spark):
    """One session (three copies of one file name) holds a third of all
    rows; with a small chunk size its rows are spread over bounded window
    groups and the result equals the plain-Python fold."""
    from pyspark.sql import Window

    from logsift.operators.sessions import _chunked, large_sessions, relevant_events, session_sizes

    rnd = random.Random(11)
    rows = []
    for c in range(3):
        for i in range(400):
            rows.append(("1", i + 1, rnd.choice(VOCAB), f"/d{c}/1"))
    for s in range(2, 122):
        for i in range(20):
            rows.append((str(s), i + 1, rnd.choice(VOCAB), f"/d0/{s}"))
    lines = spark.createDataFrame(rows, "source_file_id string, line_number int, line string, source_path string")
    rec = parse_log_lines(lines)
    chunk_rows = 50
    large = large_sessions(session_sizes(lines), chunk_rows)
    assert {r[0] for r in large.collect()} == {"1"}
    groups = _chunked(relevant_events(rec), large).groupBy("source_file_id", "chunk_line", "chunk_part").count()
    assert groups.agg(F.max("count")).collect()[0][0] <= chunk_rows
    assert groups.filter(F.col("source_file_id") == "1").count() > 20

    ordered = with_order_keys(rec).withColumn(
        "_i", F.row_number().over(Window.partitionBy("source_file_id").orderBy("line_number", "path_rank", "source_path"))
    ).collect()
    keys = ("record_type", "timestamp", "document_id", "document_ids", "query_text", "parse_error", "raw_line")
    by_session = {}
    for r in sorted(ordered, key=lambda r: (r["source_file_id"], r["_i"])):
        by_session.setdefault(r["source_file_id"], []).append({k: r[k] for k in keys})
    exp = task_results(by_session)
    ev = session_events(rec, chunk_rows=chunk_rows, sizes=session_sizes(lines))
    assert metrics.card_search_count(ev).collect()[0][1] == exp[0]
    assert [tuple(r) for r in metrics.quick_search_opens(ev).collect()] == exp[1]


def test_the_largest_sessions_are_cut_when_too_many_are_large(spark):
    """More large sessions than may be listed: the largest are cut, any other
    is small against the input; results equal the plain fold either way."""
    from logsift.operators.sessions import large_sessions, session_sizes

    rnd = random.Random(3)
    sessions = {str(s): [rnd.choice(VOCAB) for _ in range(30 + 20 * (s in (4, 7)))] for s in range(12)}
    lines = lines_df(spark, sessions)
    rec = parse_log_lines(lines)
    assert large_sessions(session_sizes(lines), 10).count() == 12
    exp = expected(sessions)
    for listed in (1, 2, 5):
        large = {r.source_file_id for r in large_sessions(session_sizes(lines), 10, max_listed=listed).collect()}
        assert len(large) == listed and large <= {"4", "7"} if listed < 3 else large >= {"4", "7"}
        ev = session_events(rec, chunk_rows=10, sizes=session_sizes(lines), max_listed=listed)
        assert metrics.card_search_count(ev).collect()[0][1] == exp[0]
        assert [tuple(r) for r in metrics.quick_search_opens(ev).collect()] == exp[1]


def test_fixture_task_numbers_sf001(spark):
    from logsift.operators.parse import unparseable_lines
    from logsift.sources.tables import log_lines_from_sf_dir

    lines = log_lines_from_sf_dir(spark, "/root/testdata/sf0.01")
    rec = parse_log_lines(lines)
    ev = session_events(rec, sizes=session_sizes(log_lines_from_sf_dir(spark, "/root/testdata/sf0.01", fenced=False)))
    assert metrics.card_search_count(ev).collect()[0][1] == 73
    assert tuple(metrics.quick_search_opens(ev).agg(F.count("*"), F.sum("open_count")).collect()[0]) == (336, 1395)
    assert unparseable_lines(rec).count() == 1183
