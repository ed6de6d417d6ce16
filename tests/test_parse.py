"""Line table tests: one case per grammar branch and quirk, both dialects."""

import pytest
from conftest import lines_df

from logsift.operators.parse import parse_log_lines
from logsift.operators.profile_parse import parse_profile_lines
from model import parse as model_parse

TS = "01.02.2024_10:00:00"
HTTP = "Mon,_5_Feb_2024_10:00:00_+0300"

# (line, record_type or None, extra expected fields)
JOB_CASES = [
    ("", None, {}),
    ("   \t ", None, {}),
    (f"SESSION_START {TS}", "SESSION_START", {"timestamp": TS}),
    (f"SESSION_START {TS} extra", "SESSION_START", {"timestamp": TS}),
    ("SESSION_START 31.02.2024_10:00:00", "SESSION_START", {"timestamp": "31.02.2024_10:00:00"}),
    ("SESSION_START", "UNPARSEABLE", {"parse_error": "missing timestamp", "raw_line": "SESSION_START"}),
    ("SESSION_START bad", "UNPARSEABLE", {"parse_error": "invalid timestamp: bad"}),
    (f"SESSION_END {TS}", None, {}),
    ("SESSION_END", "UNPARSEABLE", {"parse_error": "missing timestamp"}),
    (f"QS {TS} {{tax}}", "QUICK_SEARCH", {"timestamp": TS}),
    (f"QS {HTTP} {{}}", "QUICK_SEARCH", {"timestamp": HTTP}),
    (f"  \tQS {TS} {{a}}  ", "QUICK_SEARCH", {"timestamp": TS}),
    (f"\x01QS {TS} {{a}}", "QUICK_SEARCH", {"timestamp": TS}),
    ("QS", "UNPARSEABLE", {"parse_error": "missing timestamp"}),
    (f"QS {TS} ", "UNPARSEABLE", {"parse_error": f"invalid timestamp: {TS} "}),
    ("123 ACC_1 LAW_2 ACC_1", "SEARCH_RESULTS", {"document_ids": ["ACC_1", "LAW_2", "ACC_1"]}),
    ("-5", "SEARCH_RESULTS", {"document_ids": []}),
    ("7 xACC_45616y", "SEARCH_RESULTS", {"document_ids": ["ACC_45616"]}),
    (f"123 {TS}", "UNPARSEABLE", {"parse_error": "unknown token: 123"}),
    ("12a ACC_1", "UNPARSEABLE", {"parse_error": "unknown token: 12a"}),
    (f"DOC_OPEN {TS} 55 ACC_1", "DOCUMENT_OPEN", {"timestamp": TS, "document_id": "ACC_1"}),
    (f"DOC_OPEN {TS} 55 whatever", "DOCUMENT_OPEN", {"document_id": "whatever"}),
    ("DOC_OPEN  55 ACC_1", "DOCUMENT_OPEN_NO_TS", {"document_id": "ACC_1"}),
    ("DOC_OPEN 55 ACC_1 x y", "DOCUMENT_OPEN_NO_TS", {"document_id": "ACC_1"}),
    (f"DOC_OPEN {TS} 55", "UNPARSEABLE", {"parse_error": "DOC_OPEN: expected 4 tokens, got 3"}),
    (f"DOC_OPEN {TS} 55 A B", "UNPARSEABLE", {"parse_error": "DOC_OPEN: expected 4 tokens, got 5"}),
    ("DOC_OPEN 55", "UNPARSEABLE", {"parse_error": "invalid timestamp: 55"}),
    (f"CARD_SEARCH_START {TS} p1 p2", "CARD_SEARCH_START", {"timestamp": TS}),
    ("CARD_SEARCH_END", None, {}),
    (f"CARD_SEARCH_END {TS}", None, {}),
    ("CARD_SEARCH_END x", "UNPARSEABLE", {"parse_error": "CARD_SEARCH_END: unexpected tokens"}),
    (f"CARD_SEARCH_END {TS} y", "UNPARSEABLE", {"parse_error": "CARD_SEARCH_END: unexpected tokens"}),
    ("$0 ACC_45616", "CARD_SEARCH_QUERY", {"document_id": "ACC_45616", "query_text": None}),
    ("$134 note ACC_1 more", "CARD_SEARCH_QUERY", {"query_text": "note ACC_1 more", "document_id": None}),
    ("$134    ACC_1 ACC_2", "CARD_SEARCH_QUERY", {"query_text": "ACC_1 ACC_2"}),
    ("$134", "CARD_SEARCH_QUERY", {"query_text": None, "document_id": None}),
    ("$12x ACC_1", "UNPARSEABLE", {"parse_error": "unknown token: $12x"}),
    (f"﻿SESSION_START {TS}", "UNPARSEABLE", {"parse_error": f"unknown token: ﻿SESSION_START"}),
    ("GARBAGE x", "UNPARSEABLE", {"parse_error": "unknown token: GARBAGE", "raw_line": "GARBAGE x"}),
]


def test_job_dialect_cases(spark):
    lines = lines_df(spark, {"1": [c[0] for c in JOB_CASES]})
    got = {r.line_number: r.asDict() for r in parse_log_lines(lines).collect()}
    for i, (line, rtype, fields) in enumerate(JOB_CASES, start=1):
        if rtype is None:
            assert i not in got, (line, got.get(i))
            continue
        rec = got[i]
        assert rec["record_type"] == rtype, (line, rec)
        for k, v in fields.items():
            assert rec[k] == v, (line, k, rec)
        # the plain-Python model of the grammar agrees on every field
        m = model_parse(line)
        for k in ("record_type", "timestamp", "document_id", "document_ids", "query_text", "parse_error", "raw_line"):
            assert rec[k] == m[k], (line, k, rec[k], m[k])


PROFILE_CASES = [
    ("", "EMPTY", {"raw": ""}),
    (f"SESSION_END {TS}", "SESSION_END", {"timestamp": TS}),
    ("CARD_SEARCH_END", "CARD_SEARCH_END", {"timestamp": None}),
    (f"CARD_SEARCH_END {TS}", "CARD_SEARCH_END", {"timestamp": TS}),
    ("CARD_SEARCH_END x", "UNPARSEABLE", {"parse_error": "CARD_SEARCH_END with unexpected tokens"}),
    ("$12x ACC_1", "CARD_SEARCH_QUERY", {"card_param": "$12x", "document_id": "ACC_1"}),
    ("$0 some text", "CARD_SEARCH_QUERY", {"card_param": "$0", "query_text": "some text"}),
    (f"DOC_OPEN {TS} ACC_1", "DOCUMENT_OPEN_NO_TS", {"search_id": TS, "document_id": "ACC_1"}),
    (f"DOC_OPEN {TS} 7 ACC_1", "DOCUMENT_OPEN", {"search_id": "7", "document_id": "ACC_1"}),
    ("DOC_OPEN  7 ACC_1", "DOCUMENT_OPEN_NO_TS", {"search_id": "7", "document_id": "ACC_1"}),
    (f"DOC_OPEN {TS} 1 2 3", "UNPARSEABLE", {"parse_error": "DOC_OPEN token count=5"}),
    ("GARBAGE", "UNPARSEABLE", {"parse_error": "unknown command: 'GARBAGE'"}),
    ("it's", "UNPARSEABLE", {"parse_error": "unknown command: \"it's\""}),
    ("QS bad", "UNPARSEABLE", {"parse_error": "invalid timestamp: 'bad'"}),
    (f"QS {TS} {{tax}} ACC_1 x", "QUICK_SEARCH", {"query_text": "tax", "tail_raw": "ACC_1 x", "document_ids_inline": ["ACC_1"]}),
    (f"QS {TS} {{}}", "QUICK_SEARCH", {"query_text": "", "tail_raw": None}),
    (f"QS {TS} no braces", "QUICK_SEARCH", {"query_raw": "no braces", "query_text": None}),
    (f"QS {TS}", "QUICK_SEARCH", {"query_raw": ""}),
    (f"CARD_SEARCH_START {TS} p1 p2", "CARD_SEARCH_START", {"params": "p1 p2"}),
    (f"CARD_SEARCH_START {TS}", "CARD_SEARCH_START", {"params": None}),
    ("-12 ACC_1 B_2", "SEARCH_RESULTS", {"search_id": "-12", "document_count": 2}),
    (f"  QS {TS} {{x}}  ", "QUICK_SEARCH", {"raw": f"  QS {TS} {{x}}  "}),
]


def test_profile_dialect_cases(spark):
    lines = lines_df(spark, {"1": [c[0] for c in PROFILE_CASES]})
    got = {r.line_number: r.asDict() for r in parse_profile_lines(lines).collect()}
    assert len(got) == len(PROFILE_CASES)
    for i, (line, rtype, fields) in enumerate(PROFILE_CASES, start=1):
        rec = got[i]
        assert rec["record_type"] == rtype, (line, rec)
        for k, v in fields.items():
            assert rec[k] == v, (line, k, rec)


@pytest.mark.parametrize("sf", ["0.001"])
def test_fixture_record_counts(spark, sf):
    from logsift.sources.tables import log_lines_from_sf_dir

    rec = parse_log_lines(log_lines_from_sf_dir(spark, f"/root/testdata/sf{sf}"))
    counts = {r[0]: r[1] for r in rec.groupBy("record_type").count().collect()}
    assert counts == {
        "SESSION_START": 12, "QUICK_SEARCH": 191, "SEARCH_RESULTS": 280, "CARD_SEARCH_START": 103,
        "CARD_SEARCH_QUERY": 74, "DOCUMENT_OPEN": 138, "DOCUMENT_OPEN_NO_TS": 28, "UNPARSEABLE": 96,
    }
