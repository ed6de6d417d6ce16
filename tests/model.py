"""Plain-Python model of the log grammar and of the session metrics, used as
a brute-force check of the Spark plans on small generated inputs.

A dialect is a table of whole-line patterns: the first pattern that matches
the whole trimmed line names the record type (or the error text), and its
named groups are the record's columns.  Session facts are looked up per row
from the last earlier record of a kind; nothing is carried along a loop.
"""

from __future__ import annotations

import re
from collections import Counter
from datetime import date
from itertools import accumulate

CLOCK = r"\d{2}:\d{2}:\d{2}"
STD = rf"(\d{{2}})\.(\d{{2}})\.(\d{{4}})_{CLOCK}"
HTTP = rf"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),_(\d{{1,2}})_([A-Za-z]{{3}})_(\d{{4}})_{CLOCK}_\+\d{{4}}"
END = r"(?!\S)"  # the token ends here
TS = "(?:" + re.sub(r"\((?!\?)", "(?:", f"{STD}|{HTTP}") + ")" + END
DOC = r"[A-Z]+_\d+"
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
DROPPED, BAD = None, "UNPARSEABLE"

# (record type, whole-line pattern, error text); {0}, {1}: tokens, {n}: their number
JOB = [
    ("SEARCH_RESULTS", rf"-?\d+{END}(?!\s+{TS}).*", None),
    ("CARD_SEARCH_QUERY", rf"\$\d+{END}[\x00-\x20]*(?P<document_id>{DOC})", None),
    ("CARD_SEARCH_QUERY", rf"\$\d+{END}[\x00-\x20]*(?P<query_text>.*)", None),
    (DROPPED, rf"CARD_SEARCH_END(\s+{TS})?", None),
    (BAD, rf"CARD_SEARCH_END{END}.*", "CARD_SEARCH_END: unexpected tokens"),
    (BAD, rf"(?!(SESSION_START|SESSION_END|QS|DOC_OPEN|CARD_SEARCH_START){END}).*", "unknown token: {0}"),
    (BAD, r"\S+", "missing timestamp"),
    ("SESSION_START", rf"SESSION_START\s+(?P<timestamp>{TS}).*", None),
    ("CARD_SEARCH_START", rf"CARD_SEARCH_START\s+(?P<timestamp>{TS}).*", None),
    ("QUICK_SEARCH", rf"QS\s+(?P<timestamp>{TS}).*", None),
    (DROPPED, rf"SESSION_END\s+{TS}.*", None),
    ("DOCUMENT_OPEN", rf"DOC_OPEN\s+(?P<timestamp>{TS})\s+\S+\s+(?P<document_id>\S+)", None),
    (BAD, rf"DOC_OPEN\s+{TS}.*", "DOC_OPEN: expected 4 tokens, got {n}"),
    ("DOCUMENT_OPEN_NO_TS", r"DOC_OPEN\s+\S+\s+(?P<document_id>\S+).*", None),
    (BAD, r".*", "invalid timestamp: {1}"),
]
PROFILE = [
    ("EMPTY", r"", None),
    ("SEARCH_RESULTS", rf"(?P<search_id>-?\d+){END}(?!\s+{TS}).*", None),
    ("CARD_SEARCH_QUERY", rf"(?P<card_param>\$\d\S*){END}\s*(?P<document_id>{DOC})", None),
    ("CARD_SEARCH_QUERY", rf"(?P<card_param>\$\d\S*){END}\s*(?P<query_text>.*)", None),
    ("CARD_SEARCH_END", rf"CARD_SEARCH_END(\s+(?P<timestamp>{TS}))?", None),
    (BAD, rf"CARD_SEARCH_END{END}.*", "CARD_SEARCH_END with unexpected tokens"),
    (BAD, rf"(?!(SESSION_START|SESSION_END|QS|DOC_OPEN|CARD_SEARCH_START){END}).*", "unknown command: {0!r}"),
    (BAD, r"\S+", "missing timestamp"),
    ("SESSION_START", rf"SESSION_START\s+(?P<timestamp>{TS}).*", None),
    ("SESSION_END", rf"SESSION_END\s+(?P<timestamp>{TS}).*", None),
    ("CARD_SEARCH_START", rf"CARD_SEARCH_START\s+(?P<timestamp>{TS})\s*(?P<params>.*)", None),
    ("QUICK_SEARCH", rf"QS\s+(?P<timestamp>{TS})\s*\{{(?P<query_text>[^}}]*)\}}\s*(?P<tail_raw>.*)", None),
    ("QUICK_SEARCH", rf"QS\s+(?P<timestamp>{TS})\s*(?P<query_raw>.*)", None),
    ("DOCUMENT_OPEN", rf"DOC_OPEN\s+(?P<timestamp>{TS})\s+(?P<search_id>\S+)\s+(?P<document_id>\S+)", None),
    ("DOCUMENT_OPEN_NO_TS", rf"DOC_OPEN\s+(?P<search_id>{TS})\s+(?P<document_id>\S+)", None),
    (BAD, rf"DOC_OPEN\s+{TS}.*", "DOC_OPEN token count={n}"),
    ("DOCUMENT_OPEN_NO_TS", r"DOC_OPEN\s+(?P<search_id>\S+)\s+(?P<document_id>\S+).*", None),
    (BAD, r".*", "invalid timestamp: {1!r}"),
]


def _compiled(table, flags):
    return [(kind, re.compile(pattern, flags | re.DOTALL), error) for kind, pattern, error in table]


JOB = _compiled(JOB, re.ASCII)  # ASCII digits and whitespace
PROFILE = _compiled(PROFILE, 0)  # Python's own


def _first_match(table, raw):
    return next((kind, m.groupdict(), error) for kind, rx, error in table if (m := rx.fullmatch(raw)))


def parse(line):
    """Job dialect: dict, or None where the job keeps no record."""
    raw = line.strip("".join(map(chr, range(0x21))))
    kind, fields, error = _first_match(JOB, raw) if raw else (DROPPED, {}, None)
    if kind is DROPPED:
        return None
    parts = re.split(r"\s+", raw, flags=re.ASCII)
    rec = dict.fromkeys(("timestamp", "document_id", "query_text"))
    rec |= {name: value or None for name, value in fields.items()}
    return rec | {
        "record_type": kind,
        "document_ids": re.findall(DOC, raw, re.ASCII) if kind == "SEARCH_RESULTS" else [],
        "parse_error": error and error.format(*parts, n=len(parts)),
        "raw_line": raw if kind == BAD else None,
    }


PROFILE_TEXTS = ("timestamp", "search_id", "card_param", "document_id", "query_text", "params", "query_raw", "tail_raw")
NULL_IF_EMPTY = {("CARD_SEARCH_QUERY", "query_text"), ("CARD_SEARCH_START", "params"), ("QUICK_SEARCH", "tail_raw")}


def parse_profile(line):
    """Profile dialect: dict of the profile columns."""
    raw = line.strip()
    kind, fields, error = _first_match(PROFILE, raw)
    parts = raw.split()
    rec = dict.fromkeys(PROFILE_TEXTS)
    rec |= {name: None if value == "" and (kind, name) in NULL_IF_EMPTY else value for name, value in fields.items()}
    ids = re.findall(DOC, raw) if kind == "SEARCH_RESULTS" else None
    return rec | {
        "record_type": kind,
        "parse_error": error and error.format(*parts, n=len(parts)),
        "document_ids": ids,
        "document_count": ids if ids is None else len(ids),
        "document_ids_inline": None if rec["tail_raw"] is None else re.findall(DOC, rec["tail_raw"]),
    }


def date_of(token):
    """ISO date of a time stamp token; None for another token or an
    impossible date.  The calendar repeats every 400 years."""
    if m := re.fullmatch(STD, token or "", re.ASCII):
        day, month, year = (int(x) for x in m.groups())
    elif (m := re.fullmatch(HTTP, token or "", re.ASCII)) and m[2] in MONTHS:
        day, month, year = int(m[1]), MONTHS.index(m[2]) + 1, int(m[3])
    else:
        return None
    try:
        date(2000 + year % 400, month, day)
    except ValueError:
        return None
    return f"{year:04d}-{month:02d}-{day:02d}"


def _last_before(rows, kinds):
    """Per row, the index of the last earlier row of one of the kinds, or -1."""
    return list(accumulate(range(len(rows)), lambda at, i: i if rows[i]["record_type"] in kinds else at, initial=-1))


def session_facts(records, target="ACC_45616"):
    """One session's records in order -> (number of card blocks hit, set of
    (date, document) shown, Counter of (date, document) opened)."""
    rows = [r for r in records if r["record_type"] != BAD]
    of = {kind: [i for i, r in enumerate(rows) if r["record_type"] == kind] for kind in {r["record_type"] for r in rows}}
    control = _last_before(rows, {"CARD_SEARCH_START", "QUICK_SEARCH", "SEARCH_RESULTS"})
    quick = _last_before(rows, {"QUICK_SEARCH"})
    starts = set(of.get("CARD_SEARCH_START", ()))
    results = of.get("SEARCH_RESULTS", [])

    def mentions(r):
        return target in (r["document_id"], *r["document_ids"]) or target in (r["query_text"] or "")

    hit = {control[i] for i in of.get("CARD_SEARCH_QUERY", []) + results if mentions(rows[i])} & starts
    shown = {
        (date_of(rows[quick[i]]["timestamp"]), d)
        for i in results
        if control[i] not in starts and quick[i] >= 0
        for d in rows[i]["document_ids"]
    }
    own = next((date_of(rows[i]["timestamp"]) for i in of.get("SESSION_START", ())), None)
    opens = Counter((date_of(rows[i]["timestamp"]), rows[i]["document_id"]) for i in of.get("DOCUMENT_OPEN", ()))
    opens += Counter((own, rows[i]["document_id"]) for i in of.get("DOCUMENT_OPEN_NO_TS", ()))
    return (
        len(hit),
        {key for key in shown if key[0]},
        Counter({key: n for key, n in opens.items() if key[0] and key[1] is not None}),
    )


def task_results(sessions, target="ACC_45616"):
    """sessions: {sid: [records in order]} -> (task1, task2 rows sorted)."""
    facts = [session_facts(records, target) for records in sessions.values()]
    shown = set().union(*(s for _, s, _ in facts))
    opened = sum((o for _, _, o in facts), Counter())
    return sum(h for h, _, _ in facts), sorted((*key, n) for key, n in opened.items() if key in shown)
