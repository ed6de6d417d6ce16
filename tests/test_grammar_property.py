"""Random lines from an adversarial token vocabulary (Unicode whitespace,
non-ASCII digits, non-printable characters, quotes): both Spark parsers
against plain-Python models of the grammar."""

import random

from conftest import lines_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logsift.operators.parse import parse_log_lines
from logsift.operators.profile_parse import parse_profile_lines
from model import parse, parse_profile

TOKENS = [
    "SESSION_START", "SESSION_END", "QS", "DOC_OPEN", "CARD_SEARCH_START", "CARD_SEARCH_END", "GARBAGE", "qs",
    "01.02.2024_10:00:00", "31.02.2024_10:00:00", "Mon,_5_Feb_2024_10:00:00_+0300", "Mon,_5_feb_2024_10:00:00_+0300",
    "1.02.2024_10:00:00", "12", "-7", "007", "1x", "$0", "$134", "$12x", "$", "ACC_45616", "ACC_456160", "LAW_1",
    "xACC_1", "acc_1", "{tax}", "{}", "{a", "b}", "{x}ACC_2", "it's", 'say"', "back\\slash", "ФЗ_1",
    "١٢", "$٣", "ACC_٤٥", "٠١.٠٢.٢٠٢٤_١٠:٠٠:٠٠", "\ufeffSESSION_START", "a\x01b", "\u200bx", "\x7f", "é", "😀x",
    "it's\x01", "\ud7ff", "\U000e0001",
]
SEPS = [" ", "  ", "\t", " \t ", "\u00a0", "\u3000", "\x1c", " \u2028 "]


def _line(rnd):
    if rnd.random() < 0.05:
        return rnd.choice(["", "   ", "\t"])
    n = rnd.randint(1, 6)
    body = rnd.choice(SEPS).join(rnd.choice(TOKENS) for _ in range(n))
    return rnd.choice(["", " ", "\x01", "\u00a0"]) + body + rnd.choice(["", " ", "\t", "\u3000"])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(min_value=0, max_value=2**32 - 1))
def test_both_dialects_match_models(spark, seed):
    rnd = random.Random(seed)
    lines = [_line(rnd) for _ in range(400)]
    df = lines_df(spark, {"1": lines})
    job = {r["line_number"]: r.asDict() for r in parse_log_lines(df).collect()}
    prof = {r["line_number"]: r.asDict() for r in parse_profile_lines(df).collect()}
    # job dialect: the JVM grammar (ASCII whitespace and digits); profile
    # dialect: Python's whitespace, Unicode digits and repr()
    for i, line in enumerate(lines, start=1):
        m = parse(line)
        if m is None:
            assert i not in job, (line, job.get(i))
        else:
            got = {k: job[i][k] for k in m}
            assert got == m, (line, got, m)
        pm = parse_profile(line)
        got = {k: prof[i][k] for k in pm}
        assert got == pm, (line, got, pm)
