"""Line classification, profile dialect (operators P11-P13).

Same grammar as the job dialect with richer fields and these differences:
blank lines, ``SESSION_END`` and ``CARD_SEARCH_END`` are kept as records
(``EMPTY`` and their own types); the card parameter only has to *start*
the first token; ``DOC_OPEN <ts> <id>`` is an open without timestamp whose
search id is the timestamp token; error texts differ; the raw line is kept
untrimmed.  Whitespace and digits follow Python (``str.split``,
``str.strip``, ``\\d`` = any Unicode decimal digit), as the reader of this
dialect is a Python script; the job dialect's JVM grammar uses ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.functions import fixed
from logsift.functions.cache import session_cached
from logsift.functions.fence import fence
from logsift.functions.text import after_first_token, after_two_tokens, document_ids, python_quoted, trim_python
from logsift.operators.parse import tokenize

PROFILE_COLUMNS = (
    "source_file_id",
    "line_number",
    "record_type",
    "raw",
    "parse_error",
    "timestamp",
    "search_id",
    "document_ids",
    "document_count",
    "card_param",
    "document_id",
    "query_text",
    "params",
    "query_raw",
    "document_ids_inline",
    "tail_raw",
)


def _kind(record_type: str, error: Column | None = None) -> Column:
    return F.struct(
        F.lit(record_type).alias("record_type"),
        (error if error is not None else F.lit(None).cast("string")).alias("parse_error"),
    )


def _bad(error: Column) -> Column:
    return _kind(fixed.UNPARSEABLE, error)


def parse_profile_lines(lines: DataFrame) -> DataFrame:
    """Every line (blank ones as ``EMPTY``) -> one profile record."""
    staged = tokenize(lines, keep_blank=True, dialect="profile")
    kind, *pieces = _stages()
    # tokens and kind are fenced; the other columns are computed where used
    staged = fence(staged.withColumn(*kind).drop("t1_is_ts"), *lines.columns)
    for name, expr in pieces:
        staged = staged.withColumn(name, expr)
    return staged.select(*_profile_exprs())


@session_cached
def _stages() -> list[tuple[str, Column]]:
    """Intermediate columns, in order: the record kind, then the pieces of
    quick-search, card-start and card-query lines (computed on those only)."""
    t0, t1, n, t1_ts = F.col("t0"), F.col("t1"), F.col("n_tokens"), F.col("t1_is_ts")
    kind = (
        F.when(F.col("raw") == "", _kind(fixed.EMPTY))
        .when(t0.rlike(fixed.P_SEARCH_ID_WHOLE) & ~t1_ts, _kind(fixed.SEARCH_RESULTS))
        .when(t0.rlike(fixed.P_CARD_PARAM_PREFIX), _kind(fixed.CARD_SEARCH_QUERY))
        .when(~t0.isin(*fixed.KNOWN_COMMANDS), _bad(F.concat(F.lit(fixed.PERR_UNKNOWN_COMMAND), python_quoted(t0))))
        .when(
            t0 == fixed.CMD_CARD_SEARCH_END,
            F.when((n == 1) | ((n == 2) & t1_ts), _kind(fixed.CARD_SEARCH_END)).otherwise(
                _bad(F.lit(fixed.PERR_CARD_END_TOKENS))
            ),
        )
        .when(n < 2, _bad(F.lit(fixed.PERR_MISSING_TS)))
        .when(
            ~t1_ts,
            F.when((t0 == fixed.CMD_DOC_OPEN) & (n >= 3), _kind(fixed.DOCUMENT_OPEN_NO_TS)).otherwise(
                _bad(F.concat(F.lit(fixed.PERR_INVALID_TS), python_quoted(t1)))
            ),
        )
        .when(t0 == fixed.CMD_SESSION_START, _kind(fixed.SESSION_START))
        .when(t0 == fixed.CMD_SESSION_END, _kind(fixed.SESSION_END))
        .when(t0 == fixed.CMD_CARD_SEARCH_START, _kind(fixed.CARD_SEARCH_START))
        .when(t0 == fixed.CMD_QS, _kind(fixed.QUICK_SEARCH))
        .when(n == 4, _kind(fixed.DOCUMENT_OPEN))
        .when(n == 3, _kind(fixed.DOCUMENT_OPEN_NO_TS))
        .otherwise(_bad(F.concat(F.lit(fixed.PERR_DOC_OPEN_TOKENS), n.cast("string"))))
    )
    rt = F.col("_kind.record_type")
    raw = F.col("raw")
    return [
        ("_kind", kind),
        (
            "_tail2",
            F.when(rt.isin(fixed.QUICK_SEARCH, fixed.CARD_SEARCH_START), after_two_tokens(raw, fixed.P_AFTER_TWO_TOKENS)),
        ),
        ("_ids", F.when(rt == fixed.SEARCH_RESULTS, document_ids(raw, fixed.P_DOC_ID))),
        ("_rest", F.when(rt == fixed.CARD_SEARCH_QUERY, after_first_token(raw, t0, trim_python))),
        ("_body", F.when(rt == fixed.QUICK_SEARCH, F.col("_tail2"))),
        ("_braced", F.col("_body").rlike(fixed.P_QS_BRACE)),
        ("_tail", F.when(F.col("_braced"), trim_python(F.regexp_extract("_body", fixed.P_QS_BRACE_BODY, 2)))),
    ]


@session_cached
def _profile_exprs() -> list[Column]:
    t0, t1, n = F.col("t0"), F.col("t1"), F.col("n_tokens")
    rt = F.col("_kind.record_type")
    is_card = rt == fixed.CARD_SEARCH_QUERY
    is_qs = rt == fixed.QUICK_SEARCH
    rest_c, tail = F.col("_rest"), F.col("_tail")
    only_doc = rest_c.rlike(fixed.P_DOC_ID_WHOLE)
    no_ts_open = rt == fixed.DOCUMENT_OPEN_NO_TS
    return [
        F.col("source_file_id"),
        F.col("line_number").cast("int").alias("line_number"),
        rt.alias("record_type"),
        F.col("line").alias("raw"),
        F.col("_kind.parse_error").alias("parse_error"),
        F.when(
            rt.isin(fixed.SESSION_START, fixed.SESSION_END, fixed.CARD_SEARCH_START, fixed.QUICK_SEARCH, fixed.DOCUMENT_OPEN)
            | ((rt == fixed.CARD_SEARCH_END) & (n == 2)),
            t1,
        ).alias("timestamp"),
        F.when(rt == fixed.SEARCH_RESULTS, t0)
        .when(rt == fixed.DOCUMENT_OPEN, F.col("t2"))
        .when(no_ts_open, t1)
        .alias("search_id"),
        F.col("_ids").alias("document_ids"),
        F.when(rt == fixed.SEARCH_RESULTS, F.size("_ids")).alias("document_count"),
        F.when(is_card, t0).alias("card_param"),
        F.when(is_card, F.when(only_doc, rest_c))
        .when(rt == fixed.DOCUMENT_OPEN, F.col("t3"))
        .when(no_ts_open, F.col("t2"))
        .alias("document_id"),
        F.when(is_card & ~only_doc & (rest_c != ""), rest_c)
        .when(is_qs & F.col("_braced"), F.regexp_extract("_body", fixed.P_QS_BRACE_BODY, 1))
        .alias("query_text"),
        F.when((rt == fixed.CARD_SEARCH_START) & (F.col("_tail2") != ""), F.col("_tail2")).alias("params"),
        F.when(is_qs & ~F.col("_braced"), F.col("_body")).alias("query_raw"),
        F.when(is_qs & (tail != ""), document_ids(tail, fixed.P_DOC_ID)).alias("document_ids_inline"),
        F.when(is_qs & (tail != ""), tail).alias("tail_raw"),
    ]
