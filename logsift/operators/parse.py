"""Line classification, job dialect (operators P0-P10).

``parse_log_lines`` turns ``log_lines`` (source_file_id, line_number,
line, [source_path]) into ``records``: one row per line that yields a
record.  Blank lines, ``SESSION_END`` and well-formed ``CARD_SEARCH_END``
lines yield none.  First match wins, in this order: search results,
card query, known command, unknown token.

The whole parser is a chain of projections over built-in expressions.
The line is split once; the tokens needed downstream are pulled out in a
separate projection so the optimiser keeps a single ``split`` per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.functions import fixed
from logsift.functions.cache import session_cached
from logsift.functions.fence import fence
from logsift.functions.text import after_first_token, document_ids, token, tokens, trim_ascii, trim_python
from logsift.functions.timestamps import is_timestamp, is_timestamp_profile

RECORD_COLUMNS = (
    "record_type",
    "source_file_id",
    "line_number",
    "timestamp",
    "document_id",
    "document_ids",
    "query_text",
    "parse_error",
    "raw_line",
)

def tokenize(lines: DataFrame, *, keep_blank: bool = False, dialect: str = "job") -> DataFrame:
    """Trim, drop blank lines, split once and expose the first tokens.

    Output: the input columns plus ``raw`` (trimmed line), ``n_tokens``,
    ``t0``..``t3`` (null past the end) and ``t1_is_ts``.  The ``profile``
    dialect trims and splits on Python's whitespace and recognises
    timestamps with Unicode digits.
    """
    profile = dialect == "profile"
    base = list(lines.columns)
    if not keep_blank:
        lines = lines.filter(F.col("line").rlike(r"[^\x00-\x20]"))
    trim = trim_python if profile else trim_ascii
    trimmed = lines.withColumn("raw", trim(F.col("line")))
    split = trimmed.withColumn("_parts", tokens(F.col("raw"), fixed.P_TOKEN_SPLIT if profile else fixed.TOKEN_SPLIT))
    out = split.select(*base, "raw", *_token_exprs())
    return out.withColumn("t1_is_ts", is_timestamp_profile("t1") if profile else is_timestamp("t1"))


@session_cached
def _token_exprs() -> list[Column]:
    parts = F.col("_parts")
    return [F.size(parts).alias("n_tokens")] + [token(parts, i).alias(f"t{i}") for i in range(4)]


def _unparseable(reason: Column) -> Column:
    return F.struct(F.lit(fixed.UNPARSEABLE).alias("record_type"), reason.alias("parse_error"))


def _record(record_type: str) -> Column:
    return F.struct(F.lit(record_type).alias("record_type"), F.lit(None).cast("string").alias("parse_error"))


def _no_record() -> Column:
    return F.lit(None).cast("struct<record_type:string,parse_error:string>")


def classify(tok: DataFrame) -> DataFrame:
    """P5-P10 on a tokenized frame: adds ``record_type``/``parse_error``
    (both null for lines that yield no record)."""
    return tok.withColumn("_kind", _kind_expr()).select(
        "*",
        F.col("_kind.record_type").alias("record_type"),
        F.col("_kind.parse_error").alias("parse_error"),
    ).drop("_kind")


@session_cached
def _kind_expr() -> Column:
    """First match wins: results, card query, unknown token, known command."""
    t0, t1, n, t1_ts = F.col("t0"), F.col("t1"), F.col("n_tokens"), F.col("t1_is_ts")
    is_results = t0.rlike(fixed.SEARCH_ID_WHOLE) & ~t1_ts
    is_card_query = t0.rlike(fixed.CARD_PARAM_WHOLE)
    kind = (
        F.when(is_results, _record(fixed.SEARCH_RESULTS))
        .when(is_card_query, _record(fixed.CARD_SEARCH_QUERY))
        .when(~t0.isin(*fixed.KNOWN_COMMANDS), _unparseable(F.concat(F.lit(fixed.ERR_UNKNOWN_TOKEN), t0)))
        .when(
            t0 == fixed.CMD_CARD_SEARCH_END,
            F.when((n == 1) | ((n == 2) & t1_ts), _no_record()).otherwise(_unparseable(F.lit(fixed.ERR_CARD_END_TOKENS))),
        )
        .when(n < 2, _unparseable(F.lit(fixed.ERR_MISSING_TS)))
        .when(
            ~t1_ts,
            F.when((t0 == fixed.CMD_DOC_OPEN) & (n >= 3), _record(fixed.DOCUMENT_OPEN_NO_TS)).otherwise(
                _unparseable(F.concat(F.lit(fixed.ERR_INVALID_TS), t1))
            ),
        )
        .when(t0 == fixed.CMD_SESSION_START, _record(fixed.SESSION_START))
        .when(t0 == fixed.CMD_CARD_SEARCH_START, _record(fixed.CARD_SEARCH_START))
        .when(t0 == fixed.CMD_QS, _record(fixed.QUICK_SEARCH))
        .when(
            t0 == fixed.CMD_DOC_OPEN,
            F.when(n == 4, _record(fixed.DOCUMENT_OPEN)).otherwise(
                _unparseable(F.concat(F.lit(fixed.ERR_DOC_OPEN_TOKENS), n.cast("string")))
            ),
        )
        .otherwise(_no_record())  # SESSION_END with a timestamp
    )
    return kind


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """``log_lines`` -> ``records`` (schema of :data:`RECORD_COLUMNS`).

    A ``source_path`` input column (the tie-breaker for equal line numbers
    of one session) is carried along when present.
    """
    keys = tuple(c for c in ("source_file_id", "line_number", "source_path") if c in lines.columns)
    typed = classify(tokenize(lines.select(*keys, "line"))).drop("line", "n_tokens", "t1_is_ts")
    # tokens and type are fenced; the other columns are computed where used
    kept = fence(typed, *keys).filter(F.col("record_type").isNotNull())
    return kept.withColumn("_rest", _rest_expr()).select(*_record_exprs(keys[2:]))


@session_cached
def _rest_expr() -> Column:
    rest = after_first_token(F.col("raw"), F.col("t0"))
    return F.when(F.col("record_type") == fixed.CARD_SEARCH_QUERY, rest)


@session_cached
def _record_exprs(keep_columns: tuple[str, ...]) -> list[Column]:
    rt = F.col("record_type")
    rest_c = F.col("_rest")
    only_doc = rest_c.rlike(fixed.DOC_ID_WHOLE)
    return [
        rt,
        "source_file_id",
        F.col("line_number").cast("int").alias("line_number"),
        F.when(
            rt.isin(fixed.SESSION_START, fixed.CARD_SEARCH_START, fixed.QUICK_SEARCH, fixed.DOCUMENT_OPEN),
            F.col("t1"),
        ).alias("timestamp"),
        F.when(rt == fixed.CARD_SEARCH_QUERY, F.when(only_doc, rest_c))
        .when(rt == fixed.DOCUMENT_OPEN, F.col("t3"))
        .when(rt == fixed.DOCUMENT_OPEN_NO_TS, F.col("t2"))
        .alias("document_id"),
        F.when(rt == fixed.SEARCH_RESULTS, document_ids(F.col("raw")))
        .otherwise(F.array().cast("array<string>"))
        .alias("document_ids"),
        F.when((rt == fixed.CARD_SEARCH_QUERY) & ~only_doc & (rest_c != ""), rest_c).alias("query_text"),
        "parse_error",
        F.when(rt == fixed.UNPARSEABLE, F.col("raw")).alias("raw_line"),
        *[F.col(c) for c in keep_columns],
    ]


def unparseable_lines(records: DataFrame) -> DataFrame:
    """the reject table (source_file_id, line_number, parse_error, raw_line)."""
    return records.filter(F.col("record_type") == fixed.UNPARSEABLE).select(
        "source_file_id", "line_number", "parse_error", "raw_line"
    )
