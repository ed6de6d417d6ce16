"""The registered queries: one per operator group of the inventory.

Every query takes ``(spark, sf_dir)``, renders ``log_lines`` from that
directory's ``events`` table (so its work grows with the table) and
returns a flat DataFrame: counts are ``bigint``, dates ``yyyy-MM-dd``
strings and id lists are joined with single spaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.config import ensure_checkpoint_dir
from logsift.functions import fixed
from logsift.functions.text import document_ids
from logsift.functions.timestamps import extract_date, is_timestamp
from logsift.operators import metrics, profile, profile_report
from logsift.operators.parse import RECORD_COLUMNS, parse_log_lines, tokenize, unparseable_lines
from logsift.operators.profile_parse import PROFILE_COLUMNS, parse_profile_lines
from logsift.operators.sessions import quick_search_attribution, session_dates, session_events, session_sizes
from logsift.sinks.session_files import write_session_files
from logsift.sources.session_files import read_session_files, split_lines
from logsift.sources.tables import log_lines_from_sf_dir

Query = Callable[[SparkSession, str], DataFrame]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines_from_sf_dir(spark, sf_dir)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_log_lines(_lines(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records and session events; session sizes are counted on the lines
    (no parsing needed for them)."""
    records = parse_log_lines(_lines(spark, sf_dir))
    sizes = session_sizes(log_lines_from_sf_dir(spark, sf_dir, fenced=False))
    return records, session_events(records, sizes=sizes)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_profile_lines(_lines(spark, sf_dir))


def _joined(col: str) -> F.Column:
    return F.array_join(F.col(col), " ").alias(col)


def parsed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [_joined(c) if c == "document_ids" else F.col(c) for c in RECORD_COLUMNS]
    return _records(spark, sf_dir).select(*cols)


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole texts of ``documents`` as numbered lines."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = documents.select(F.col("doc_id").cast("string").alias("source_file_id"), F.lit(None).alias("source_path"), "text")
    return split_lines(texts).drop("source_path")


def file_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines written as session files to the cluster's shared
    folder and scanned again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/session-files-{uuid.uuid4().hex}"
    write_session_files(_lines(spark, sf_dir), folder)
    return read_session_files(spark, folder).drop("source_path")


def line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(_lines(spark, sf_dir)).select(
        "source_file_id", "line_number", "raw", F.col("n_tokens").cast("int").alias("n_tokens"), F.col("t0").alias("first_token")
    )


def timestamps_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = tokenize(_lines(spark, sf_dir)).filter(F.col("t1").isNotNull())
    return tok.select(
        "source_file_id",
        "line_number",
        F.col("t1").alias("token"),
        is_timestamp("t1").alias("is_timestamp"),
        extract_date("t1").alias("event_date"),
    )


def document_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = tokenize(_lines(spark, sf_dir))
    ids = tok.select(F.explode(document_ids(F.col("raw"))).alias("document_id"))
    return ids.groupBy("document_id").agg(F.count(F.lit(1)).alias("mentions"))


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _records(spark, sf_dir).filter(F.col("record_type") == fixed.SEARCH_RESULTS)
    return rec.select(
        "source_file_id", "line_number", _joined("document_ids"), F.size("document_ids").alias("n_documents")
    )


def card_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _records(spark, sf_dir).filter(F.col("record_type") == fixed.CARD_SEARCH_QUERY)
    return rec.select("source_file_id", "line_number", "document_id", "query_text")


def document_opens_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _records(spark, sf_dir).filter(F.col("record_type").isin(fixed.DOCUMENT_OPEN, fixed.DOCUMENT_OPEN_NO_TS))
    return rec.select(
        "source_file_id", "line_number", "record_type", "timestamp", "document_id", extract_date("timestamp").alias("event_date")
    )


def unparseable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparseable_lines(_records(spark, sf_dir))


def session_dates_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_dates(_records(spark, sf_dir))


def card_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.card_blocks(_events(spark, sf_dir)[1]).select("source_file_id", "block_start_line", "hit")


def card_search_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.card_search_count(_events(spark, sf_dir)[1])


def quick_search_attribution_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quick_search_attribution(_events(spark, sf_dir)[1]).select("source_file_id", "line_number", "qs_date")


def quick_search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quick_search_docs(_events(spark, sf_dir)[1])


def document_opens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.document_opens(_records(spark, sf_dir))


def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.session_summary(_events(spark, sf_dir)[1])


def quick_search_opens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quick_search_opens(_events(spark, sf_dir)[1])


def profile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile records; the id count reads 0 off result lines, as the
    report's counters read it."""

    def out(c: str) -> F.Column:
        if c in ("document_ids", "document_ids_inline"):
            return _joined(c)
        if c == "document_count":
            return F.coalesce(F.col(c), F.lit(0)).alias(c)
        return F.col(c)

    return _profile(spark, sf_dir).select(*[out(c) for c in PROFILE_COLUMNS])


def _profile_query(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_profile(spark, sf_dir))

    run.__name__ = fn.__name__
    return run


QUERIES: dict[str, Query] = {
    "parsed_records": parsed_records,
    "document_lines": document_lines,
    "file_scan_roundtrip": file_scan_roundtrip,
    "line_tokens": line_tokens,
    "timestamps_dates": timestamps_dates,
    "document_mentions": document_mentions,
    "search_results": search_results,
    "card_queries": card_queries,
    "document_opens_lines": document_opens_lines,
    "unparseable_lines": unparseable,
    "session_dates": session_dates_q,
    "card_blocks": card_blocks,
    "card_search_count": card_search_count,
    "quick_search_attribution": quick_search_attribution_q,
    "quick_search_docs": quick_search_docs,
    "document_opens": document_opens,
    "session_summary": session_summary,
    "quick_search_opens": quick_search_opens,
    "profile_records": profile_records,
    "profile_summary": _profile_query(profile.profile_summary),
    "profile_record_types": _profile_query(profile.profile_record_types),
    "profile_parse_errors": _profile_query(profile.profile_parse_errors),
    "profile_card_params": _profile_query(profile.profile_card_params),
    "profile_result_sizes": _profile_query(profile.profile_result_sizes),
    "profile_date_tokens": _profile_query(profile.profile_date_tokens),
    "profile_doc_prefixes": _profile_query(profile.profile_doc_prefixes),
    "profile_commands": _profile_query(profile.profile_commands),
    "profile_unparseable_samples": _profile_query(profile.profile_unparseable_samples),
    "profile_type_samples": _profile_query(profile.profile_type_samples),
    "profile_counts": _profile_query(profile_report.profile_counts),
}
