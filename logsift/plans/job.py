"""The batch jobs: metrics job (Task 1, Task 2, rejects) and profile job.

Only this module caches or writes.  Parsed records are kept with
``persist(MEMORY_AND_DISK)`` (or checkpointed to the cluster's
``spark.checkpoint.dir``) because every output reads them; a lost
executor's blocks are recomputed from lineage or re-read from the
checkpoint.
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from logsift.config import DEFAULT_CHUNK_ROWS, ensure_checkpoint_dir
from logsift.functions import fixed
from logsift.operators import metrics, profile, profile_report
from logsift.operators.parse import parse_log_lines, unparseable_lines
from logsift.operators.profile_parse import parse_profile_lines
from logsift.operators.sessions import session_events, session_sizes
from logsift.plans.compaction import compact_new_files, read_compacted
from logsift.sinks import writers
from logsift.sources.session_files import read_profile_files, read_session_files
from logsift.sources.tables import read_log_lines_table


def _keep(df: DataFrame, how: str) -> DataFrame:
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def read_input(spark: SparkSession, path: str, source: str = "files", file_mode: str = "auto", session_key: str = "name") -> DataFrame:
    """``files``: a directory tree of session files (``file_mode``: ``auto``
    reads large files in blocks and the rest whole, or ``whole`` /
    ``split`` for all); ``table``: a ``log_lines`` Parquet table;
    ``compacted``: the table that ``compact_new_files`` appends to."""
    if source == "files":
        return read_session_files(spark, path, mode=file_mode, session_key=session_key)
    if source == "compacted":
        return read_compacted(spark, path)
    return read_log_lines_table(spark, path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records appended by :mod:`logsift.streaming.ingest`."""
    return spark.read.parquet(path)


def run_metrics_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    *,
    source: str = "files",
    target: str = fixed.TARGET_DOCUMENT,
    keep: str = "persist",
    single_file: bool = False,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    file_mode: str = "auto",
    session_key: str = "name",
) -> dict[str, int]:
    """Parse, fold sessions and write the four outputs.  Returns small
    counts for logging (rejects, Task 1, Task 2 rows), observed by the
    writes: no output is read again.

    Rejects and Task 2 grow with the input, so by default many tasks write
    them (Task 2's part files in name order are sorted); ``single_file``
    writes one part file per output, the layout of the original job."""
    parsed = read_records(spark, input_path) if source == "records" else parse_log_lines(read_input(spark, input_path, source, file_mode, session_key))
    records = _keep(parsed, keep)
    events = None
    try:
        events = _keep(session_events(records, target, chunk_rows, sizes=session_sizes(records)), keep)
        rejects = unparseable_lines(records)
        task1 = metrics.card_search_count(events, target)
        task2 = metrics.quick_search_opens(events)
        return {
            "unparseable_lines": writers.write_unparseable(rejects, output_path, single_file=single_file),
            "card_search_count": writers.write_card_search_count(task1, output_path, target),
            "task2_rows": writers.write_quick_search_opens(task2, output_path, single_file=single_file),
        }
    finally:
        if keep == "persist":
            records.unpersist()
            if events is not None:
                events.unpersist()


def compact_session_files(spark: SparkSession, input_path: str, table_path: str, *, file_mode: str = "auto", session_key: str = "name") -> int:
    """Write session files once as a ``log_lines`` Parquet table; later runs
    read it with ``source="table"`` (columns and row groups instead of
    listing and reading many small files).  Returns the number of lines."""
    return writers.write_log_lines_table(read_session_files(spark, input_path, mode=file_mode, session_key=session_key), table_path)


PROFILE_TABLES = {
    "summary": profile.profile_summary,
    "record_types": profile.profile_record_types,
    "parse_errors": profile.profile_parse_errors,
    "card_params": profile.profile_card_params,
    "result_sizes": profile.profile_result_sizes,
    "date_tokens": profile.profile_date_tokens,
    "doc_prefixes": profile.profile_doc_prefixes,
    "commands": profile.profile_commands,
    "unparseable_samples": profile.profile_unparseable_samples,
    "type_samples": lambda precs: profile.profile_type_samples(precs, with_fields=True),
}


#: Sections that grow with the rejects; written by many tasks.
GROWING_TABLES = {"parse_errors"}


def run_profile_job(
    spark: SparkSession, input_path: str, output_path: str, *, source: str = "files", keep: str = "persist", report: str = "document", single_file: bool = False
) -> None:
    """K5: the format profile.  ``report="document"``: one JSON document
    (``log_analysis_stats.json``), from two reads of the parsed records, the
    counts' and the samples'; ``"tables"``: one JSON table per section under
    ``<output>/profile/<section>``, one read each."""
    lines = read_profile_files(spark, input_path) if source == "files" else read_log_lines_table(spark, input_path)
    precs = _keep(parse_profile_lines(lines), keep)
    try:
        if report == "document":
            document = profile_report.profile_document(profile_report.profile_counts(precs), profile_report.profile_samples(precs))
            writers.write_profile_document(document, output_path, single_file=single_file)
        else:
            for name, fn in PROFILE_TABLES.items():
                writers.write_json(fn(precs), f"{output_path}/profile/{name}", sorted_input=name not in GROWING_TABLES)
    finally:
        if keep == "persist":
            precs.unpersist()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Session log metrics on Spark")
    ap.add_argument("input")
    ap.add_argument("output")
    ap.add_argument("--source", choices=("files", "table", "records", "compacted"), default="files")
    ap.add_argument("--target", default=fixed.TARGET_DOCUMENT)
    ap.add_argument("--keep", choices=("persist", "checkpoint"), default="persist")
    ap.add_argument(
        "--file-mode", choices=("auto", "whole", "split"), default="auto", help="auto: files over 64 MB are read in blocks"
    )
    ap.add_argument("--session-key", choices=("name", "path"), default="name", help="path: equal file names in two folders are two sessions")
    ap.add_argument("--chunk-rows", type=int, default=DEFAULT_CHUNK_ROWS, help="largest window group; bigger sessions are chunked")
    ap.add_argument("--single-file", action="store_true", help="one part file per output (the original layout)")
    ap.add_argument("--profile", action="store_true", help="write the format profile instead of the metrics")
    ap.add_argument("--report", choices=("document", "tables"), default="document", help="the profile as one JSON document, or a table per section")
    ap.add_argument("--compact", action="store_true", help="write the session files as a log_lines table at <output>")
    ap.add_argument("--compact-new", action="store_true", help="append the session files that are new to the table at <output>; read it with --source compacted")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("logsift").getOrCreate()
    if args.compact_new:
        print(compact_new_files(spark, args.input, args.output, file_mode=args.file_mode, session_key=args.session_key))
    elif args.compact:
        print({"lines": compact_session_files(spark, args.input, args.output, file_mode=args.file_mode, session_key=args.session_key)})
    elif args.profile:
        run_profile_job(spark, args.input, args.output, source=args.source, keep=args.keep, report=args.report, single_file=args.single_file)
    else:
        print(
            run_metrics_job(
                spark,
                args.input,
                args.output,
                source=args.source,
                target=args.target,
                keep=args.keep,
                file_mode=args.file_mode,
                session_key=args.session_key,
                chunk_rows=args.chunk_rows,
                single_file=args.single_file,
            )
        )


if __name__ == "__main__":
    main()
