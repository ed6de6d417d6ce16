"""Sinks (operators K1-K5): CSV, Parquet and JSON outputs of the job.

By default outputs that can grow with the input (rejects, Task 2) are
written by many tasks; a sorted result is range-partitioned, so its part
files in name order hold the global order.  ``single_file`` gives the
one-part-file layout instead, without narrowing the heavy stage: unsorted
results go through ``repartition(1)`` (a shuffle, so everything before it
stays parallel) and sorted ones through ``coalesce(1)`` after the range
sort, which only concatenates the sorted ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logsift.functions import fixed


def _one_file(df: DataFrame, sorted_input: bool) -> DataFrame:
    return df.coalesce(1) if sorted_input else df.repartition(1)


def write_csv(df: DataFrame, path: str, *, single_file: bool = True, sorted_input: bool = False) -> None:
    out = _one_file(df, sorted_input) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, *, single_file: bool = True, sorted_input: bool = False) -> None:
    out = _one_file(df, sorted_input) if single_file else df
    out.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str, *, single_file: bool = True, sorted_input: bool = False) -> None:
    out = _one_file(df, sorted_input) if single_file else df
    out.write.mode("overwrite").json(path)


def _observed(df: DataFrame, value: Column) -> tuple[DataFrame, Observation]:
    """``df``, and what its write will have seen of ``value`` as ``n``."""
    seen = Observation()
    return df.observe(seen, value.alias("n")), seen


def write_unparseable(unparseable: DataFrame, out_dir: str, *, single_file: bool = True) -> int:
    """K1: ``unparseable_lines`` CSV; missing texts are written as ``""``.
    Returns the rows written, counted by the write itself."""
    rows = unparseable.select(
        "source_file_id",
        "line_number",
        F.coalesce("parse_error", F.lit("")).alias("parse_error"),
        F.coalesce("raw_line", F.lit("")).alias("raw_line"),
    )
    rows, seen = _observed(rows, F.count(F.lit(1)))
    write_csv(rows, f"{out_dir}/unparseable_lines", single_file=single_file)
    return seen.get["n"]


def card_search_folder(target: str) -> str:
    """The Task 1 folder of a target: ``ACC_45616`` -> ``task1_card_search_acc45616``."""
    return "task1_card_search_" + "".join(c for c in target.lower() if c.isalnum())


def write_card_search_count(task1: DataFrame, out_dir: str, target: str = fixed.TARGET_DOCUMENT) -> int:
    """K2: one row ``document_id, card_search_count``; returns the count."""
    rows, seen = _observed(task1, F.max("card_search_count"))
    write_csv(rows, f"{out_dir}/{card_search_folder(target)}")
    return seen.get["n"]


def write_quick_search_opens(task2_sorted: DataFrame, out_dir: str, *, single_file: bool = True) -> int:
    """K3 + K4: the sorted Task 2 rows as Parquet and as CSV; returns the
    rows written."""
    rows, seen = _observed(task2_sorted, F.count(F.lit(1)))
    write_parquet(rows, f"{out_dir}/task2_quick_search_opens", single_file=single_file, sorted_input=True)
    write_csv(task2_sorted, f"{out_dir}/task2_quick_search_opens_csv", single_file=single_file, sorted_input=True)
    return seen.get["n"]


def write_profile_document(lines: DataFrame, out_dir: str, *, single_file: bool = True) -> None:
    """K5: the profile as one JSON document, ``log_analysis_stats.json``: a
    folder whose part files in name order hold the document's lines."""
    ordered = lines.orderBy("place", "part", "rank", "key").select("value")
    out = _one_file(ordered, sorted_input=True) if single_file else ordered
    out.write.mode("overwrite").text(f"{out_dir}/log_analysis_stats.json")


def write_log_lines_table(lines: DataFrame, path: str) -> int:
    """Compact scanned session files into a ``log_lines`` Parquet table, so
    later runs read columns instead of re-listing many small files.  Rows
    are sorted by (session, line) within each task (no shuffle): better
    compression, and tight row-group statistics on ``source_file_id``.
    Returns the lines written."""
    rows, seen = _observed(lines, F.count(F.lit(1)))
    rows.sortWithinPartitions("source_file_id", "line_number").write.mode("overwrite").parquet(path)
    return seen.get["n"]


def write_events_table(events: DataFrame, name: str, path: str, *, buckets: int = 200) -> None:
    """Session events (:func:`logsift.operators.sessions.session_events`) as
    the catalog table ``name`` at ``path``, bucketed on the session and sorted
    by line: jobs on it group by session, or join on it, without an exchange.
    One exchange on the session beforehand gives each bucket one file.  A
    bucket's rows are streamed to their file; a hot session fills one bucket,
    whose readers can split the file again by row group where they need no
    grouping."""
    spread = events.repartition(buckets, "source_file_id")
    ordered = spread.write.bucketBy(buckets, "source_file_id").sortBy("source_file_id", "line_number")
    ordered.option("path", path).mode("overwrite").format("parquet").saveAsTable(name)
