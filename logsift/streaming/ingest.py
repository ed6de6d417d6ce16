"""Continuous ingestion of session files with Structured Streaming.

New session files are picked up as they land, read whole (one row per
file), cut into numbered lines and parsed with the same row-wise
expressions as the batch job; records are appended to a Parquet table
(with ``source_path`` kept as the ordering tie-breaker), rejects among
them.  The session metrics stay batch jobs over that records table
(``source="records"``): a session's date and card blocks depend on the
whole session, which a file stream cannot promise to have seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsift.functions import fixed
from logsift.operators.parse import parse_log_lines
from logsift.functions.text import java_decoded
from logsift.sources.session_files import split_lines


def stream_log_lines(spark: SparkSession, root: str, *, recursive: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``log_lines`` from a directory of session files."""
    reader = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", str(recursive).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = (
        reader.load(root)
        .select(
            F.col("_metadata.file_name").alias("source_file_id"),
            F.col("_metadata.file_path").alias("source_path"),
            java_decoded(F.col("value")).alias("text"),
        )
        .filter(F.col("source_file_id").rlike(fixed.NUMERIC_FILE_NAME))
    )
    return split_lines(files)


def start_record_ingest(
    spark: SparkSession,
    root: str,
    records_path: str,
    *,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Append parsed records of newly arrived session files to
    ``records_path`` (Parquet).  ``checkpoint`` is a folder of this ingest
    alone that outlives the application: a restart goes on from it."""
    records = parse_log_lines(stream_log_lines(spark, root, max_files_per_trigger=max_files_per_trigger))
    writer = records.writeStream.format("parquet").option("path", records_path).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
