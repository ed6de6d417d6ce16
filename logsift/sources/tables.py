"""Table sources: the ``log_lines`` Parquet table and the events fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.functions.fence import fence
from logsift.sources.fixture_sql import log_lines_sql_for_spark

LOG_LINES_SCHEMA = "source_file_id string, line_number int, line string"


def render_log_lines_from_events(spark: SparkSession, events: DataFrame, *, fenced: bool = True) -> DataFrame:
    """``log_lines`` rendered from the driver's ``events`` table (test data).

    ``fenced`` keeps the rendered line a plain column for the parser (see
    :mod:`logsift.functions.fence`); unfenced, a consumer that needs only
    the session ids (a size count) prunes the rendering down to a scan of
    ``user_id``."""
    rendered = spark.sql(log_lines_sql_for_spark(), events=events.select("event_id", "ts", "user_id", "event_type"))
    return fence(rendered) if fenced else rendered


def log_lines_from_sf_dir(spark: SparkSession, sf_dir: str, *, fenced: bool = True) -> DataFrame:
    return render_log_lines_from_events(spark, spark.read.parquet(f"{sf_dir}/events.parquet"), fenced=fenced)


def read_log_lines_table(spark: SparkSession, path: str) -> DataFrame:
    """A compacted ``log_lines`` table (Parquet), e.g. written by
    :func:`logsift.sinks.writers.write_log_lines_table`."""
    df = spark.read.parquet(path)
    cols = [F.col("source_file_id").cast("string"), F.col("line_number").cast("int"), F.col("line").cast("string")]
    if "source_path" in df.columns:
        cols.append(F.col("source_path").cast("string"))
    return df.select(*cols)
