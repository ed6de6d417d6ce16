"""Incremental compaction of session files into a ``log_lines`` table.

``<table>/lines/run=<k>`` holds the lines of run k, and
``<table>/manifest/run=<k>`` the files it read (path, size, time).  A run
lists the session files without opening them, takes those that no manifest
names (an anti join), writes their lines, and writes its manifest last: that
is its commit.  Lines of a run without a manifest are passed over by
:func:`read_compacted` and overwritten by the next run, so every file's lines
are in the table exactly once whatever run failed, and where.

Session files do not change once written: a listed file of another size or
time is an error.  A run reads at most ``max_files`` files, whose paths it
hands to the reader; :func:`compact_new_files` runs until none is left.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.functions import fixed
from logsift.sinks.writers import write_log_lines_table
from logsift.sources.session_files import read_session_files

MAX_FILES = 200_000
_MANIFEST = "path string, size long, time timestamp, run int"
_LINES = "source_file_id string, line_number int, line string, source_path string, run int"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def manifest(spark: SparkSession, table_path: str) -> DataFrame:
    """(path, size, time, run) of every file in the table."""
    return _table(spark, f"{table_path}/manifest", _MANIFEST)


def listed_files(spark: SparkSession, root: str, name_pattern: str = fixed.NUMERIC_FILE_NAME) -> DataFrame:
    """(path, size, time) of the session files under ``root``; contents are
    not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    named = files.filter(F.col("_metadata.file_name").rlike(name_pattern))
    return named.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("time"))


def new_files(spark: SparkSession, root: str, table_path: str) -> DataFrame:
    """The listed files that no run has read; a changed file is an error."""
    known = manifest(spark, table_path).select("path", F.col("size").alias("_size"), F.col("time").alias("_time"))
    met = listed_files(spark, root).join(known, "path", "left")
    same = (F.col("size") == F.col("_size")) & (F.col("time") == F.col("_time"))
    changed = F.raise_error(F.concat(F.lit("session file changed after it was compacted: "), F.col("path"))).cast("boolean")
    return met.filter(F.when(F.col("_size").isNull(), True).when(same, False).otherwise(changed)).select("path", "size", "time")


def compact_new_files(
    spark: SparkSession, root: str, table_path: str, *, file_mode: str = "auto", session_key: str = "name", max_files: int = MAX_FILES
) -> dict[str, int]:
    """Append the lines of the files that are new under ``root``; returns the
    files and lines of this call."""
    done = {"files": 0, "lines": 0}
    while True:
        batch = new_files(spark, root, table_path).orderBy("path").limit(max_files).collect()
        if not batch:
            return done
        run = (manifest(spark, table_path).agg(F.max("run")).first()[0] or 0) + 1
        plain = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r.path) for r in batch]  # the reader takes patterns
        lines = read_session_files(spark, plain, mode=file_mode, session_key=session_key)
        done["lines"] += write_log_lines_table(lines, f"{table_path}/lines/run={run}")
        files = spark.createDataFrame(batch, "path string, size long, time timestamp")
        files.coalesce(1).write.mode("overwrite").parquet(f"{table_path}/manifest/run={run}")
        done["files"] += len(batch)


def read_compacted(spark: SparkSession, table_path: str) -> DataFrame:
    """``log_lines`` of the committed runs; the run is a partition column, so
    others are not opened."""
    runs = [r.run for r in manifest(spark, table_path).select("run").distinct().collect()]
    return _table(spark, f"{table_path}/lines", _LINES).filter(F.col("run").isin(*runs) if runs else F.lit(False)).drop("run")
