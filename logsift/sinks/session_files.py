"""Session files as a sink: the inverse of the session-file scan.

:func:`write_session_files` writes ``log_lines`` back as one text file per
session, named by the session id, so that
:func:`logsift.sources.session_files.read_session_files` gives the same rows
again.  Spark's own text sink chooses its file names, so the files are
written by a Spark data source.

*Layout and commit.*  Lines are exchanged on the session and sorted in each
task, which streams them to one open file at a time, into an attempt folder
whose name starts with ``_``.  Spark's listing passes over such names, so
nothing of a running, failed or repeated attempt is ever read.  When all
tasks are done the driver renames one folder per task, whatever the number
of files, and then writes ``_SUCCESS``; an aborted write deletes what its
tasks report.

Equal session ids from several directories (``source_path``) stay several
files, each in a folder of its path's hash.  Lines that would not come back
are an error: gaps in the numbering, and line breaks inside a line.  A null
line is an empty one.  The folder must be on a file system that Python's
pyarrow opens (a shared mount, HDFS, an object store).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# the classes travel to the tasks themselves: no package is needed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "folder string, source_file_id string, line_number int, line string"


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    final: str
    files: int
    lines: int


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """``file:/a`` as Spark writes it is ``file:///a`` to pyarrow."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class SessionFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.run = path.rstrip("/"), uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        store, root = _file_system(self.path)
        attempt = f"{root}/_attempt-{self.run}-{context.partitionId():06d}-{context.taskAttemptId()}"
        final = f"{root}/part-{self.run}-{context.partitionId():06d}"
        open_as, out, number, files, lines = None, None, 0, 0, 0
        made = set()
        try:
            for batch in iterator:
                for folder, session, at, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (folder, session) != open_as:
                        if out is not None:
                            out.close()
                        where = f"{attempt}/{folder}" if folder else attempt
                        if where not in made:
                            store.create_dir(where, recursive=True)
                            made.add(where)
                        out, open_as, number = store.open_output_stream(f"{where}/{session}"), (folder, session), 0
                        files += 1
                    number += 1
                    text = line or ""
                    if at != number:
                        raise ValueError(f"session {session}: line {number} is missing")
                    if "\n" in text or "\r" in text:
                        raise ValueError(f"session {session}: line {at} holds a line break")
                    out.write(text.encode() + b"\n")
                    lines += 1
        finally:
            if out is not None:
                out.close()
        return Written(attempt, final, files, lines)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _file_system(self.path)
        store.create_dir(root, recursive=True)
        for m in messages:
            if m is not None and m.files:
                store.move(m.attempt, m.final)
        with store.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, _ = _file_system(self.path)
        for m in messages:
            if m is not None and m.files:
                store.delete_dir(m.attempt)


class SessionFilesSink(DataSource):
    """``df.write.format("session_files")`` for rows of ``SCHEMA`` that come
    grouped by file and in line order in each task."""

    @classmethod
    def name(cls) -> str:
        return "session_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> SessionFilesWriter:
        if overwrite:
            raise ValueError("session files are only appended")
        return SessionFilesWriter(self.options["path"])


def write_session_files(lines: DataFrame, path: str) -> None:
    """Write ``log_lines`` as session files under ``path`` (a new folder)."""
    lines.sparkSession.dataSource.register(SessionFilesSink)
    folder = F.lower(F.hex(F.xxhash64("source_path"))) if "source_path" in lines.columns else F.lit(None).cast("string")
    path_of = F.when(F.col("source_path").isNotNull(), folder) if "source_path" in lines.columns else folder
    rows = lines.select(path_of.alias("folder"), "source_file_id", F.col("line_number").cast("int").alias("line_number"), "line")
    keys = ["source_file_id", "folder"]
    rows.repartition(*keys).sortWithinPartitions(*keys, "line_number").write.format("session_files").option("path", path).mode("append").save()
