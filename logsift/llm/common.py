"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text handled at once inside a task; longer single texts form a
#: group of their own.
GROUP_BYTES = 4 << 20
#: Bytes of rows handed to a Python worker at once by ``small_batches``.
BATCH_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application: a zip that
    Spark's file server hands out, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="logsift-code-")) / "logsift-code.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted((root / "logsift").rglob("*.py")):
                z.write(f, str(f.relative_to(root)))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session.  Only a local-mode
    session without it (tests) gets a scratch folder."""
    from logsift.config import ensure_checkpoint_dir

    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later
    jobs start from the files, whatever executors are lost."""
    path = shared_folder(df.sparkSession, name)
    w = df.write.option("compression", codec) if codec else df.write
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame, within: str = "") -> None:
    """Delete tables made by :func:`written` that nothing will read again:
    all that came of them has been written itself.  ``within``: only the
    folder of that name, of a table partitioned so."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if not folder.endswith(within):
                continue
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes the shuffle files of an execution as it ends, for
    tables that are written once and read from their files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within, Spark hands rows to Python in batches of about ``BATCH_BYTES``
    (a larger row alone), not of 64 MB: both sides hold a batch in memory, some
    of its columns more than once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_groups(batches: Iterator[pa.RecordBatch], limit: int = GROUP_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Re-slice batches so that one slice holds about ``limit`` bytes of the
    text column (at least one row): bounded memory for any text length."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if len(sizes) > start:
            yield batch.slice(start, len(sizes) - start)
    pa.default_memory_pool().release_unused()  # the worker stays for other tasks


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's values as UTF-8 bytes; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    return [v or b"" for v in col.cast(pa.binary()).to_pylist()]


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_columns(df: DataFrame, added: str) -> T.StructType:
    """The schema of ``df`` followed by the columns of a DDL string."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(added).fields])


def text_column(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
