"""Session-file scan (operators S1-S4).

A session is a text file whose whole name is ASCII digits; the name is
the session id.  Files are listed by Spark itself (no driver-side walk),
read whole (one row per file, so line order and numbering are exact and
a file is never split across tasks), decoded leniently with the JDK's
replacement rules (:func:`logsift.functions.text.java_decoded`), cut at
LF, CR or CRLF and numbered from 1 with blank lines counted.

Scale: listing and reading are distributed; each task holds the files it
packs (``spark.sql.files.maxPartitionBytes``).  Read whole, a single file
must fit in a task's memory and under 2 GB (one string value).  Larger
files are read in blocks, so one huge session file is spread over many
tasks, and give the same rows; see :func:`_read_blocks`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsift.config import SPLIT_ABOVE_BYTES
from logsift.functions import fixed
from logsift.functions.fence import fence
from logsift.functions.text import java_decoded

_BOM_BYTES = 3  # the UTF-8 byte-order mark


def read_session_files(
    spark: SparkSession,
    root: str | list[str],
    *,
    recursive: bool = True,
    name_pattern: str = fixed.NUMERIC_FILE_NAME,
    mode: str = "auto",
    decode: str = "java",
    split_above_bytes: int = SPLIT_ABOVE_BYTES,
    session_key: str = "name",
) -> DataFrame:
    """``log_lines`` (source_file_id, line_number, line, source_path).

    ``source_file_id`` is the base name only, so equal names in two
    directories form one session; with ``session_key="path"`` it is the full
    path, and every file is a session of its own.  ``source_path`` keeps the
    full path as the tie-breaker for equal line numbers.  A missing root raises
    ``PATH_NOT_FOUND``.  A byte-order mark stays glued to the first token.
    ``root`` is a folder, or a list of folders and files.
    ``mode``: ``whole`` reads every file whole; ``split`` reads every file
    in parallel blocks; ``auto`` (default) reads files up to
    ``split_above_bytes`` whole and larger ones in blocks.  All three give
    the same rows.  Both parts filter on ``_metadata.file_size``, which
    Spark applies when listing, so each file is read once, by one of them.
    ``decode="python"`` replaces malformed UTF-8 the way Python's decoder
    does (the profile script's reader) instead of the JDK's.
    """
    if session_key not in ("name", "path"):
        raise ValueError(f"session_key is name or path, not {session_key}")
    lines = _read(spark, root, recursive, name_pattern, mode, decode, split_above_bytes)
    return lines.withColumn("source_file_id", F.col("source_path")) if session_key == "path" else lines


def _read(spark, root, recursive, name_pattern, mode, decode, split_above_bytes) -> DataFrame:
    if mode == "whole":
        return _read_whole(spark, root, recursive, name_pattern, decode, None)
    # the line reader gives no row for a file that is only a byte-order mark
    above = max(split_above_bytes, _BOM_BYTES) if mode == "auto" else _BOM_BYTES
    size = F.col("_metadata.file_size")
    whole = _read_whole(spark, root, recursive, name_pattern, decode, size <= above)
    return whole.unionByName(_read_blocks(spark, root, recursive, name_pattern, decode, size > above))


def _read_whole(spark, root, recursive, name_pattern, decode, size_filter) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(root, wholetext=True)
    if size_filter is not None:
        reader = reader.filter(size_filter)
    files = (
        reader.select(
            F.col("_metadata.file_name").alias("source_file_id"),
            F.col("_metadata.file_path").alias("source_path"),
            _decoded(F.col("value"), decode).alias("text"),
        )
        .filter(F.col("source_file_id").rlike(name_pattern))
    )
    return split_lines(files)


def _decoded(value: Column, decode: str) -> Column:
    """``java``: the JDK's replacement rules (the job's reader);
    ``python``: Python's ``errors="replace"`` rules, which are what
    ``make_valid_utf8`` applies (the profile script's reader)."""
    return F.make_valid_utf8(value) if decode == "python" else java_decoded(value)


def read_profile_files(spark: SparkSession, root: str, name_pattern: str = fixed.NUMERIC_FILE_NAME) -> DataFrame:
    """The profile reads one flat directory of files with all-digit
    names, decoded with Python's replacement rules, as the profile script
    does.  ``name_pattern=fixed.PROFILE_FILE_NAME`` keeps the script's own
    bound, names 0..9999."""
    return read_session_files(spark, root, recursive=False, name_pattern=name_pattern, decode="python")


def split_lines(files: DataFrame) -> DataFrame:
    """Whole texts -> numbered lines.  A final line break does not
    start another line; an empty text has no lines."""
    split = files.select("source_file_id", "source_path", F.split(F.col("text"), fixed.LINE_BREAK).alias("_lines"))
    pieces = split.select(
        "source_file_id",
        "source_path",
        F.size("_lines").alias("n_pieces"),
        F.posexplode("_lines").alias("pos", "line"),
    )
    last_empty = (F.col("pos") == F.col("n_pieces") - 1) & (F.col("line") == "")
    return pieces.filter(~last_empty).select(
        "source_file_id",
        (F.col("pos") + 1).cast("int").alias("line_number"),
        "line",
        "source_path",
    )


def _read_blocks(spark, root, recursive, name_pattern, decode, size_filter) -> DataFrame:
    """``log_lines`` from files read in blocks of
    ``spark.sql.files.maxPartitionBytes``, for session files too large to
    hold whole; the rows equal those of a whole read.

    Spark's line reader cuts at LF, CR and CR LF alike and hands a line that
    crosses into the next block to the block it starts in, a CR LF cut in two
    included.  So every row is one line, whatever ends it, and no file has to
    fit in a task.  Lines are exchanged once, on (file, block): a line's
    number is its place in its block after the lines of the file's earlier
    blocks, which come from one summary row per block, taken from the same
    exchange and joined back (a block without its summary is an error, never
    a lost line).

    The reader drops a leading byte-order mark, which the whole read keeps.
    It is put back in front of line 1 of the files that start with one, see
    :func:`_byte_order_marks`.  File filters sit on the reader itself, where
    Spark uses them to skip files; the row id after them is not
    deterministic, so they could not be pushed through it.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(root)
    reader = reader.filter(F.col("_metadata.file_name").rlike(name_pattern)).filter(size_filter)
    read = reader.select(
        F.col("_metadata.file_name").alias("source_file_id"),
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value").alias("_value"),
    )
    # both uses take all columns, so they read one and the same exchange
    lines = fence(read.repartition("source_path", "_block"))
    blocks = lines.groupBy("source_path", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("source_path", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    offsets = _byte_order_marks(offsets)
    in_block = F.row_number().over(Window.partitionBy("source_path", "_block").orderBy("_row"))
    placed = lines.withColumn("_in_block", in_block)
    joined = placed.join(offsets, (F.col("source_path") == F.col("_path")) & (F.col("_block") == F.col("_start")), "left")
    before = F.coalesce(
        F.col("_before"),
        F.raise_error(F.concat(F.lit("file block read without its line count: "), F.col("source_path"))).cast("long"),
    )
    # bad bytes at the end of a line are replaced as those before a line feed
    text = _decoded(F.concat(F.col("_value"), F.lit("\n")), decode)
    line = F.substring(text, F.lit(1), F.char_length(text) - 1)
    return joined.select(
        "source_file_id",
        (before + F.col("_in_block")).cast("int").alias("line_number"),
        F.when(F.col("_marked") & (F.col("_in_block") == 1), F.concat(F.lit("\ufeff"), line)).otherwise(line).alias("line"),
        "source_path",
    )


def _byte_order_marks(offsets: DataFrame) -> DataFrame:
    """(_path, _start, _before, _marked): whether a block starts with a
    byte-order mark.  The first blocks' three bytes are read in the tasks, by
    path: one small read per large file, none for other blocks."""

    def look(batches):
        import pyarrow as pa
        from pyarrow import fs

        def marked(path: str) -> bool:
            if path.startswith("file:") and not path.startswith("file://"):
                path = "file://" + path[len("file:") :]
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_stream(name) as f:
                return f.read(3) == b"\xef\xbb\xbf"

        for batch in batches:
            columns = batch.to_pydict()
            found = [start == 0 and marked(path) for path, start in zip(columns["source_path"], columns["_block"], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.bool_())], names=["_path", "_start", "_before", "_marked"])

    return offsets.mapInArrow(look, "_path string, _start long, _before long, _marked boolean")
