"""Token-id files: one zstandard frame per document, a trailing seek table.

Layout of a file (all numbers little-endian)::

    frame*        independent zstandard frames; the ids of one document as
                  unsigned 16- or 32-bit integers (16 if the vocabulary
                  allows), longer documents as several frames
    index         skippable frame 0x184D2A50: b"TIDX", u8 version 1, u8 id
                  width in bytes, u32 documents, then per document
                  i64 doc_id, u8 null flag, u32 frames
    seek table    skippable frame 0x184D2A5E of the zstandard seekable
                  format: per frame u32 compressed size, u32 size,
                  u32 checksum (low half of XXH64 of the content), then
                  u32 frames, u8 0x80, u32 0x8F92EAB1

A reader takes the two tables from the end of the file and then fetches
and decompresses the frames of requested documents only, checking each.

Documents are dealt to tasks by ranges of doc_id and sorted within; every
task writes one file named by its attempt, and the manifest (part, path,
documents, ids), written by Spark's committer, names the files of the
attempts that count.  Files of lost attempts are never read.

The folder is reached with pyarrow's file systems from driver-given URIs,
so it must be a store that executors share.

Null text counts as empty (only the end id); null doc_ids come first;
rows with one doc_id follow each other in the order of their texts' hash.
Other columns are ignored.  An empty table gives no files.
"""

from __future__ import annotations

import os
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import ENCODE_BYTES, WordEncoder, read_spec
from .common import crc32, shared_folder, text_bytes, text_column, text_groups, written

INDEX_MAGIC, SEEK_SKIP_MAGIC, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Bytes of ids in one frame at most.
FRAME_BYTES = 64 << 20
LEVEL = 3


class LibraryEncoder(WordEncoder):
    """Ids by the tokenizers library, each distinct word encoded once."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__(spec)
        self._library = Tokenizer.from_str(spec)
        self.largest = self._library.get_vocab_size(with_added_tokens=True) - 1

    def word_ids(self, words: list[str]) -> Iterator[bytes]:
        tokenize = self._library.model.tokenize
        for w in words:
            yield array("I", [t.id for t in tokenize(w)]).tobytes()


_encoders: dict[str, LibraryEncoder] = {}


def _encoder(spec: str) -> LibraryEncoder:
    if spec not in _encoders:
        _encoders.clear()
        _encoders[spec] = LibraryEncoder(spec)
    return _encoders[spec]


class TokenFileWriter:
    """Writes one file; documents are added in order."""

    def __init__(self, sink, width: int):
        self._sink, self._type = sink, np.dtype(f"<u{width}")
        self._frames: list[tuple[int, int, int]] = []
        self._docs: list[tuple[int | None, int]] = []
        self._pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(self._type).tobytes()
        cuts = range(0, max(len(raw), 1), FRAME_BYTES)
        for at in cuts:
            part = raw[at : at + FRAME_BYTES]
            frame = self._pack.compress(part)
            self._sink.write(frame)
            self._frames.append((len(frame), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        self._docs.append((doc_id, len(cuts)))
        self.ids += len(ids)

    def finish(self) -> None:
        index = struct.pack("<4sBBI", b"TIDX", 1, self._type.itemsize, len(self._docs))
        index += b"".join([struct.pack("<qBI", d or 0, d is None, n) for d, n in self._docs])
        self._sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join([struct.pack("<III", *f) for f in self._frames])
        table += struct.pack("<IBI", len(self._frames), 0x80, SEEK_MAGIC)
        self._sink.write(struct.pack("<II", SEEK_SKIP_MAGIC, len(table)) + table)


class TokenFileReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self._source = source
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.frames = table
        self._place = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        head = int(self._place[-1])
        magic, length = struct.unpack("<II", self._at(head, 8))
        index = self._at(head + 8, length)
        mark, _, self.width, docs = struct.unpack("<4sBBI", index[:10])
        if magic != INDEX_MAGIC or mark != b"TIDX":
            raise ValueError("no document index before the seek table")
        entries = np.frombuffer(index[10:], np.dtype([("id", "<i8"), ("null", "u1"), ("frames", "<u4")]))
        self.doc_ids = [None if z else int(i) for i, z in zip(entries["id"], entries["null"], strict=True)]
        self._first = np.concatenate([[0], np.cumsum(entries["frames"], dtype=np.int64)])
        self._unpack = zstandard.ZstdDecompressor()

    def _at(self, place: int, length: int) -> bytes:
        self._source.seek(place)
        return self._source.read(length)

    def ids(self, k: int) -> np.ndarray:
        """Ids of the file's k-th document; its frames only are read."""
        parts = []
        for f in range(int(self._first[k]), int(self._first[k + 1])):
            packed, size, check = self.frames[f].tolist()
            part = self._unpack.decompress(self._at(int(self._place[f]), packed), max_output_size=size)
            if len(part) != size or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {f} does not match its checksum")
            parts.append(part)
        return np.frombuffer(b"".join(parts), f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int | None) -> list[int]:
        return [k for k, d in enumerate(self.doc_ids) if d == doc_id]


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) and return the manifest: part, path,
    n_docs, n_ids and start, the ids in all parts before."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", text_column().alias("text")).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    schema = pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        encoder = _encoder(spec.value)
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tokens"
        store, local = fs.FileSystem.from_uri(path)
        if isinstance(store, fs.LocalFileSystem):
            os.makedirs(os.path.dirname(local), exist_ok=True)
        n = 0
        with store.open_output_stream(local) as sink:
            out = TokenFileWriter(sink, 2 if max(encoder.largest, end_id) < 1 << 16 else 4)
            for batch in _chain(first, batches):
                for piece in text_groups([batch], ENCODE_BYTES):
                    encoded = encoder.encode(text_bytes(piece))
                    for d, i in zip(piece.column(0).to_pylist(), encoded, strict=True):
                        out.add(d, np.append(np.frombuffer(i, "<u4"), np.uint32(end_id)))
                        n += 1
            out.finish()
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([path]), pa.array([n]), pa.array([out.ids])], schema=schema)

    manifest = written(ordered.mapInArrow(run, "part bigint, path string, n_docs bigint, n_ids bigint"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def _open(path: str) -> TokenFileReader:
    store, local = fs.FileSystem.from_uri(path)
    return TokenFileReader(store.open_input_file(local))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document from the files: doc_id, start, n_tokens, ids_crc32."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = _open(path)
                found = []
                for k, doc_id in enumerate(reader.doc_ids):
                    ids = reader.ids(k)
                    found.append((doc_id, start, len(ids), crc32(ids.tobytes())))
                    start += len(ids)
                cols = zip(*found, strict=True) if found else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

    files = manifest.select("path", "start").repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def fetch_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[np.ndarray]]:
    """The ids of some documents of one file, without reading the rest."""
    reader = _open(path)
    return {d: [reader.ids(k) for k in reader.find(d)] for d in doc_ids}
