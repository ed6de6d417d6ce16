"""Byte-level BPE encoding and decoding by a local rank file.

A rank file lists one vocabulary entry a line, base64 bytes and rank; it is
read by the driver, broadcast (its size does not depend on the data) and
loaded into the tiktoken library once per worker.

*Long texts.*  The library matches its split pattern over one whole string,
and its matcher runs out of stack on white space of a million characters.
A text of more than ``PART_CHARS`` is therefore cut first, at places where
the pattern must end a match whatever stands around them:

* before white space that follows something else: no alternative of the
  pattern goes on from another character to white space;
* between ASCII letters, digits and other signs, but for a letter after an
  apostrophe (``'s`` is one match), and between Chinese letters and their
  punctuation.

Nothing looks behind, and the one lookahead follows white space, so the
matches on both sides stay as they are.  A run of over ``LONG_BLANK`` white
space characters is encoded as the single match that it is: all of it at the
end of a text, else all but its last character.  A run without any safe
place (one endless word) is one match of the pattern in any case.

*Raw-byte decoding.*  Ids are decoded to bytes, not to characters: a token
may end inside a character.  The parts' bytes joined are the text's.

Null counts as an empty text: no ids, no bytes.  Bytes that are no UTF-8
count as U+FFFD each way.  Repeated rows give equal rows.  Columns of
``docs`` that bear the name of an added one are replaced, all others kept.
The library functions need this package on the executors' path
(``common.ship`` or ``--py-files``).
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .common import text_bytes, text_groups, with_columns

PART_CHARS = 1 << 16
LONG_BLANK = 1 << 14

#: Unicode white space; fixed values of the standard.
_BLANK = r"\t-\r\x20\x85\xa0  -     　"
_SIGN = r"!-&(-/:-@\[-`{-~"  # ASCII signs but the apostrophe
_HAN, _HAN_SIGN = r"一-龥", r"、。，"

SAFE = re.compile(
    rf"(?<=[^{_BLANK}])(?=[{_BLANK}])"
    rf"|(?<=[A-Za-z])(?=[0-9'{_SIGN}])|(?<=[0-9])(?=[A-Za-z'{_SIGN}])|(?<=[{_SIGN}])(?=[A-Za-z0-9])|(?<=')(?=[0-9])"
    rf"|(?<=[{_HAN}])(?=[{_HAN_SIGN}])|(?<=[{_HAN_SIGN}])(?=[{_HAN}])"
)


def parts(text: str, part_chars: int = PART_CHARS, long_blank: int = LONG_BLANK) -> Iterator[tuple[str, bool]]:
    """Cut a text into (part, is one match); the parts' matches in a row are
    the text's matches."""
    if len(text) <= min(part_chars, long_blank):
        if text:
            yield text, False
        return
    at = 0
    for blank in re.finditer(rf"[{_BLANK}]{{{long_blank},}}", text):
        yield from _between(text, at, blank.start(), part_chars)
        at = blank.end() if blank.end() == len(text) else blank.end() - 1
        if at > blank.start():
            yield text[blank.start() : at], True
    yield from _between(text, at, len(text), part_chars)


def _between(text: str, at: int, end: int, part_chars: int) -> Iterator[tuple[str, bool]]:
    while end - at > part_chars:
        safe = SAFE.search(text, at + part_chars, end)
        if safe is None or safe.start() >= end:
            break
        yield text[at : safe.start()], False
        at = safe.start()
    if end > at:
        yield text[at:end], False


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: bytes, pattern: str):
        lines = (line.split() for line in ranks.splitlines() if line.strip())
        table = {base64.b64decode(entry): int(rank) for entry, rank in lines}
        self._encoding = tiktoken.Encoding("rank-file", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._decimal = [str(i).encode() for i in range(max(table.values(), default=-1) + 1)]

    def encode(self, text: str, part_chars: int = PART_CHARS, long_blank: int = LONG_BLANK) -> Iterator[list[int]]:
        """Ids part by part."""
        for part, one in parts(text, part_chars, long_blank):
            yield self._encoding._encode_single_piece(part) if one else self._encoding.encode_ordinary(part)

    def decode(self, ids: list[int]) -> bytes:
        return self._encoding.decode_bytes(ids)

    def decimals(self, ids: list[int]) -> bytes:
        decimal = self._decimal
        return b" ".join([decimal[i] for i in ids])


_codecs: dict[tuple[bytes, str], Codec] = {}


def codec(ranks: bytes, pattern: str) -> Codec:
    """The worker's codec of a rank file, built once per process."""
    key = hashlib.sha256(ranks).digest(), pattern
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


_KINDS = {"n_tokens": ("bigint", pa.int64()), "ids": ("binary", pa.binary()), "decoded": ("binary", pa.binary()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}


class _Row:
    """The wanted columns of one text, gathered part by part."""

    def __init__(self, wanted: tuple[str, ...]):
        self.n_tokens, self._ids, self._decoded = 0, [], []
        self._keep_ids, self._keep_decoded = "ids" in wanted, "decoded" in wanted
        self._ids_sha, self._decoded_sha = hashlib.sha256(), hashlib.sha256()
        self._want_ids_sha = "ids_sha256" in wanted
        self._want_bytes = self._keep_decoded or "decoded_sha256" in wanted

    def add(self, c: Codec, ids: list[int]) -> None:
        if self._want_ids_sha and ids:
            self._ids_sha.update(b" " + c.decimals(ids) if self.n_tokens else c.decimals(ids))
        self.n_tokens += len(ids)
        if self._keep_ids:
            self._ids.append(array("I", ids).tobytes())
        if self._want_bytes:
            data = c.decode(ids)
            self._decoded_sha.update(data)
            if self._keep_decoded:
                self._decoded.append(data)

    def value(self, name: str):
        match name:
            case "n_tokens":
                return self.n_tokens
            case "ids":
                return b"".join(self._ids)
            case "decoded":
                return b"".join(self._decoded)
            case "ids_sha256":
                return self._ids_sha.hexdigest()
            case _:
                return self._decoded_sha.hexdigest()


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, columns: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """``docs`` (with ``text``) and the named ``columns`` of: ``n_tokens``,
    ``ids`` (binary, little-endian unsigned 32-bit), ``decoded`` (binary, the
    ids' raw bytes), ``ids_sha256`` (of the decimal ids joined by one space)
    and ``decoded_sha256``.  One narrow pass, no shuffle."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    docs = docs.drop(*_KINDS)
    schema = with_columns(docs, ", ".join(f"{c} {_KINDS[c][0]}" for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks.value, pattern)
        for part in text_groups(batches):
            rows = []
            for text in text_bytes(part):
                row = _Row(columns)
                for ids in c.encode(text.decode("utf-8", "replace")):
                    row.add(c, ids)
                rows.append(row)
            added = [pa.array([r.value(name) for r in rows], _KINDS[name][1]) for name in columns]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *columns])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``, the raw bytes of its ``ids``."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks.value, pattern)
        for part in text_groups(batches, column="ids"):
            done = [c.decode(memoryview(ids).cast("I").tolist() if ids else []) for ids in text_bytes(part, "ids")]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(done, pa.binary())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, with_columns(encoded, "decoded binary"))
