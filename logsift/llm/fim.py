"""Fill-in-middle transformation over seekable compressed frames.

*Store.*  A text is kept as independent zstandard frames of ``FRAME_BYTES``
of UTF-8, cut between characters, with a seek table of the frames'
compressed sizes and the running counts of bytes, characters and units up
to each.  Units are ``[blanks]word`` from left to right, and blanks at the
end of the text are one more; the unit that ends with a frame's last byte
counts to that frame.

*Select.*  A document's two cuts and its form follow from a hash of its key.
A cut is sought in the unit counts, and only the frame that holds it is
decompressed.  The output is a new order of frames: those between cuts are
taken over as they are, compressed; the parts of a cut frame and the marks
become frames of their own.

*Restore.*  The output's frames are streamed in order: the marks are found
in the running bytes, and the parts between them put back in text order,
frame by frame, so that never more than one frame is held open.

Null counts as an empty text, which stays plain; a null key hashes as an
empty one.  Equal keys are cut alike; repeated rows give equal rows.  Columns
of ``docs`` that bear the name of an added one are replaced, others kept.
The library functions need this package on the executors' path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import text_bytes, text_groups, with_columns

FRAME_BYTES = 1 << 16
LEVEL = 1
SEED = 42
PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_press, _expand = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
_MARK = {m: _press.compress(m) for m in (PREFIX, SUFFIX, MIDDLE)}

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True

FRAMES_DDL = "frames binary, sizes array<int>, bytes_upto array<bigint>, chars_upto array<bigint>, units_upto array<bigint>, n bigint, marked boolean"


@dataclass
class Frames:
    """A stored text: its frames' bytes one after another, and the seek
    table; ``*_upto[k]`` counts what lies in frames 0 to k."""

    frames: bytes
    sizes: list[int]
    bytes_upto: list[int]
    chars_upto: list[int]
    units_upto: list[int]
    n: int
    marked: bool

    def frame(self, k: int) -> bytes:
        start = sum(self.sizes[:k])
        return self.frames[start : start + self.sizes[k]]


def _starts_char(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _unit_ends(data: np.ndarray, next_blank: bool) -> np.ndarray:
    """Offsets just after each word's last byte; ``next_blank``: what follows
    the data is a blank or nothing."""
    blank = _IS_BLANK[data]
    return np.flatnonzero(~blank & np.append(blank[1:], next_blank)) + 1


def store(text: bytes, frame_bytes: int = FRAME_BYTES) -> Frames:
    """The frames of one UTF-8 text."""
    done = Frames(b"", [], [], [], [], 0, any(m in text for m in (PREFIX, SUFFIX, MIDDLE)))
    out, at, chars, units = [], 0, 0, 0
    while at < len(text):
        end = min(at + frame_bytes, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        piece = text[at:end]
        data = np.frombuffer(piece, np.uint8)
        chars += int(_starts_char(data).sum())
        units += len(_unit_ends(data, end == len(text) or bool(_IS_BLANK[text[end]])))
        out.append(_press.compress(piece))
        done.sizes.append(len(out[-1]))
        done.bytes_upto.append(end)
        done.chars_upto.append(chars)
        done.units_upto.append(units)
        at = end
    done.frames = b"".join(out)
    done.n = units + (1 if text and _IS_BLANK[text[-1]] else 0)
    return done


@dataclass
class Cut:
    """A place in a stored text: frame, byte in it, and characters before."""

    frame: int
    byte: int
    chars: int


def seek(stored: Frames, units: int, opened: dict[int, bytes]) -> Cut:
    """The place after ``units`` units; opens one frame at most, and keeps
    it in ``opened``."""
    if units <= 0:
        return Cut(0, 0, 0)
    if units >= stored.n:
        return Cut(len(stored.sizes), 0, stored.chars_upto[-1])
    k = int(np.searchsorted(np.array(stored.units_upto), units))
    if k not in opened:
        opened[k] = _expand.decompress(stored.frame(k))
    data = np.frombuffer(opened[k], np.uint8)
    before = stored.units_upto[k - 1] if k else 0
    byte = int(_unit_ends(data, True)[units - before - 1])
    chars = (stored.chars_upto[k - 1] if k else 0) + int(_starts_char(data[:byte]).sum())
    return Cut(k, byte, chars)


def plan(key: object, n: int, marked: bool, seed: int = SEED, percent: int = PERCENT, spm_percent: int = SPM_PERCENT) -> tuple[str, int, int]:
    """(form, units of the prefix, units up to the middle's end)."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    if n == 0 or marked or h3 % 100 >= percent:
        return "plain", first, last
    return ("spm" if h4 % 100 < spm_percent else "psm"), first, last


def _pieces(stored: Frames, a: Cut, b: Cut, opened: dict[int, bytes]) -> Iterator[bytes]:
    """Compressed frames of the text between two cuts; whole frames as they
    are stored."""
    start = sum(stored.sizes[: a.frame])
    for k in range(a.frame, min(b.frame + 1, len(stored.sizes))):
        size = stored.sizes[k]
        low = a.byte if k == a.frame else 0
        high = b.byte if k == b.frame else None
        if low == 0 and high is None:
            yield stored.frames[start : start + size]
        elif high is None or high > low:
            if k not in opened:
                opened[k] = _expand.decompress(stored.frames[start : start + size])
            part = opened[k][low:high]
            if part:
                yield _press.compress(part)
        start += size


def rearrange(stored: Frames, form: str, first: int, last: int) -> tuple[list[bytes], int | None, int | None]:
    """(output frames, characters of the prefix, characters of the middle)."""
    ends = Cut(0, 0, 0), Cut(len(stored.sizes), 0, stored.chars_upto[-1] if stored.sizes else 0)
    opened: dict[int, bytes] = {}
    if form == "plain":
        return list(_pieces(stored, *ends, opened)), None, None
    a, b = seek(stored, first, opened), seek(stored, last, opened)
    prefix, middle, suffix = (list(_pieces(stored, x, y, opened)) for x, y in ((ends[0], a), (a, b), (b, ends[1])))
    if form == "psm":
        out = [_MARK[PREFIX], *prefix, _MARK[SUFFIX], *suffix, _MARK[MIDDLE], *middle]
    else:
        out = [_MARK[SUFFIX], *suffix, _MARK[PREFIX], *prefix, _MARK[MIDDLE], *middle]
    return out, a.chars, b.chars - a.chars


def opened(frames: list[bytes]) -> Iterator[bytes]:
    """The frames' contents in order, one frame at a time."""
    for f in frames:
        yield _expand.decompress(f)


def marks_at(frames: list[bytes], order: tuple[bytes, ...]) -> list[int]:
    """Byte places of the marks, in this order, in the running bytes."""
    found, base, carry = [], 0, b""
    for piece in opened(frames):
        window = carry + piece
        start = 0
        while len(found) < len(order):
            at = window.find(order[len(found)], start)
            if at < 0:
                break
            found.append(base + at)
            start = at + len(order[0])
        keep = min(len(order[0]) - 1, len(window) - start)
        base += len(window) - keep
        carry = window[len(window) - keep :]
    if len(found) != len(order):
        raise ValueError("the output lacks one of its marks")
    return found


def _between(frames: list[bytes], low: int, high: int | None) -> Iterator[bytes]:
    at = 0
    for piece in opened(frames):
        if high is not None and at >= high:
            return
        part = piece[max(low - at, 0) : None if high is None else high - at]
        at += len(piece)
        if part:
            yield part


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The exact text, in pieces, from an output's frames and its form."""
    if form == "plain":
        yield from opened(frames)
        return
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    at = marks_at(frames, order)
    width = len(PREFIX)
    part = {m: (at[k] + width, at[k + 1] if k + 1 < len(at) else None) for k, m in enumerate(order)}
    for m in (PREFIX, MIDDLE, SUFFIX):
        yield from _between(frames, *part[m])


def store_frames(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``docs`` without ``text`` and with its frames and seek table: frames,
    sizes, bytes_upto, chars_upto, units_upto, n (units) and marked (holds
    one of the marks)."""
    docs = docs.drop(*[c.split()[0] for c in FRAMES_DDL.split(", ")])
    rest = [c for c in docs.columns if c != "text"]
    schema = with_columns(docs.select(*[f"`{c}`" for c in rest]), FRAMES_DDL)
    lists = pa.list_(pa.int64())
    kinds = (pa.binary(), pa.list_(pa.int32()), lists, lists, lists, pa.int64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches):
            done = [store(t, frame_bytes) for t in text_bytes(part)]
            cols = [pa.array([getattr(f, name) for f in done], kind) for name, kind in zip(Frames.__annotations__, kinds, strict=True)]
            keep = [part.column(part.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*keep, *cols], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


_OUT = {
    "form": ("string", pa.string()),
    "prefix_chars": ("bigint", pa.int64()),
    "middle_chars": ("bigint", pa.int64()),
    "output_frames": ("array<binary>", pa.list_(pa.binary())),
    "output": ("string", pa.string()),
    "output_sha256": ("string", pa.string()),
    "restored_sha256": ("string", pa.string()),
}


def transform(
    stored: DataFrame,
    columns: tuple[str, ...] = ("form", "prefix_chars", "middle_chars", "output_frames"),
    *,
    key: str = "doc_id",
    seed: int = SEED,
    percent: int = PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """Rows of ``store_frames`` with the named ``columns`` of: ``form``,
    ``prefix_chars`` and ``middle_chars`` (null if plain), ``output_frames``,
    ``output`` (the text itself), and the digests ``output_sha256`` and
    ``restored_sha256``, both streamed from the output's frames.  The frames
    and the seek table are left out of the result."""
    table = [c.split()[0] for c in FRAMES_DDL.split(", ")]
    rest = [c for c in stored.columns if c not in (*table, *_OUT)]
    schema = with_columns(stored.select(*[f"`{c}`" for c in (*rest, "n")]), ", ".join(f"{c} {_OUT[c][0]}" for c in columns))
    stored = stored.select(*[f"`{c}`" for c in (*rest, *table)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches, column="frames"):
            at = part.schema.get_field_index
            keys = part.column(at(key)).to_pylist()
            rows = zip(*(part.column(at(c)).to_pylist() for c in table), strict=True)
            out: dict[str, list] = {c: [] for c in columns}
            for k, row in zip(keys, rows, strict=True):
                text = Frames(*row)
                form, first, last = plan(k, text.n, text.marked, seed, percent, spm_percent)
                frames, prefix_chars, middle_chars = rearrange(text, form, first, last)
                for c in columns:
                    out[c].append(_value(c, form, frames, prefix_chars, middle_chars))
            keep = [part.column(at(c)) for c in (*rest, "n")]
            cols = [pa.array(out[c], _OUT[c][1]) for c in columns]
            yield pa.RecordBatch.from_arrays([*keep, *cols], names=schema.fieldNames())

    return stored.mapInArrow(run, schema)


def _digest(pieces: Iterator[bytes]) -> str:
    sha = hashlib.sha256()
    for p in pieces:
        sha.update(p)
    return sha.hexdigest()


def _value(column: str, form: str, frames: list[bytes], prefix_chars: int | None, middle_chars: int | None):
    match column:
        case "form":
            return form
        case "prefix_chars":
            return prefix_chars
        case "middle_chars":
            return middle_chars
        case "output_frames":
            return frames
        case "output":
            return b"".join(opened(frames)).decode("utf-8", "replace")
        case "output_sha256":
            return _digest(opened(frames))
        case _:
            return _digest(restored(frames, form))
