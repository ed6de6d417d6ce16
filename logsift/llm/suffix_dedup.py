"""Removal of repeated long byte strings with a logarithmic index family.

Every byte covered by a ``length``-byte string that also starts anywhere
else (same document included) is removed.  Texts are their UTF-8 bytes;
matches never cross documents.

*Anchors in place of suffix arrays.*  Each ``length``-byte window names one of the
``ANCHOR``-byte strings in it as its anchor: the one with the smallest
hash, the leftmost of equals.  Equal windows name equal anchors at equal
offsets, so only suffixes at anchors are indexed, about one in 140 places.
An anchor stands for the run of consecutive windows that name it; its
context is all bytes of these windows.  An index entry is (anchor, context
class, number of occurrences), hashed and not sorted: no suffix array is
built, and equal anchors meet in joins.

*Index family.*  Documents come in batches.  A batch's entries are joined
with each level of the family on equal anchors; then the batch
becomes a level, and levels of equal size are merged, so the family keeps
at most log2(batches) + 1 levels and an entry is rewritten that often.  The
joins yield the classes that occur twice, whose whole contexts are
repeated, and the anchors with several classes, where contexts match in
part.

*Partial matches.*  The one occurrence of each single class sends its
context to its anchor; contexts of one anchor are compared window by
window at equal offsets by 128-bit rolling hashes.  An anchor with more
than ``GROUP_CLASSES`` classes is compared by a distributed count of its
windows instead, with the same result.

*Shared passages.*  :func:`shared_seeds` counts, far more cheaply, how many
sampled passages of ``SEED_WORDS`` words of a document occur elsewhere.  One
is sampled from every ``PASSAGE_WORDS`` words in a row, the one of smallest
hash, so equal passages of that length share at least one sample.

*Words.*  With ``unit="words"`` the same is done on words
(``[^\\x20\\x09-\\x0D]+``): a text is read as a string of 6-byte word codes, and
the spans found are carried back to the text's bytes, from the first byte of
a run's first word to the last of its last; what stands between words does
not matter.  Two different words share a code with probability 2**-48, which
matters only where all other words of a passage agree.

Null or empty texts have nothing to remove.  Rows equal in doc_id and text
are repeats of each other.  A null doc_id is a value like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, text_bytes, text_groups, with_columns, written

LENGTH = 400
ANCHOR_SHARE = 0.32
BATCHES = 4
GROUP_CLASSES = 50_000
#: Windows of contexts that a task compares at once.
BAND_WINDOWS = 1 << 19
TILE = 1 << 16
PASSAGE_WORDS = 50
WORD_CODE = 6
SEED_WORDS = 25
HOT_PARTS = 10_000

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")

_rng = np.random.default_rng(400)
_BYTE = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    size = 1 << max(12, (n - 1).bit_length())
    if (which, size) not in _powers:
        base = _BASES[which]
        inverse = pow(base, -1, 1 << 64)
        up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)])
        down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, inverse, np.uint64)])
        _powers[which, size] = up, down
    up, down = _powers[which, size]
    return up[:n], down[:n]


def rolling(data: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of the ``width`` bytes from each place."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power(which, len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[which][data] * up, out=total[1:])
    out = (total[width:] - total[:n]) * down[:n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


def _window_minimum(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of the ``width`` values from each place."""
    n = len(key) - width + 1
    blocks = -(-len(key) // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(key)] = key
    grid = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int, anchor: int) -> Iterator[tuple[int, int, int, int]]:
    """(text, anchor place, first and last window start) per anchor."""
    index = [i for i, t in enumerate(texts) if len(t) >= length]
    if not index:
        return
    data = np.frombuffer(b"".join([texts[i] for i in index]), np.uint8)
    size = np.array([len(texts[i]) for i in index], np.int64)
    first = np.cumsum(size) - size
    starts = len(data) - length + 1
    width = length - anchor + 1
    chosen = np.empty(starts, np.int64)
    low = np.uint64((1 << 20) - 1)
    for a in range(0, starts, TILE):
        b = min(a + TILE, starts)
        h = rolling(data[a : b + length - 1], anchor)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        chosen[a:b] = a + (_window_minimum(key, width) & low).astype(np.int64)
    owner = np.repeat(np.arange(len(index)), size)[:starts]
    valid = np.arange(starts) + length <= (first + size)[owner]
    at = np.flatnonzero(valid)
    c, o = chosen[at], owner[at]
    new = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (o[1:] != o[:-1])])
    last = np.r_[new[1:], len(at)] - 1
    base = first[o[new]]
    yield from zip([index[i] for i in o[new].tolist()], (c[new] - base).tolist(), (at[new] - base).tolist(), (at[last] - base).tolist(), strict=True)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def word_codes(text: bytes) -> bytes:
    """The text's words, each as ``WORD_CODE`` bytes."""
    digest = xxhash.xxh3_64_digest
    return b"".join([digest(w)[:WORD_CODE] for w in text.split()])


_READ = {"bytes": bytes, "words": word_codes}


def _word_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of word codes as spans of the text's bytes."""
    if not spans:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    whole = ((-(-a // WORD_CODE), b // WORD_CODE) for a, b in spans)
    return [(at[a][0], at[b - 1][1]) for a, b in whole if a < b]


def occurrences(docs: DataFrame, length: int, anchor: int, unit: str = "bytes") -> DataFrame:
    """doc, place, low, high (window starts), anchor h, class c; ``docs``:
    (doc, text)."""
    names = ["doc", "place", "low", "high", "h", "c"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for part in text_groups(batches, 2 << 20):
            texts, ids = [_READ[unit](t) for t in text_bytes(part)], part.column(0).to_pylist()
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            add = [c.append for c in cols]
            for i, place, low, high in anchors(texts, length, anchor):
                t = texts[i]
                row = (ids[i], place, low, high, _signed(digest(t[place : place + anchor])), _signed(digest(t[low : high + length], seed=place - low)))
                for put, v in zip(add, row, strict=True):
                    put(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return docs.select("doc", "text").mapInArrow(run, "doc bigint, place int, low int, high int, h bigint, c bigint")


@dataclass
class IndexFamily:
    """Levels of entries (h, c, n); level sizes are powers of two batches."""

    levels: list[tuple[int, DataFrame]] = field(default_factory=list)
    #: every table the family wrote, for :meth:`close`
    tables: list[DataFrame] = field(default_factory=list)

    def add(self, entries: DataFrame) -> DataFrame:
        """Index a batch's entries; returns (h, c, twice): the classes that
        share their anchor with another class or occurrence, found within
        the batch and against each level."""
        entries = self._keep(entries, "index-level")
        found = [self._scan(entries, None)]
        found += [self._scan(entries, level) for _, level in self.levels]
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        size, level = 1, entries
        while self.levels and self.levels[-1][0] == size:
            _, other = self.levels.pop()
            level = other.unionByName(level).groupBy("h", "c").agg(F.sum("n").alias("n"))
            size *= 2
        if size > 1:
            out = self._keep(out, "index-scan")  # before the merged levels are replaced
            level = self._keep(level, "index-level")
        self.levels.append((size, level))
        return out

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(written(df, name))
        return self.tables[-1]

    def close(self) -> None:
        """Delete the family, once what its scans found has been written."""
        discard(*self.tables)

    @staticmethod
    def _scan(batch: DataFrame, level: DataFrame | None) -> DataFrame:
        """Merge scan of a batch with one level (or itself) by anchor."""
        if level is None:
            rows = batch.select("h", "c", "n")
            few = rows.groupBy("h").agg(F.min("c").alias("_a"), F.max("c").alias("_b"), F.sum("n").alias("_n"))
            few = few.filter("_n > 1")
        else:
            rows = batch.select("h", "c", "n").unionByName(level.select("h", "c", "n"))
            sides = batch.select("h", "c", "n", F.lit(1).alias("_s")).unionByName(level.select("h", "c", "n", F.lit(2).alias("_s")))
            few = sides.groupBy("h").agg(F.min("_s").alias("_x"), F.max("_s").alias("_y")).filter("_x != _y")
        both = rows.join(few.select("h"), "h")
        return both.groupBy("h", "c").agg((F.sum("n") > 1).alias("twice"))


def repeated_classes(found: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(h, c, twice, classes) of every class whose anchor occurs twice, by
    passing the occurrences through an index family batch by batch."""
    family, out = IndexFamily(), None
    for k in range(batches):
        batch = found.filter(F.pmod(F.hash("doc"), F.lit(batches)) == k)
        new = family.add(batch.groupBy("h", "c").agg(F.count("*").alias("n")))
        out = new if out is None else out.unionByName(new)
    classes = out.groupBy("h", "c").agg(F.max("twice").alias("twice"))
    classes = written(classes, "classes")
    family.close()
    return classes


def _context_hashes(context: bytes, low: int, place: int, length: int) -> list[np.ndarray]:
    """Per window of a context: offset from the anchor, and two hashes."""
    data = np.frombuffer(context, np.uint8)
    count = len(data) - length + 1
    return [np.arange(low - place, low - place + count), rolling(data, length, 0), rolling(data, length, 1)]


def _offset_bands(first: np.ndarray, count: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of offsets that hold about ``BAND_WINDOWS`` windows, one offset
    at least, of contexts with ``count`` windows from offset ``first`` on."""
    if not count.sum():
        return []
    start, stop = int(first.min()), int((first + count).max())
    at = np.zeros(stop - start + 1, np.int64)
    np.add.at(at, first - start, 1)
    np.add.at(at, first + count - start, -1)
    before = np.r_[0, np.cumsum(np.cumsum(at[:-1]))]
    cuts = [0]
    while cuts[-1] < stop - start:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(before, before[cuts[-1]] + BAND_WINDOWS, side="right")) - 1))
    return [(start + i, start + j) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _repeated_windows(rows: list[tuple], length: int) -> list[np.ndarray]:
    """Per row (h, doc, place, low, single, context) which windows of its
    context another row of the same h has at the same offset.  Windows are
    compared band by band of offsets, since a hot anchor has millions."""
    hashes = [_context_hashes(r[5], r[3], r[2], length)[1:] for r in rows]
    first = np.array([r[3] - r[2] for r in rows], np.int64)
    count = np.array([len(x) for x, _ in hashes], np.int64)
    anchor = np.array([r[0] for r in rows], np.int64)
    hits = [np.zeros(n, bool) for n in count.tolist()]
    for a, b in _offset_bands(first, count):
        begin, end = np.clip(a - first, 0, count), np.clip(b - first, 0, count)
        inside = np.flatnonzero(end > begin).tolist()
        spans = [(i, int(begin[i]), int(end[i])) for i in inside]
        sizes = [v - u for _, u, v in spans]
        group = np.repeat(anchor[inside], sizes)
        offset = np.concatenate([np.arange(u, v) + first[i] for i, u, v in spans])
        x, y = (np.concatenate([hashes[i][k][u:v] for i, u, v in spans]) for k in range(2))
        order = np.lexsort((y, x, offset, group))
        same = np.ones(max(len(order) - 1, 0), bool)
        for key in (group, offset, x, y):
            key = key[order]
            same &= key[1:] == key[:-1]
        hit = np.zeros(len(order), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        at = 0
        for i, u, v in spans:
            hits[i][u:v] = hit[at : at + v - u]
            at += v - u
    return hits


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Spans covered by windows at sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    begins, ends = np.r_[starts[0], starts[cut + 1]], np.r_[starts[cut], starts[-1]] + length
    return list(zip(begins.tolist(), ends.tolist(), strict=True))


SPAN = pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])


def _compare(contexts: DataFrame, length: int) -> DataFrame:
    """(doc, start, stop): parts of single contexts that some other context
    of the same anchor repeats; contexts: (h, doc, place, low, single, context)."""

    def judge(rows: list[tuple]) -> pa.RecordBatch:
        spans = []
        for r, hit in zip(rows, _repeated_windows(rows, length), strict=True):
            if r[4]:
                spans += [(r[1], a, b) for a, b in _runs(r[3] + np.flatnonzero(hit), length)]
        cols = zip(*spans, strict=True) if spans else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SPAN, strict=True)], schema=SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = [], 0
        for part in text_groups(batches, 1 << 20, "context"):
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if total > 1 << 20 and row[0] != rows[-1][0]:
                    yield judge(rows)
                    rows, total = [], 0
                rows.append(row)
                total += len(row[5])
        if rows:
            yield judge(rows)

    dealt = contexts.select("h", "doc", "place", "low", "single", "context").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "doc bigint, start int, stop int")


def _compare_large(contexts: DataFrame, length: int) -> DataFrame:
    """The same by counting all windows of the anchors' contexts."""
    names = ["h", "doc", "start", "single", "offset", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches, 1 << 18, "context"):
            for h, doc, place, low, single, context in zip(*(c.to_pylist() for c in part.columns), strict=True):
                offset, x, y = _context_hashes(context, low, place, length)
                n = len(offset)
                cols = [np.full(n, h, np.int64), np.full(n, doc, np.int64), (low + np.arange(n)).astype(np.int32), np.full(n, single), offset.astype(np.int32), x.view(np.int64), y.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    schema = "h bigint, doc bigint, start int, single boolean, offset int, x bigint, y bigint"
    rows = contexts.select("h", "doc", "place", "low", "single", "context").mapInArrow(run, schema)
    twice = rows.groupBy("h", "offset", "x", "y").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    hit = rows.filter("single").join(twice, ["h", "offset", "x", "y"])
    return hit.select("doc", "start", (F.col("start") + length).alias("stop"))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, unit: str = "bytes", batches: int = BATCHES, group_classes: int = GROUP_CLASSES) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``kept`` (binary, the remaining
    bytes), ``n_bytes``, ``n_removed``, ``n_spans`` and ``spans`` (array of
    start and stop, in bytes); input columns of these names are replaced.
    ``length`` counts ``unit``: "bytes" or "words"."""
    names = [c for c in docs.columns if c not in ("kept", "n_bytes", "n_removed", "n_spans", "spans")]
    own = [F.col(f"`{c}`") for c in names]
    length = length * WORD_CODE if unit == "words" else length
    read = _READ[unit]
    anchor = max(1, int(length * ANCHOR_SHARE))
    keyed = docs.select(*own, F.xxhash64(F.col("doc_id"), F.col("text")).alias("_doc"))
    found = written(occurrences(keyed.select(F.col("_doc").alias("doc"), "text"), length, anchor, unit), "anchors")
    classes = repeated_classes(found, batches)
    wide = classes.groupBy("h").agg(F.count("*").alias("classes")).filter("classes > 1")
    marked = found.join(classes, ["h", "c"]).join(wide, "h", "left")
    marked = written(marked, "marked")
    discard(found, classes)
    whole = marked.filter("twice").groupBy("doc").agg(F.collect_set(F.struct("low", (F.col("high") + length).alias("stop"))).alias("_whole"))
    asked = marked.filter("classes > 1")
    one = asked.groupBy("h", "c").agg(F.min(F.struct("doc", "place", "low", "high")).alias("o"), F.first("twice").alias("twice"), F.first("classes").alias("classes"))
    asks = one.groupBy(F.col("o.doc").alias("doc")).agg(
        F.collect_list(F.struct("h", F.col("o.place").alias("place"), F.col("o.low").alias("low"), F.col("o.high").alias("high"), (~F.col("twice")).alias("single"), (F.col("classes") > group_classes).alias("large"))).alias("_asks")
    )
    wanted = whole.join(asks, "doc", "full_outer").withColumnRenamed("doc", "_doc")
    joined = keyed.join(wanted, "_doc", "left")
    context = pa.struct([("h", pa.int64()), ("place", pa.int32()), ("low", pa.int32()), ("single", pa.bool_()), ("large", pa.bool_()), ("context", pa.binary())])
    at = {c: i for i, c in enumerate(joined.columns)}

    def gather(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches_):
            rows = []
            for t, asks_ in zip(text_bytes(part), part.column(at["_asks"]).to_pylist(), strict=True):
                t = read(t) if asks_ else b""
                rows.append([{k: a[k] for k in ("h", "place", "low", "single", "large")} | {"context": t[a["low"] : a["high"] + length]} for a in asks_ or ()] or None)
            keep = [part.column(at[c]) for c in (*names, "_doc", "_whole")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(rows, pa.list_(context))], names=[*names, "_doc", "_whole", "_contexts"])

    gathered = written(
        joined.mapInArrow(gather, with_columns(joined.select(*own, "_doc", "_whole"), "_contexts array<struct<h:bigint,place:int,low:int,single:boolean,large:boolean,context:binary>>")),
        "gathered",
        codec="zstd",
    )
    contexts = gathered.filter("_contexts is not null").select(F.col("_doc").alias("doc"), F.explode("_contexts").alias("x")).select("doc", "x.*")
    spans = _compare(contexts.filter("not large"), length).unionByName(_compare_large(contexts.filter("large"), length))
    parts = written(spans, "part-spans").groupBy(F.col("doc").alias("_doc")).agg(F.collect_set(F.struct(F.col("start").alias("low"), "stop")).alias("_parts"))
    waits = F.coalesce(F.exists("_contexts", lambda x: x["single"]), F.lit(False))
    pending = gathered.filter(waits).drop("_contexts").join(parts, "_doc", "left")
    rest = gathered.filter(~waits).drop("_contexts").withColumn("_parts", F.lit(None).cast("array<struct<low:int,stop:int>>"))
    both = rest.unionByName(pending)
    where = {c: i for i, c in enumerate(both.columns)}
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def finish(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches_):
            cols: tuple[list, ...] = ([], [], [], [], [])
            lists = zip(part.column(where["_whole"]).to_pylist(), part.column(where["_parts"]).to_pylist(), strict=True)
            for t, (whole_, parts_) in zip(text_bytes(part), lists, strict=True):
                spans_ = _union([(s["low"], s["stop"]) for s in (whole_ or []) + (parts_ or [])])
                if unit == "words":
                    spans_ = _word_spans(t, spans_)
                kept = _cut(t, spans_)
                row = (kept, len(t), len(t) - len(kept), len(spans_), [{"start": a, "stop": b} for a, b in spans_])
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), span_type]
            keep = [part.column(where[c]) for c in names]
            yield pa.RecordBatch.from_arrays([*keep, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*names, "kept", "n_bytes", "n_removed", "n_spans", "spans"])

    return both.mapInArrow(finish, with_columns(docs.select(*own), "kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:int,stop:int>>"))


def seeds(words: np.ndarray, passage: int = PASSAGE_WORDS, size: int = SEED_WORDS) -> np.ndarray:
    """Hashes of the sampled ``size``-word passages of a text given by its
    words' hashes: of every ``passage`` words in a row, the passage of
    smallest hash (the leftmost of equals); each hash once."""
    grams = len(words) - size + 1
    if len(words) < passage:
        return np.zeros(0, np.uint64)
    up, down = _power(0, len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, out=total[1:])
    h = (total[size:] - total[:grams]) * down[:grams]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(_window_minimum(h, passage - size + 1))


def _seed_rows(docs: DataFrame) -> DataFrame:
    """(doc, h) of every row's seeds, and one row with h null for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for part in text_groups(batches, 2 << 20):
            found = [seeds(np.array([digest(w) for w in t.split()], np.uint64)) for t in text_bytes(part)]
            n = np.array([len(f) + 1 for f in found])
            doc = np.repeat(part.column(0).to_numpy(zero_copy_only=False), n)
            h = np.zeros(int(n.sum()), np.int64)
            ends = np.cumsum(n) - 1
            inner = np.ones(len(h), bool)
            inner[ends] = False
            h[inner] = np.concatenate(found).view(np.int64) if found else h[inner]
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(h, pa.int64(), mask=~inner)], names=["doc", "h"])

    return docs.select("doc", "text").mapInArrow(run, "doc bigint, h bigint")


def shared_seeds(docs: DataFrame) -> DataFrame:
    """(doc, n_shared_seeds) for ``docs`` (doc, text): how many of a text's
    seeds another text, or another row of the same doc and text, has too.

    Seeds in more than ``1 / HOT_PARTS`` of all seed rows, fewer than
    ``HOT_PARTS`` of them, are broadcast; other seeds meet their rows by a
    shuffle in which no key holds more than that share."""
    rows = written(_seed_rows(docs), "seeds")
    total = rows.count()
    counts = written(rows.filter("h is not null").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated-seeds")
    hot = counts.filter(F.col("n") * HOT_PARTS > total).select("h", F.lit(1).alias("_hot"))
    marked = rows.join(F.broadcast(hot), "h", "left")
    settled = F.col("_hot").isNotNull() | F.col("h").isNull()
    # a rare seed is looked for under (0, h); what is settled meets nothing
    keyed = marked.select("doc", "_hot", F.col("h").isNull().alias("_row"), F.when(settled, F.lit(1)).otherwise(F.lit(0)).alias("_side"), F.when(settled, F.col("doc")).otherwise(F.col("h")).alias("_key"))
    rare = counts.filter(F.col("n") * HOT_PARTS <= total).select(F.lit(0).alias("_side"), F.col("h").alias("_key"), F.lit(1).alias("_rare"))
    met = keyed.join(rare, ["_side", "_key"], "left")
    shared = F.count(F.coalesce("_hot", "_rare"))
    return met.groupBy("doc").agg((shared / F.count(F.when(F.col("_row"), 1))).cast("bigint").alias("n_shared_seeds"))
