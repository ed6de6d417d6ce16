"""Benchmark decontamination: rare n-gram seeds, then local alignment.

Words are runs without ASCII white space, A-Z lower-cased, stripped of
ASCII punctuation at both ends.

*Seeds.*  A first pass counts, over all documents, how many hold each n-gram
and (n+1)-gram of a test item.  An n-gram is rare if at most
``RARE_DOCS + RARE_SHARE * documents`` of them hold it.  Seeds of an item are
its rare n-grams, its rare (n+1)-grams made of n-grams that are not, and from
every ``STRETCH`` n-grams in a row the rarest that occurs at all, with those
up to ``NEAR_RAREST`` times as frequent.  Rarity is a bound and not a rank:
beside an exact copy, the n-grams that an edited copy broke are rarer than
those it kept, so the rarest alone would lose it.

*Alignment.*  A second pass aligns a document and an item that share a seed:
Smith-Waterman over words (match +2, mismatch -1, gap -1) between the item
and the stretch of the document around the seeds' diagonals, as wide as an
alignment of the least score can drift.  The score is the best local
alignment over that of the item with itself, so inserted, dropped and
replaced words cost little.  A stretch that has too few of the item's
words for the least score, in any order, is not aligned.  A copy without
a seed is not found.

Items are taken in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_BYTES`` bytes; each block goes to all executors, its counts (at most
two for each of its words) come to the driver, and the documents are read
twice: no shuffle of texts, no limit on matches.  Items shorter than ``n``
words use their whole sequence as the one seed.  Null or empty texts match
nothing.  Equal items each get their own rows; repeated documents too.
Other columns are ignored.  The functions run a job for each block's counts;
the caller ships the package (:func:`~logsift.llm.common.ship`) first.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows, text_bytes, text_groups

N = 2
RARE_DOCS = 20
RARE_SHARE = 0.001
STRETCH = 8
NEAR_RAREST = 2
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 4 << 20

_EDGES = string.punctuation.encode()


def words(text: bytes) -> list[bytes]:
    return [x for w in text.lower().split() if (x := w.strip(_EDGES))]


class _Vocabulary:
    """Word numbers, from 1, of the items' words; other words are 0."""

    def __init__(self, items: list[list[bytes]]):
        self.known = {w: i for i, w in enumerate(sorted({w for t in items for w in t}), 1)}
        self.words = pa.array(list(self.known), pa.binary()).cast(pa.string())

    def joined(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts in one array, a 0 after each text, and
        where each text begins; distinct words are looked up once."""
        runs = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).cast(pa.string())))
        coded = runs.flatten().dictionary_encode()
        plain = pc.ascii_trim(coded.dictionary, string.punctuation)
        number = pc.add(pc.fill_null(pc.index_in(plain, self.words), -1), 1)
        table = pc.if_else(pc.equal(pc.binary_length(plain), 0), -1, number).to_numpy(zero_copy_only=False).astype(np.int64)
        found = table[coded.indices.to_numpy()] if len(table) else table
        ends = np.cumsum(pc.list_value_length(runs).to_numpy())
        kept = np.r_[0, np.cumsum(found >= 0)]
        first = np.r_[0, kept[ends[:-1]] + np.arange(1, len(ends))] if len(ends) else ends
        return np.insert(found[found >= 0], kept[ends], 0), first

    def numbers(self, texts: list[bytes]) -> list[np.ndarray]:
        """Word numbers of each text."""
        flat, first = self.joined(texts)
        return [x[:-1] for x in np.split(flat, first[1:])] if texts else []


class Seeds:
    """Grams of a block of items, and which of their places are seeds.

    Grams have numbers from 0.  Their places in the items are rows of
    ``item`` and ``at``, those of gram g from ``first[g]`` to
    ``first[g + 1]``."""

    def __init__(self, items: list[tuple[int, bytes]], n: int = N):
        self.n, self.ids = n, [i for i, _ in items]
        texts = [words(t) for _, t in items]
        self.vocabulary = _Vocabulary(texts)
        self.texts = [np.array([self.vocabulary.known[w] for w in t], np.int64) for t in texts]
        self.counts = [np.unique(t, return_counts=True) for t in self.texts]
        self.base = len(self.vocabulary.known) + 1
        places: dict[int, list[tuple[int, int]]] = {}  # by size
        for k, t in enumerate(self.texts):
            for size in {min(len(t), n), min(len(t), n + 1)} - {0}:
                places.setdefault(size, []).extend((k, q) for q in range(len(t) - size + 1))
        #: codes of the grams of a size, sorted, and the number of the first
        self.codes: dict[int, tuple[np.ndarray, int]] = {}
        grams, item, at, self.size = [], [], [], 0
        for size, where in sorted(places.items()):
            codes = self._code(np.array([self.texts[k][q : q + size] for k, q in where]), size)
            distinct, gram = np.unique(codes, return_inverse=True)
            self.codes[size] = (distinct, self.size)
            grams.append(gram + self.size)
            item.append([k for k, _ in where])
            at.append([q for _, q in where])
            self.size += len(distinct)
        gram, item, at = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (grams, item, at))
        self._place(gram, item, at)

    def _place(self, gram: np.ndarray, item: np.ndarray, at: np.ndarray) -> None:
        order = np.lexsort((at, item, gram))
        self.gram, self.item, self.at = gram[order], item[order], at[order]
        self.first = np.searchsorted(self.gram, np.arange(self.size + 1))

    def _code(self, windows: np.ndarray, size: int) -> np.ndarray:
        if self.base**size < 1 << 62:
            return windows @ np.array([self.base**i for i in range(size)], np.int64)
        mix = windows.astype(np.uint64)
        out = np.zeros(len(windows), np.uint64)
        for i in range(size):
            out = (out ^ mix[:, i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.view(np.int64)

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(gram, place) of every gram in an array of word numbers."""
        grams, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, (codes, start) in self.codes.items():
            if len(text) < size:
                continue
            known = text > 0
            whole = known[: len(text) - size + 1].copy()
            for i in range(1, size):
                whole &= known[i : len(text) - size + 1 + i]
            where = np.flatnonzero(whole)
            if not len(where):
                continue
            code = self._code(np.lib.stride_tricks.sliding_window_view(text, size)[where], size)
            k = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hit = codes[k] == code
            grams.append(k[hit] + start)
            at.append(where[hit])
        return np.concatenate(grams), np.concatenate(at)

    def document_counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Grams, and how many of the texts hold each."""
        flat, first = self.vocabulary.joined(texts)
        gram, at = self.find(flat)
        text = np.searchsorted(first, at, side="right") - 1
        held = np.unique(text * self.size + gram) % self.size if len(gram) else gram
        return np.unique(held, return_counts=True)

    def choose(self, counts: np.ndarray, docs: int) -> None:
        """Keep the places of seeds, by how many of the documents hold each gram."""
        bound = RARE_DOCS + RARE_SHARE * docs
        of = np.where(counts > 0, counts, np.iinfo(np.int64).max)[self.gram]  # what occurs nowhere finds nothing
        lengths = np.array([len(t) for t in self.texts], np.int64)[self.item]
        sizes = np.zeros(self.size, np.int64)
        for size, (codes, start) in self.codes.items():
            sizes[start : start + len(codes)] = size
        short = sizes[self.gram] == np.minimum(lengths, self.n)
        # the rarest of every stretch of shorter grams
        key = self.item * (int(lengths.max(initial=0)) + 1)
        _, stretch = np.unique(key + self.at // STRETCH, return_inverse=True)
        least = np.full(int(stretch.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, stretch[short], of[short])
        near = np.minimum(least, np.iinfo(np.int64).max // NEAR_RAREST) * NEAR_RAREST
        seed = short & (counts[self.gram] > 0) & (of <= np.maximum(bound, near[stretch]))
        # longer ones where neither of their shorter grams is a seed
        taken = (key + self.at)[seed]
        covered = np.isin(key + self.at, taken) | np.isin(key + self.at + 1, taken)
        seed |= ~short & ~covered & (of <= bound)
        self._place(self.gram[seed], self.item[seed], self.at[seed])

    def common(self, k: int, stretch: np.ndarray) -> int:
        """Words of an item that a stretch has too, each as often as in both."""
        known, times = self.counts[k]
        found, n = np.unique(stretch, return_counts=True)
        at = np.minimum(np.searchsorted(found, known), len(found) - 1)
        return int(np.minimum(times, n[at])[found[at] == known].sum())


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score over words, and where it ends in the text.

    Row by row; a gap along the row is a running maximum of the cell values
    less what the gap has cost."""
    width = len(text)
    ramp = np.arange(width + 1) * -GAP
    row = np.zeros(width + 1, np.int64)
    best, end = 0, 0
    for w in item:
        step = np.zeros(width + 1, np.int64)
        step[1:] = np.maximum(row[:-1] + np.where((text == w) & (w > 0), MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + ramp) - ramp
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _blocks(items: DataFrame, limit: int, size: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of bounded count and bytes."""
    block, total = [], 0
    for i, text in items.toLocalIterator():
        raw = (text or "").encode()
        if block and (len(block) >= limit or total + len(raw) > size):
            yield block
            block, total = [], 0
        block.append((i, raw))
        total += len(raw)
    if block:
        yield block


RESULT = "doc_id bigint, item_id bigint, score double, start bigint, stop bigint, n_seeds bigint"


def align(s: Seeds, texts: list[bytes], min_score: float) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(text, item number, score, first and last-plus-one word of the aligned
    stretch searched, seeds) for each text and item that reach the score."""
    flat, first = s.vocabulary.joined(texts)
    stops = np.r_[first[1:], len(flat)] - 1
    gram, at = s.find(flat)
    times = s.first[gram + 1] - s.first[gram]
    place = np.repeat(s.first[gram] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
    at = np.repeat(at, times)
    owner = np.searchsorted(first, at, side="right") - 1
    item, start = s.item[place], at - first[owner] - s.at[place]
    order = np.lexsort((start, item, owner))
    owner, item, start = owner[order], item[order], start[order]
    new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (item[1:] != item[:-1])]) if len(owner) else owner
    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(owner)], strict=False):
        i, k, starts = int(owner[a]), int(item[a]), start[a:b]
        score, low, high = _best(s, k, flat[first[i] : stops[i]], starts, min_score)
        if score >= min_score:
            yield i, k, score, low, high, len(starts)


def _best(s: Seeds, k: int, text: np.ndarray, starts: np.ndarray, min_score: float) -> tuple[float, int, int]:
    """Best score of an item around sorted diagonals of a text, and where."""
    item = s.texts[k]
    m, best = len(item), (0.0, 0, 0)
    least = min_score * m  # matching words that the score takes
    slack = max(math.ceil(2 * (m - least)), 0) + 1  # gaps that it allows
    cut = np.flatnonzero(np.diff(starts) > m + 2 * slack)
    for low, high in zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, -1]].tolist(), strict=True):
        a, b = max(0, low - slack), min(len(text), high + m + slack)
        if s.common(k, text[a:b]) < least:
            continue
        for c in range(a, b, 8192):  # long runs in overlapping pieces
            score, end = smith_waterman(item, text[c : min(b, c + 8192 + m + slack)])
            if score / (MATCH * m) > best[0]:
                best = (score / (MATCH * m), max(a, c + end - m - slack), c + end)
    return best


def seeds_of(docs: DataFrame, block: list[tuple[int, bytes]], n: int = N) -> Seeds:
    """The seeds of a block of items, chosen by one count over all documents."""
    seeds = Seeds(block, n)
    sent = docs.sparkSession.sparkContext.broadcast(seeds)
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches):
            gram, n = sent.value.document_counts(text_bytes(part))
            yield rows(schema, np.r_[gram, -1], np.r_[n, part.num_rows])  # -1: all documents

    counted = docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram, n = (counted.column(c).to_numpy() for c in ("gram", "n"))
    counts = np.zeros(seeds.size, np.int64)
    counts[gram[gram >= 0]] = n[gram >= 0]
    seeds.choose(counts, int(n[gram < 0].sum()))
    sent.destroy()
    return seeds


def find_leaks(docs: DataFrame, items: DataFrame, *, n: int = N, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows (doc_id, item_id, score, start, stop, n_seeds) of documents
    (doc_id, text) that hold an exact or edited copy of a test item."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("stop", pa.int64()), ("n_seeds", pa.int64())])
    out = None
    for block in _blocks(items.select(F.col("item_id"), F.col("text")), BLOCK_ITEMS, BLOCK_BYTES):
        seeds = spark.sparkContext.broadcast(seeds_of(docs, block, n))

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            s = seeds.value
            for part in text_groups(batches):
                ids = part.column(0).to_pylist()
                found = [(ids[i], s.ids[k], *rest) for i, k, *rest in align(s, text_bytes(part), min_score)]
                yield rows(schema, *(zip(*found, strict=True) if found else [[]] * len(schema)))

        leaks = docs.mapInArrow(run, RESULT)
        out = leaks if out is None else out.unionByName(leaks)
    return spark.createDataFrame([], RESULT) if out is None else out


def remove_leaks(docs: DataFrame, items: DataFrame, *, n: int = N, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose own text holds no copy of a test item, in
    two narrow passes per block of items: no join on doc_id, so rows that share
    one, or have none, are judged each by its text.  Seeds of every block are
    chosen by counts over all of ``docs``."""
    spark, schema, left = docs.sparkSession, docs.schema, docs
    for block in _blocks(items.select(F.col("item_id"), F.col("text")), BLOCK_ITEMS, BLOCK_BYTES):
        seeds = spark.sparkContext.broadcast(seeds_of(docs, block, n))

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            s = seeds.value
            for part in text_groups(batches):
                clean = np.ones(part.num_rows, bool)
                clean[[i for i, *_ in align(s, text_bytes(part), min_score)]] = False
                yield part.filter(pa.array(clean))

        left = left.mapInArrow(run, schema)
    return left
