"""Language-model scoring with a hierarchical Pitman-Yor model.

Tokens are words (A-Z lower-cased, no ASCII white space) and one end per
document.  With ``words`` a word's context is the whole word before it;
that one's parent is the end of that word: its last two bytes, whose parent
is its last byte, whose parent is the empty context, which backs off to a
uniform base over the known tokens and one unknown.  Without ``words`` the
last two bytes are the topmost context.  Each context is a restaurant; its
customers are the tokens seen after it and, for a parent, the tables of its
children.  Restaurants of words grow with the corpus; those of ends number
at most 65,536 + 256 + 1.

Everything about a word sits in one slice of the model (words are dealt by
hash), so the seating of all its dishes is sampled in one task.  Slices
meet only in the restaurants' totals, which are summed after each sweep and
handed to the next: those of ends (at most 65,793 rows) by the driver, those
of words by Spark, in buckets by name, from which each slice gets back the
totals of the names it holds.  A sweep is a blocked Gibbs step per dish.
The factor (strength | d)_T of a restaurant with T tables is the integral of
(d * x)**T over x ~ Gamma(strength / d + T); given that x, drawn once per
restaurant and sweep, the dishes' tables are independent, and t tables of c
customers have a probability proportional to S_d(c, t) * a**t, with
generalized Stirling numbers and a = d * x * parent probability.  For
dishes with more than ``EXACT`` customers the same conditional is computed
without the numbers' table: it is that of a Poisson(a / d) count of
Sibuya(d) table sizes, given that they add up to c (``draw_large``).  Parents are
then re-seated given their children's tables.  Discounts come from the
counts of counts of each level.

The predictive probabilities of the samples are averaged per token; the
score is the sum of their log10.  For scoring, documents send their tokens
(word digest, context, document number) to the words' slices in packed
blobs; a slice holding frequent words is copied to several tasks, each
with a part of the blobs.  Partial sums return by document batch.  The
number of slices grows with the bytes of text and that of a slice's copies
with its tokens, so a task's share of either stays of one size.

The parent's probability is that of the sweep's start, the dish's own tables
there included, and the parent's own factor is left out, so the sweeps are an
approximation of Gibbs sampling where one dish makes up much of its parent's.
The strength is fixed and discounts are not sampled.  Batches are numbered by
their place in a task: give rows whose order is fixed, as of a scan or a
written table, or a task that is run again may number others.

Words are held by 64-bit digests.  Null or empty text is one end token.  A
null doc_id counts as the text "".  Each row is scored by itself, repeated
rows included; other columns are ignored.  With no training documents the
only probability left is 1, the score 0.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shuffles_deleted, small_batches, text_bytes, text_column, text_groups, written

HELD_MOD, HELD_REST = 7, 2
STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 2
EXACT = 64
#: Mean tables up to which their distribution is computed in full.
FEW = 100.0
MIN_SLICES = 24
#: Bytes of text per slice of the model.  A text's partial sums come from as
#: many slices as its words fall in, so smaller slices mean more of them.
SLICE_BYTES = 128 << 20
#: The same with the level of words, whose dishes are far more.
MIN_WORD_SLICES, WORD_SLICE_BYTES = 12, 16 << 20
#: Training tokens of a slice per copy of it in a round of scoring.
COPY_TOKENS = 2_000_000
GROUP = 6 << 20
#: Bytes of a state in a row.  A slice's whole state in one would be copied
#: several times, on the heap and off it, by each step that Spark takes.
PIECE = 1 << 20
#: Rounds of scoring: a part of the documents each, of so many bytes at least.
MAX_ROUNDS, ROUND_BYTES = 3, 48 << 20
START = 0xFFFF  # context of a first token; no UTF-8 byte is 0xFF
END = xxhash.xxh3_64_intdigest(b"")
# codes of the totals: level 2 contexts, level 1 contexts, level 0, then scalars
L1, L0, STATS = 1 << 16, (1 << 16) + 256, (1 << 16) + 257


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_MOD == HELD_REST


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    kinds = "".join(a.dtype.str for a in arrays).encode().ljust(8 * len(arrays))
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, kinds, *(x for a in arrays if a.size for x in (np.ascontiguousarray(a).data, bytes(-a.nbytes % 8)))]))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8).tolist()
    at = 8 * (n + 1)
    kinds = [raw[at + 3 * i : at + 3 * i + 3].decode() for i in range(n)]
    at += 8 * n
    out = []
    for kind, size in zip(map(np.dtype, kinds), sizes, strict=True):
        out.append(np.frombuffer(raw, kind, size // kind.itemsize, at) if size else np.zeros(0, kind))
        at += size + -size % 8  # aligned
    return out


@dataclass
class Tokens:
    """Tokens of a group of texts: number of the word, of the preceding word
    (END before a first token) and of the text of each; and the words' digests
    and ends by number."""

    number: np.ndarray
    before: np.ndarray
    text: np.ndarray
    digest: np.ndarray
    tail: np.ndarray

    @property
    def word(self) -> np.ndarray:
        return self.digest[self.number]

    @property
    def context(self) -> np.ndarray:
        return self.tail[self.before]

    @classmethod
    def of(cls, texts: list[bytes]) -> Tokens:
        runs = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.binary()).cast(pa.string()))
        flat = runs.flatten()
        owner = np.repeat(np.arange(len(texts), dtype=np.int64), pc.list_value_length(runs).to_numpy())
        keep = pc.binary_length(flat).to_numpy() > 0
        coded = flat.filter(pa.array(keep)).dictionary_encode()
        names = coded.dictionary.cast(pa.binary())
        digest = np.fromiter(map(xxhash.xxh3_64_intdigest, chain(names.to_numpy(zero_copy_only=False), [b""])), np.uint64, len(names) + 1)
        tail = np.r_[_tails(names), np.uint16(START)]
        index, owner = coded.indices.to_numpy().astype(np.int64), owner[keep]
        # a place for each text's end, after its words
        counts = np.bincount(owner, minlength=len(texts))
        stops = np.cumsum(counts + 1) - 1
        total = int(len(index) + len(texts))
        is_end = np.zeros(total, bool)
        is_end[stops] = True
        number = np.full(total, len(digest) - 1, np.int64)
        number[~is_end] = index
        before = np.r_[len(digest) - 1, number[:-1]]  # an end's tail is START, which the next text's first token sees
        return cls(number, before, np.repeat(np.arange(len(texts)), counts + 1), digest, tail)

    def ranked(self, slices: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words by slice, and the place of each in that order."""
        by_slice = np.argsort(_dealt(self.digest, slices), kind="stable")
        rank = np.empty(len(by_slice), np.int64)
        rank[by_slice] = np.arange(len(by_slice))
        return by_slice, rank

    def sorted_tokens(self, texts: int, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the word, text (below ``texts``) and number of the
        preceding word of each token, ordered by slice and these three."""
        size = len(self.digest)
        by_slice, rank = self.ranked(slices)
        key, before = np.divmod(np.sort((rank[self.number] * texts + self.text) * size + self.before), size)
        own, text = np.divmod(key, texts)
        return by_slice[own], text, before

    def counted_pairs(self, learnt: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the word and of the preceding word of each pair, ordered
        by slice and these, and its tokens in the texts ``learnt`` from."""
        size = len(self.digest)
        by_slice, rank = self.ranked(slices)
        key = np.sort((rank[self.number] * size + self.before) * 2 + learnt[self.text])
        pair = key >> 1
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        own, before = np.divmod(pair[first], size)
        return by_slice[own], before, np.add.reduceat(key & 1, first)

    def named(self, before: np.ndarray) -> list[np.ndarray]:
        """The words numbered ``before`` once each, their ends, and an index."""
        seen, index = np.unique(before, return_inverse=True)
        return [self.digest[seen], self.tail[seen], index.astype(np.uint16 if len(index) < 1 << 16 else np.uint32)]


def _tails(words: pa.Array) -> np.ndarray:
    """The last two bytes of each word (binary, not empty), 0 before a single one."""
    if not len(words):
        return np.zeros(0, np.uint16)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8).astype(np.uint16)
    last = ends[1:] - 1
    return np.where(np.diff(ends) > 1, data[last - 1] << 8, 0).astype(np.uint16) | data[last]


def _dealt(word: np.ndarray, slices: int) -> np.ndarray:
    return ((word >> np.uint64(20)) % np.uint64(slices)).astype(np.int64)


def _by_slice(key: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(key[a]), a, b


def training_counts(docs: DataFrame, slices: int, words: bool = False) -> DataFrame:
    """(part, body): per group of texts and slice the counts of dishes, by
    (word, context), or with ``words`` by (word, preceding word).  The latter
    has a dish of no customers for each pair that only held-out texts hold,
    so a slice comes to know the totals of all restaurants it will score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches, GROUP):
            ids = part.column(0).to_pylist()
            learnt = np.array([not held_out(i) for i in ids], bool)
            texts = [t for t, own in zip(text_bytes(part), learnt.tolist(), strict=True) if own or words]
            if not texts:
                continue
            tokens = Tokens.of(texts)
            found = []
            if words:
                number, before, count = tokens.counted_pairs(learnt, slices)
                word = tokens.digest[number]
                for s, a, b in _by_slice(_dealt(word, slices)):
                    found.append((s, _pack(word[a:b], count[a:b].astype(np.uint32), *tokens.named(before[a:b]))))
            else:
                word, context = tokens.word, tokens.context
                order = np.lexsort((context, word))
                word, context = word[order], context[order]
                first = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])])
                count = np.diff(np.r_[first, len(word)]).astype(np.uint32)
                word, context = word[first], context[first]
                order = np.argsort(_dealt(word, slices), kind="stable")
                word, context, count = word[order], context[order], count[order]
                for s, a, b in _by_slice(_dealt(word, slices)):
                    found.append((s, _pack(word[a:b], count[a:b], context[a:b])))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())], names=["part", "body"])

    return docs.mapInArrow(run, "part int, body binary")


def _steps(up: np.ndarray) -> np.ndarray:
    """Where an index that starts at 0 and never falls or skips goes up."""
    return np.diff(up, prepend=up[:1]).astype(np.uint8)


def _stepped(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint32)


@dataclass
class Words:
    """Level 3 of a slice: dishes whose restaurant is the preceding word,
    and these restaurants' totals over all slices."""

    name: np.ndarray  # distinct preceding words, by bucket and digest
    at: np.ndarray  # dish to name
    up: np.ndarray  # dish to level 2 dish
    c: np.ndarray
    t: np.ndarray
    # of each name; empty until the slices have met, and not kept but for the last customers
    customers: np.ndarray
    tables: np.ndarray
    weight: np.ndarray  # Gamma(strength / discount + tables)

    def fields(self, met: bool) -> list[np.ndarray]:
        return [self.name, _steps(self.up), *(x.astype(np.uint32, copy=False) for x in (self.at, self.c, self.t, self.customers if met else self.customers[:0]))]

    @classmethod
    def of_fields(cls, name: np.ndarray, up: np.ndarray, at: np.ndarray, c: np.ndarray, t: np.ndarray, customers: np.ndarray) -> Words:
        return cls(name, at, _stepped(up), c, t, customers, np.zeros(0, np.uint32), np.zeros(0, np.float32))

    def partial(self) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of each name in this slice."""
        sums = (np.bincount(self.at, weights=x, minlength=len(self.name)) for x in (self.c, self.t))
        return tuple(x.astype(np.uint32) for x in sums)


@dataclass
class Slice:
    """Dishes of a slice's words, ordered by word and context: customers
    and tables of each level, with the index of each dish's parent."""

    word: np.ndarray  # distinct words
    context: np.ndarray  # level 2
    up: np.ndarray  # level 2 dish to level 1 dish
    context1: np.ndarray
    up1: np.ndarray  # level 1 dish to word
    c2: np.ndarray
    t2: np.ndarray
    c1: np.ndarray
    t1: np.ndarray
    c0: np.ndarray
    t0: np.ndarray
    words: Words | None = None

    @classmethod
    def of(cls, word: np.ndarray, context: np.ndarray, count: np.ndarray) -> Slice:
        """From distinct (word, context); every dish starts with one table."""
        order = np.lexsort((context, context & 0xFF, word))
        return cls.of_sorted(word[order], context[order], count[order])

    @classmethod
    def of_sorted(cls, word: np.ndarray, context: np.ndarray, count: np.ndarray) -> Slice:
        """The same, ordered by word, last byte and context."""
        low = (context & 0xFF).astype(np.int64)
        new1 = np.r_[True, (word[1:] != word[:-1]) | (low[1:] != low[:-1])][: len(word)]
        up = np.cumsum(new1) - 1
        word1, context1 = word[new1], low[new1]
        new0 = np.r_[True, word1[1:] != word1[:-1]][: len(word1)]
        up1 = np.cumsum(new0) - 1
        c1 = np.bincount(up, minlength=len(word1))
        c0 = np.bincount(up1, minlength=int(new0.sum()))
        one = np.ones
        return cls(word1[new0], context, up, context1, up1, count.astype(np.int64), one(len(count), np.int64), c1, one(len(c1), np.int64), c0, one(len(c0), np.int64))

    @classmethod
    def of_words(cls, bodies: list[list[np.ndarray]], slices: int) -> Slice:
        """From the ``training_counts`` of all groups, which are let go; a dish
        with customers starts with one table."""
        # a body has a word's pairs side by side and each name once
        first = [np.flatnonzero(np.r_[True, b[0][1:] != b[0][:-1]]) for b in bodies]
        runs = [np.diff(np.r_[f, len(b[0])]) for f, b in zip(first, bodies, strict=True)]
        words, own = np.unique(np.concatenate([b[0][f] for f, b in zip(first, bodies, strict=True)]), return_inverse=True)
        key = np.repeat(own, np.concatenate(runs))
        names, own = np.unique(np.concatenate([b[2] for b in bodies]), return_inverse=True)
        tails = np.zeros(len(names), np.uint16)
        tails[own] = np.concatenate([b[3] for b in bodies])
        place = np.empty(len(names), np.uint32)
        place[np.argsort(_dealt(names, slices), kind="stable")] = np.arange(len(names))
        # names by last byte, end and place: one number orders the dishes of a word
        by_end = np.lexsort((place, tails, tails & 0xFF))
        rank = np.empty(len(names), np.int64)
        rank[by_end] = np.arange(len(names))
        ends = np.cumsum([len(b[2]) for b in bodies])
        key *= len(names)
        key += np.concatenate([rank[own[e - len(b[2]) : e]][b[4]] for e, b in zip(ends.tolist(), bodies, strict=True)])
        count = np.concatenate([b[1] for b in bodies])
        bodies.clear()
        del own, first, runs, rank
        order = np.argsort(key)
        key, count = key[order], count[order]
        del order
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        count = np.add.reduceat(count, first, dtype=np.int64)
        word, name = np.divmod(key[first], len(names))
        del key, first
        name = by_end[name]
        context, at = tails[name], place[name]
        new = np.r_[True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])]
        up, seats = (np.cumsum(new) - 1).astype(np.uint32), np.minimum(count, 1)
        out = cls.of_sorted(words[word[new]], context[new], np.bincount(up, weights=seats).astype(np.int64))
        order = np.empty_like(names)
        order[place] = names
        none = np.zeros(0, np.uint32)
        out.words = Words(order, at, up, count, seats, none, none, none.astype(np.float32))
        out.t2 = np.minimum(out.c2, 1)
        out.c1 = np.bincount(out.up, weights=out.t2, minlength=len(out.c1)).astype(np.int64)
        out.t1 = np.minimum(out.c1, 1)
        out.c0 = np.bincount(out.up1, weights=out.t1, minlength=len(out.c0)).astype(np.int64)
        out.t0 = np.minimum(out.c0, 1)
        return out

    def pack(self, samples: list[np.ndarray], met: bool = True) -> bytes:
        """``met``: the slices won't meet again, the names' customers stay."""
        above = self.words.fields(met) if self.words else []
        own = [self.context, _steps(self.up), self.context1.astype(np.uint8), _steps(self.up1), *(x.astype(np.uint32) for x in (self.c2, self.t2, self.c1, self.t1, self.c0, self.t0))]
        return _pack(np.array([len(above)], np.uint8), self.word, *own, *above, *(x.astype(np.uint32) for x in samples))

    @classmethod
    def unpack(cls, data: bytes) -> tuple[Slice, list[np.ndarray]]:
        head, *a = _unpack(data)
        n = 11 + int(head[0])
        above = Words.of_fields(*a[11:n]) if n > 11 else None
        up, up1 = _stepped(a[2]).astype(np.int64), _stepped(a[4]).astype(np.int64)
        return cls(a[0], a[1].astype(np.int64), up, a[3].astype(np.int64), up1, *(x.astype(np.int64) for x in a[5:11]), above), a[n:]

    def tables(self) -> list[np.ndarray]:
        """A sample: five arrays, or eight with the level of words, of which
        the last is what is known of the names' tables so far."""
        below = [self.t2, self.c1, self.t1, self.c0, self.t0]
        return [*below, self.c2, self.words.t, self.words.tables] if self.words else below

    def totals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes with customers and tables of the slice's restaurants, and
        per level the dishes of one and of two customers."""
        c, t = np.zeros(STATS + 8, np.int64), np.zeros(STATS + 8, np.int64)
        np.add.at(c, self.context, self.c2)
        np.add.at(t, self.context, self.t2)
        np.add.at(c, L1 + self.context1, self.c1)
        np.add.at(t, L1 + self.context1, self.t1)
        c[L0], t[L0] = self.c0.sum(), self.t0.sum()
        for k, x in enumerate((self.c2, self.c1, self.c0)):
            c[STATS + k], t[STATS + k] = (x == 1).sum(), (x == 2).sum()
        c[STATS + 3], t[STATS + 3] = (self.c0 > 0).sum(), (self.words.c if self.words else self.c2).sum()
        if self.words:
            c[STATS + 4], t[STATS + 4] = (self.words.c == 1).sum(), (self.words.c == 2).sum()
        codes = np.flatnonzero(c + t)
        return codes, c[codes], t[codes]


@dataclass
class Totals:
    """Sums over all slices; ``discount`` per level 0, 1, 2, 3."""

    c: np.ndarray
    t: np.ndarray
    discount: tuple[float, ...]
    x: np.ndarray  # per restaurant Gamma(strength / discount + tables)

    @classmethod
    def of(cls, table: DataFrame, seed: list[int], discount: tuple[float, ...] | None = None) -> Totals:
        rows = table.select(F.explode(F.arrays_zip("code", "c", "t")).alias("x")).groupBy("x.code").agg(F.sum("x.c").alias("c"), F.sum("x.t").alias("t")).collect()
        c, t = np.zeros(STATS + 8, np.int64), np.zeros(STATS + 8, np.int64)
        for code, n, m in rows:
            c[code], t[code] = n, m
        if discount is None:
            one, two = (x[[STATS, STATS + 1, STATS + 2, STATS + 4]] for x in (c, t))
            rate = [min(max(float(a / (a + 2 * b)) if a else 0.5, 0.05), 0.95) for a, b in zip(one, two, strict=True)]
            discount = (rate[2], rate[1], rate[0], rate[3])
        level = np.repeat([2, 1, 0], [L1, L0 - L1, len(c) - L0])
        return cls(c, t, discount, np.random.default_rng(seed).gamma(STRENGTH / np.array(discount)[level] + t))

    @property
    def types(self) -> int:
        return int(self.c[STATS + 3])

    @property
    def tokens(self) -> int:
        return int(self.t[STATS + 3])

    def share(self, codes: np.ndarray | int, c, t, parent, level: int):
        """Predictive probability in a restaurant, given its parent's."""
        d = self.discount[level]
        total = STRENGTH + self.c[codes]
        return (np.maximum(c - d * t, 0.0) + (STRENGTH + d * self.t[codes]) * parent) / total

    def weight(self, codes: np.ndarray | int, parent, level: int):
        return self.discount[level] * self.x[codes] * parent

    def share_words(self, customers, tables, c, t, parent):
        """``share`` in restaurants of level 3."""
        d = self.discount[3]
        return (np.maximum(c - d * t, 0.0) + (STRENGTH + d * tables) * parent) / (STRENGTH + customers)


def log_stirling(d: float, size: int = EXACT) -> np.ndarray:
    """log S_d(c, t) for c, t up to ``size``."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(size):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            stay = out[c, t] + np.log(np.maximum(c - d * t, 1e-300))
        out[c + 1, t] = np.logaddexp(out[c, t - 1], np.where(t <= c, stay, -np.inf))
    return out


def draw_tables(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator, stirling: np.ndarray) -> np.ndarray:
    """Tables of dishes with ``c`` customers and new-table weight ``a``."""
    t = np.minimum(c, 1)
    first = np.minimum(c, EXACT)
    order = np.flatnonzero(first > 1)
    order = order[np.argsort(first[order].astype(np.uint8), kind="stable")]
    cuts = np.searchsorted(first[order], np.arange(2, EXACT + 2))
    for n in range(2, EXACT + 1):
        rows = order[cuts[n - 2] : cuts[n - 1]]
        for block in np.array_split(rows, max(1, len(rows) * n // 1_000_000)):
            if not len(block):
                continue
            tables = np.arange(1, n + 1)
            w = stirling[n, 1 : n + 1] + tables * np.log(a[block])[:, None]
            w = np.exp(w - w.max(axis=1, keepdims=True)).cumsum(axis=1)
            t[block] = 1 + (w < rng.random(len(block))[:, None] * w[:, -1:]).sum(axis=1)
    late = np.flatnonzero(c > EXACT)
    t[late] = draw_large(c[late], a[late], d, rng)
    return t


def draw_large(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """As ``draw_tables`` for many customers: t with probability
    proportional to Poisson(t; a / d) * P(t Sibuya(d) sizes add up to c).

    That sum's probability is an integral along the branch cut of
    (1 - (1 - x)**d)**t.  Where tables are many, t is normal, with the
    moments at the saddle point of exp(a / d * (1 - (1 - x)**d)) / x**c."""
    rate = a / d
    low, high = np.full(len(c), -800.0), np.full(len(c), -1e-12)  # log(1 - x)
    for _ in range(60):
        mid = (low + high) / 2
        over = np.log(a) + np.log(-np.expm1(mid)) + (d - 1) * mid > np.log(c)
        low, high = np.where(over, mid, low), np.where(over, high, mid)
    y = np.exp(high)
    mean = rate * -np.expm1(d * high)
    square = c + a * (1 - y) ** 2 * (1 - d) * np.exp((d - 2) * high)
    spread = np.sqrt(np.maximum(mean - c * (c / square), 0.0))
    t = np.clip(np.rint(rng.normal(mean, spread)), 1, c).astype(np.int64)
    few = np.flatnonzero((mean < FEW) & (mean <= 6 * c**d))
    few = few[np.argsort(mean[few], kind="stable")]
    v = np.exp(np.arange(math.log(1e-5), math.log(80), 0.05))
    for at in range(0, len(few), 256):
        rows = few[at : at + 256]
        u = np.expm1(v / c[rows, None])  # (1 + u)**-c = exp(-v)
        base = np.log(1 - u**d * np.exp(-1j * np.pi * d))
        weight = np.exp(-v) * v  # steps of v are even in log v
        top = mean[rows].max()
        tables = np.arange(max(1, int(mean[rows].min() - 9 * math.sqrt(mean[rows].min()) - 2)), int(top + 9 * math.sqrt(top) + 12))
        turn, p = np.exp(base), np.empty((len(rows), len(tables)))
        power = np.exp(base * tables[0])
        for k in range(len(tables)):
            p[:, k] = power.imag @ weight
            power *= turn
        logs = tables * np.log(rate[rows])[:, None] - _log_factorial(tables)
        p = np.where(tables <= c[rows, None], np.maximum(p, 0.0), 0.0) * np.exp(logs - logs.max(axis=1, keepdims=True))
        p = p.cumsum(axis=1)
        t[rows] = tables[0] + (p < rng.random(len(rows))[:, None] * p[:, -1:]).sum(axis=1)
    return t


def _log_factorial(n: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(x + 1) for x in n.tolist()])


def sweep(s: Slice, totals: Totals, rng: np.random.Generator, stirling: list[np.ndarray], base: float) -> None:
    """Re-seat the dishes of all levels, children first."""
    d0, d1, d2, d3 = totals.discount
    p0 = totals.share(L0, s.c0, s.t0, base, 0)
    p1 = totals.share(L1 + s.context1, s.c1, s.t1, p0[s.up1], 1)
    if s.words:
        w = s.words
        p2 = totals.share(s.context, s.c2, s.t2, p1[s.up], 2)
        w.t = draw_tables(w.c, d3 * w.weight[w.at] * p2[w.up], d3, rng, stirling[3])
        s.c2 = np.bincount(w.up, weights=w.t, minlength=len(s.c2)).astype(np.int64)
    s.t2 = draw_tables(s.c2, totals.weight(s.context, p1[s.up], 2), d2, rng, stirling[2])
    s.c1 = np.bincount(s.up, weights=s.t2, minlength=len(s.c1)).astype(np.int64)
    s.t1 = draw_tables(s.c1, totals.weight(L1 + s.context1, p0[s.up1], 1), d1, rng, stirling[1])
    s.c0 = np.bincount(s.up1, weights=s.t1, minlength=len(s.c0)).astype(np.int64)
    s.t0 = draw_tables(s.c0, np.broadcast_to(totals.weight(L0, base, 0), s.c0.shape), d0, rng, stirling[0])


STATE = "part int, bucket int, body binary, state binary, code array<int>, c array<bigint>, t array<bigint>, kind int"
STATE_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32()]
STATE_NAMES = ["part", "bucket", "body", "state", "code", "c", "t", "kind"]


def _state_rows(part: int, s: Slice, samples: list[np.ndarray], slices: int, piece: int, meet: bool = True) -> Iterator[pa.RecordBatch]:
    """The state (kind 0) in pieces, numbered up to -1 in the place of the
    bucket, and if the slices meet again the names' customers and tables
    (kind 1) in a row for each bucket of names."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), STATE_TYPES, strict=True)], names=STATE_NAMES)

    totals, body = s.totals(), s.pack(samples, not meet)
    n = -(-len(body) // piece)
    for k in range(n):
        yield batch([(part, k - n, None, body[k * piece : (k + 1) * piece], *(totals if k == 0 else [None] * 3), 0)])
    if s.words and meet and len(s.words.name):
        c, t = s.words.partial()
        yield batch([(part, k, _pack(s.words.name[a:b], c[a:b], t[a:b]), None, None, None, None, 1) for k, a, b in _by_slice(_dealt(s.words.name, slices))])


def _states(df: DataFrame) -> DataFrame:
    with shuffles_deleted(df.sparkSession):
        return written(df, "py-state", partition_by="kind")


def _first_state(counts: DataFrame, slices: int, words: bool = False) -> DataFrame:
    piece = PIECE

    def build(part: int, bodies: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if words:
            return _state_rows(part, Slice.of_words(bodies, slices), [], slices, piece)
        word, count, context = (np.concatenate([b[k] for b in bodies]) for k in range(3))
        bodies.clear()
        order = np.lexsort((context, word))
        word, context, count = word[order], context[order], count[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])])
        return _state_rows(part, Slice.of(word[first], context[first], np.add.reduceat(count, first)), [], slices, piece)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bodies = None, []
        for batch in batches:
            for p, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if p != part and bodies:
                    yield from build(part, bodies)
                    bodies = []
                part = p
                bodies.append(_unpack(body))
        if bodies:
            yield from build(part, bodies)

    return counts.repartition(slices * 2, "part").sortWithinPartitions("part").mapInArrow(run, STATE)


def _met(state: DataFrame, discount: float, number: int, slices: int, seed: int) -> DataFrame:
    """(part, bucket, body): the totals of each state's names and their
    weights, bucket by bucket, written; the states' own are deleted."""

    def answer(bucket: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        parts = [(p, *_unpack(body)) for p, body in sorted(rows)]
        names, at = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
        c, t = (np.bincount(at, weights=np.concatenate([p[k] for p in parts])) for k in (2, 3))
        weight = np.random.default_rng([seed, number, 1, bucket]).gamma(STRENGTH / discount + t).astype(np.float32)
        c, t = c.astype(np.uint32), t.astype(np.uint32)
        ends = np.cumsum([len(p[1]) for p in parts])
        own = [at[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]
        bodies = [_pack(c[i], t[i], weight[i]) for i in own]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([bucket] * len(parts), pa.int32()), pa.array(bodies, pa.binary())], names=["part", "bucket", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows = None, []
        for batch in batches:
            for part, bucket, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != place and rows:
                    yield answer(place, rows)
                    rows = []
                place = bucket
                rows.append((part, body))
        if rows:
            yield answer(place, rows)

    asked = state.filter("kind = 1").select("part", "bucket", "body").repartition(slices * 2, "bucket").sortWithinPartitions("bucket")
    with shuffles_deleted(state.sparkSession):
        totals = written(asked.mapInArrow(run, "part int, bucket int, body binary"), "py-met")
    discard(state, within="kind=1")
    return totals


def _swept(state: DataFrame, totals, number: int, rounds: int, seed: int, keep: bool, slices: int) -> DataFrame:
    """States after ``rounds`` sweeps, the last one kept as a sample if asked.
    ``state``: (part, bucket, body), a state's pieces before the totals; a
    sample's tables of the names, known only once the slices have met, are
    entered first."""
    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Totals = totals.value
        stirling = [log_stirling(d) for d in known.discount]
        part, s, samples, met, pieces = None, None, [], [], []

        def finish() -> Iterator[pa.RecordBatch]:
            kept = samples
            if s.words:
                s.words.customers, s.words.tables, s.words.weight = (np.concatenate([m[k] for m in met]) for k in range(3))
                met.clear()
                kept = [*samples[:-1], s.words.tables] if samples and not len(samples[-1]) else samples
            rng = np.random.default_rng([seed, number, part])
            for _ in range(rounds):
                sweep(s, known, rng, stirling, 1.0 / (known.types + 1))
            if keep and s.words:
                s.words.tables = s.words.tables[:0]  # not known yet
            return _state_rows(part, s, kept + s.tables() if keep else kept, slices, piece, meet=rounds > 0)

        for batch in batches:
            for p, bucket, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket < 0:
                    if s is not None:
                        yield from finish()
                    part, s, met = p, None, []
                    pieces.append(body)
                    if bucket == -1:
                        s, samples = Slice.unpack(b"".join(pieces))
                        pieces.clear()
                else:
                    met.append(_unpack(body))
        if s is not None:
            yield from finish()

    return state.mapInArrow(run, STATE)


def train(docs: DataFrame, slices: int, seed: int = 0, words: bool = False) -> tuple[DataFrame, list[Totals]]:
    """Model slices (part, bucket, state, ...), large ones in several rows in
    the order of bucket, and the totals of each sample."""
    spark = docs.sparkSession
    state = _states(_first_state(training_counts(docs, slices, words), slices, words))
    totals = [Totals.of(state, [seed, 0])]
    # the slices meet after each sweep; without words after those that are kept
    plan = [1] * (BURN_IN + SAMPLES) if words else [1 + BURN_IN] + [1] * (SAMPLES - 1)
    for k, rounds in enumerate([*plan, 0] if words else plan):
        shared = spark.sparkContext.broadcast(totals[-1])  # at most 65,801 numbers a column
        rows = state.filter("kind = 0").select("part", "bucket", F.col("state").alias("body"))
        rows = rows.repartition(slices * 2, "part").sortWithinPartitions("part", "bucket") if not words else rows
        if words:
            met = _met(state, totals[0].discount[3], k, slices, seed)
            rows = rows.unionByName(met).repartition(slices * 2, "part").sortWithinPartitions("part", "bucket")
        keep = rounds > 0 and k >= len(plan) - SAMPLES
        swept = _states(_swept(rows, shared, k, rounds, seed, keep, slices))
        discard(state, *[met] if words else [])
        state = swept
        if rounds:
            totals.append(Totals.of(state, [seed, k + 1], totals[0].discount))
    return state.filter("kind = 0"), totals[-SAMPLES:]


def _turned(context: np.ndarray) -> np.ndarray:
    """The last byte first, as dishes are ordered."""
    return (context & 0xFF) << 8 | context >> 8


class Scorer:
    """Averaged predictive probabilities of one slice."""

    def __init__(self, data: bytes | None, totals: list[Totals], words: bool = False):
        self.totals, self.base = totals, 1.0 / (totals[0].types + 1)
        self.smooth = math.log10(totals[0].tokens + totals[0].types + 1)
        if data is None:
            empty = np.zeros(0, np.int64)
            none = Words(np.zeros(0, np.uint64), *[empty] * 7) if words else None
            s, samples = Slice(np.zeros(0, np.uint64), *[empty] * 10, none), [empty] * (8 * len(totals))
        else:
            s, samples = Slice.unpack(data)
        own = s.words
        dishes = (own.c, own.up) if own else (s.c2, np.arange(len(s.c2)))
        self.word, self.count = s.word, np.bincount(s.up1[s.up][dishes[1]], weights=dishes[0], minlength=len(s.word)) if len(s.word) else np.zeros(0)
        # dishes are in the order of these keys
        word2 = s.up1[s.up]
        self.key1, self.key2 = s.up1 * 256 + s.context1, word2 * 65536 + _turned(s.context)
        self.p0, self.p1, self.p2, self.p3 = [], [], [], 0
        if own:
            self.name_order = np.argsort(own.name, kind="stable")
            self.name, self.customers, self.tables = own.name[self.name_order], own.customers, []
            end = np.zeros(len(own.name), np.int64)
            end[own.at] = s.context[own.up]
            self.rank = np.empty(len(end), np.int64)
            self.rank[np.argsort(_turned(end), kind="stable")] = np.arange(len(end))
            self.key3 = word2[own.up] * len(own.name) + self.rank[own.at]
        width = 8 if own else 5
        for k, total in enumerate(totals):
            t2, c1, t1, c0, t0 = samples[width * k : width * k + 5]
            c2 = samples[width * k + 5] if own else s.c2
            p0 = total.share(L0, c0, t0, self.base, 0)
            p1 = total.share(L1 + s.context1, c1, t1, p0[s.up1], 1)
            p2 = total.share(s.context, c2, t2, p1[s.up], 2)
            self.p0.append(np.r_[p0, total.share(L0, 0, 0, self.base, 0)])
            self.p1.append(p1)
            self.p2.append(p2)
            if own:
                t3, tables = samples[width * k + 6 : width * k + 8]
                self.tables.append(tables)
                self.p3 = self.p3 + total.share_words(own.customers[own.at], tables[own.at], own.c, t3, p2[own.up])

    def score(self, word: np.ndarray, repeat: np.ndarray, context: np.ndarray, names: np.ndarray | None = None, index: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: training count, log10 of the base, and of the model.
        ``context`` is per token, or, with the level of words, per name."""
        at = np.searchsorted(self.word, word)
        found = self.word[np.minimum(at, len(self.word) - 1)] == word if len(self.word) else np.zeros(len(word), bool)
        number = np.repeat(np.where(found, at, len(self.word)), repeat)
        known = np.r_[self.count, 0.0][number]
        if names is None:
            mean = sum(self._below(number, context.astype(np.int64)))
        else:
            named = self._find(self.name, names)
            place = np.where(named >= 0, np.r_[self.name_order, 0][named], -1)[index]
            in3 = np.where(place >= 0, self._find(self.key3, number * len(self.name) + np.r_[self.rank, 0][place]), -1)
            mean = self.p3[np.maximum(in3, 0)] if len(self.key3) else np.zeros(len(number))
            rest = np.flatnonzero(in3 < 0)  # pairs that no text of the model's holds
            if len(rest):
                own = place[rest]
                below = self._below(number[rest], context.astype(np.int64)[index[rest]])
                seats = [(np.where(own >= 0, np.r_[x, 0][own], 0) for x in (self.customers, t)) for t in self.tables]
                mean[rest] = sum(total.share_words(*seat, 0, 0, p) for total, seat, p in zip(self.totals, seats, below, strict=True))
        return known, np.log10(known + 1) - self.smooth, np.log10(mean / len(self.totals))

    def _below(self, number: np.ndarray, context: np.ndarray) -> list[np.ndarray]:
        """Per sample the probabilities by the ends of the preceding words."""
        low = context & 0xFF
        in1 = self._find(self.key1, number * 256 + low)
        in2 = self._find(self.key2, number * 65536 + _turned(context))
        out = []
        for total, p0, p1, p2 in zip(self.totals, self.p0, self.p1, self.p2, strict=True):
            p = total.share(L1 + low, 0, 0, p0[number], 1)
            p = np.where(in1 >= 0, np.r_[p1, 0.0][in1], p)
            out.append(np.where(in2 >= 0, np.r_[p2, 0.0][in2], total.share(context, 0, 0, p, 2)))
        return out

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, at, -1)


def _rounds(docs: DataFrame, size: int) -> list[DataFrame]:
    """``docs`` in parts scored one after the other, whose exchanges are
    deleted in between."""
    n = min(MAX_ROUNDS, max(1, size // ROUND_BYTES))
    return [docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) == k) for k in range(n)] if n > 1 else [docs]


MOVED = "part int, salt int, batch bigint, body binary, doc_id array<bigint>, n array<bigint>"


def _token_blobs(docs: DataFrame, slices: int, salts, words: bool) -> DataFrame:
    """Tokens packed by slice, and a row with each batch's documents."""
    names = ["part", "salt", "batch", "body", "doc_id", "n"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId() << 32, 0
        for group in text_groups(batches, GROUP):
            batch, k = task + k, k + 1
            ids = group.column(0).to_pylist()
            tokens = Tokens.of(text_bytes(group))
            rows = [(-1 - batch % (1 << 20), 0, batch, None, ids, np.bincount(tokens.text, minlength=len(ids)).tolist())]
            number, text, before = tokens.sorted_tokens(len(ids), slices)
            word, text = tokens.digest[number], text.astype(np.uint16 if len(ids) <= 1 << 16 else np.uint32)
            for s, a, b in _by_slice(_dealt(word, slices)):
                w = word[a:b]
                first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
                repeat = np.diff(np.r_[first, len(w)]).astype(np.uint32)
                own = [tokens.tail[before[a:b]]]
                if words:
                    names_, *own = tokens.named(before[a:b])
                    own.insert(1, names_)
                rows.append((s, batch % salts.value[s], batch, _pack(w[first], repeat, text[a:b], *own), None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.mapInArrow(run, MOVED)


def score_documents(docs: DataFrame, seed: int = 0, words: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score.  With ``words`` the preceding
    word is a context too, above its last two bytes."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length(text_column()).cast("bigint"))).first()[0] or 0
    slices = max(MIN_WORD_SLICES, math.ceil(size / WORD_SLICE_BYTES)) if words else max(MIN_SLICES, math.ceil(size / SLICE_BYTES))
    with small_batches(spark):
        model, totals = train(docs, slices, seed, words)
        rounds = _rounds(docs, size if words else 0)
        scored = [_scored(part, model, totals, slices, words, len(rounds)) for part in rounds]
    discard(model)
    return reduce(DataFrame.unionByName, scored)


def _scored(docs: DataFrame, model: DataFrame, totals: list[Totals], slices: int, words: bool, rounds: int) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(totals)
    # slices with many tokens in a round are copied
    loads = {p: n for p, n in model.filter("code IS NOT NULL").select("part", F.aggregate(F.filter(F.arrays_zip("code", "t"), lambda x: x["code"] == STATS + 3), F.lit(0).cast("bigint"), lambda a, x: a + x["t"])).collect()}
    salts = [max(1, math.ceil(loads.get(p, 0) / (COPY_TOKENS * rounds))) for p in range(slices)]
    shared_salts = spark.sparkContext.broadcast(salts)
    copies = spark.createDataFrame(list(enumerate(salts)), "part int, copies int")
    blank = [F.lit(None).cast("array<bigint>").alias(n) for n in ("doc_id", "n")]
    sent = model.join(F.broadcast(copies), "part").select("part", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.col("bucket").cast("bigint").alias("batch"), F.col("state").alias("body"), *blank)
    moved = sent.unionByName(_token_blobs(docs, slices, shared_salts, words)).repartition(sum(salts) * 2, "part", "salt").sortWithinPartitions("part", "salt", "batch")

    names = ["batch", "doc_id", "n", "body"]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, scorer, pieces = None, None, []
        for b in batches:
            rows = []
            for part, salt, batch, body, ids, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part < 0:
                    rows.append((batch, ids, n, None))
                    continue
                if (part, salt) != place:
                    place, scorer = (part, salt), None
                if batch < 0:
                    pieces.append(body)
                    if batch == -1:
                        scorer = Scorer(b"".join(pieces), shared.value, words)
                        pieces.clear()
                    continue
                scorer = scorer or Scorer(None, shared.value, words)
                word, repeat, text, *own = _unpack(body)
                known, base, model_ = scorer.score(word, repeat, *own)
                docs_, at = np.unique(text, return_inverse=True)
                sums = [np.bincount(at, weights=x) for x in (known > 0, base, model_)]
                rows.append((batch, None, None, _pack(docs_, *sums)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    with shuffles_deleted(spark):
        scored = written(moved.mapInArrow(score, "batch bigint, doc_id array<bigint>, n array<bigint>, body binary"), "py-scored")
    tokens = totals[0].tokens
    result = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, n, sums = None, None, None

        def flush() -> pa.RecordBatch:
            cols = [ids, [held_out(i) for i in ids], n, sums[0].astype(np.int64), [tokens] * len(ids), sums[1], sums[2]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, result, strict=True)], schema=result)

        for b in batches:
            for _, ids_, n_, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if body is None:
                    if ids is not None:
                        yield flush()
                    ids, n, sums = ids_, n_, np.zeros((3, len(ids_)))
                    continue
                at, *parts = _unpack(body)
                sums[:, at] += parts
        if ids is not None:
            yield flush()

    order = scored.repartition("batch").sortWithinPartitions("batch", F.col("body").asc_nulls_first())
    done = order.mapInArrow(gather, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    with shuffles_deleted(spark):
        done = written(done, "py-scores")
    discard(scored)
    return done
