"""Quality rules with suffix-array repetition.

Words are runs of bytes other than the six ASCII white-space characters.
Each document's word sequence gets a suffix array (prefix doubling, many
documents at once, suffixes of different documents never compared equal)
and the longest-common-prefix values of neighbours.  An LCP interval of
depth d is a repeated word sequence of length d; for each position the
deepest interval holding its suffix is the longest repeat that starts
there, and the spans of the maximal repeats are the union of these.  From
one pass follow the words in repeated 3-word windows (depth >= 3), the
words covered by repeats of at least ``min_repeat`` words, and the longest
repeat.

Null or empty text: no words, all counts 0, rejected (fewer than
``min_words`` words).  Null in other columns, repeated rows and clashing
extra columns have no effect: rows are judged one by one and every input
column passes through; the measures are added under their own names,
replacing input columns so named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, text_groups, with_columns

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_REPEAT = 8
MAX_COVERED_PERCENT = 50
MAX_REPEAT_WORDS = 200

SYMBOLS = b"#*$%&|<>"
_SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")


def longest_repeats(token: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every position the length of the longest word sequence starting
    there that also starts at another position of the same document."""
    n = len(token)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    key = doc.astype(np.int64) * (int(token.max()) + 1) + token
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    order = np.argsort(key, kind="stable")
    alive = _regroup(key[order], order, np.zeros(n, np.int64), np.arange(n), rank)
    levels, h = [rank.astype(np.int32)], 1
    while len(alive):
        # alive positions in rank order; the next h words decide
        after = rank[np.minimum(alive + h, n)]
        key = rank[alive] * (n + 2) + after + 1
        o = np.argsort(key, kind="stable")
        base = rank[alive][o]
        first = np.flatnonzero(np.r_[True, base[1:] != base[:-1]])
        offset = np.arange(len(o)) - np.repeat(first, np.diff(np.r_[first, len(o)]))
        new = rank.copy()
        alive = _regroup(key[o], alive[o], base, offset, new)
        rank = new
        levels.append(rank.astype(np.int32))
        h *= 2
    order = np.empty(n, np.int64)
    order[rank[:n]] = np.arange(n)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[near], b[near]
    pa_, pb = a.copy(), b.copy()
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][pa_] == levels[k][pb]
        step = same.astype(np.int64) << k
        lcp += step
        pa_ += step
        pb += step
    np.maximum.at(out, a, lcp)
    np.maximum.at(out, b, lcp)
    return out


def _regroup(key, position, base, offset, rank) -> np.ndarray:
    """Give sorted positions the rank of their group's first place; return
    the positions in groups of two or more, in rank order."""
    n = len(key)
    starts = np.r_[True, key[1:] != key[:-1]]
    first = np.flatnonzero(starts)
    size = np.diff(np.r_[first, n])
    rank[position] = np.repeat(base[first] + offset[first], size)
    return position[np.repeat(size, size) > 1]


def covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Boolean mask of the places inside the union of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[bytes], min_repeat: int = MIN_REPEAT) -> list[tuple[int, ...]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_covered_words, longest_repeat) of each text."""
    ids: dict[bytes, int] = {}
    tokens: list[int] = []
    counts = []
    plain = []
    for t in texts:
        words = t.split()
        tokens.extend([ids.setdefault(w, len(ids)) for w in words])
        counts.append(len(words))
        chars = len(t.decode("utf-8", "replace")) - sum(t.count(s) for s in _SPACES)
        symbols = sum(t.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
        lines = [x for x in t.split(b"\n") if x.strip()]
        plain.append((chars, symbols, len(lines) - len(set(lines))))
    token, size = np.array(tokens, np.int64), np.array(counts, np.int64)
    doc = np.repeat(np.arange(len(texts)), size)
    m = longest_repeats(token, doc)
    n = len(token)
    triple, long = np.flatnonzero(m >= 3), np.flatnonzero(m >= min_repeat)
    in3 = covered(triple, np.full(len(triple), 3), n)
    inl = covered(long, m[long], n)
    per = lambda mask: np.bincount(doc[mask], minlength=len(texts))
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, doc, m)
    return [(w, *p, int(r), int(c), int(g)) for w, p, r, c, g in zip(counts, plain, per(in3), per(inl), top, strict=True)]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat")


def quality_measures(
    docs: DataFrame,
    *,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    min_repeat: int = MIN_REPEAT,
    max_covered_percent: int = MAX_COVERED_PERCENT,
    max_repeat_words: int = MAX_REPEAT_WORDS,
) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``.

    ``kept`` is false if the base rules fail, if repeats of at least
    ``min_repeat`` words cover more than ``max_covered_percent`` of the
    words, or if the longest repeat exceeds ``max_repeat_words`` words."""
    docs = docs.drop(*MEASURES, "base_failed", "kept")
    schema = with_columns(docs, ", ".join(f"{m} bigint" for m in MEASURES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches):
            found = measure(text_bytes(part), min_repeat)
            cols = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, *MEASURES])

    out = docs.mapInArrow(run, schema)
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    good = (F.col("n_covered_words") * 100 <= F.col("n_words") * max_covered_percent) & (F.col("longest_repeat") <= max_repeat_words)
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & good)


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    own = {c: "text" if c == "text" else f"_own{k}" for k, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in own.items()])
    return quality_measures(plain, **limits).filter("kept").select(*[F.col(o).alias(c) for c, o in own.items()])
