"""License scans with a positional rare-token index.

Templates are short word sequences, each with a label and mandatory key
phrases.  The index maps a word to its postings (template, position).  A
first job counts in how many documents each indexed word occurs; the
inverse document frequency ranks the words.  A template is looked up by
its rarest words: for each file, the licence words it holds are taken
rarest first, and the postings of a template's rarest words found in the
file open relative positions (word place minus template place).  At each
opened position the template's other words are checked at their relative
places; the share of the template's IDF weight found there is its score.
A label is given if the score reaches ``min_score`` and every key phrase
stands consecutively within the aligned stretch.

The four base phrases are templates that must match in full, so each is
found at every place where its words stand consecutively: its rarest word
is then at the matching relative position.

Words: A-Z lower-cased, then runs of the bytes 0-9, a-z and 0x80-0xFF.
Null or empty text: no words, no labels (empty strings), null first and
last word, score 0.  Rows are scanned one by one and other columns pass
through; result columns replace input columns of their names.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_bytes, text_groups, with_columns

#: Share of a template's IDF weight that must be found in place.
MIN_SCORE = 0.8
#: Rarest words by which a template that need not match in full is looked up.
ANCHORS = 4

# The base phrases and their labels.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# Opening words of public licence notices, label, key phrases.
NOTICES = (
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("free software", "gnu general public license")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "free of charge")),
    ("mit-release", "released under the mit license", ("mit license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
)

_KEEP = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else 0x20 for b in range(256))
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORDS = bytes(_KEEP[_TABLE[b]] for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[bytes, ...], ...]
    base: bool


def templates(base=BASE, notices=NOTICES) -> list[Template]:
    cut = lambda t: tuple(t.encode().split())
    out = [Template(label, cut(text), (cut(text),), True) for label, text in base]
    return out + [Template(label, cut(text), tuple(cut(p) for p in phrases), False) for label, text, phrases in notices]


class Index:
    """Postings of the templates' words, with their weights."""

    def __init__(self, items: list[Template], documents: int, found: dict[bytes, int]):
        self.items = items
        vocabulary = {w for t in items for w in t.words}
        self.idf = {w: math.log((1 + documents) / (1 + found.get(w, 0))) + 1e-6 for w in vocabulary}
        self.weight = [sum(self.idf[w] for w in t.words) for t in items]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, t in enumerate(items):
            rarest = sorted(set(t.words), key=lambda w: (-self.idf[w], w))[: 1 if t.base else ANCHORS]
            for q, w in enumerate(t.words):
                if w in rarest:
                    self.postings[w].append((k, q))

    def scan(self, text: list[bytes], min_score: float) -> tuple[dict[int, list[int]], dict[int, float]]:
        """Starts of each base phrase, and the best score of each label."""
        lookups = [(i, w) for i, w in enumerate(text) if w in self.postings]
        lookups.sort(key=lambda x: (-self.idf[x[1]], x[0]))
        seen, starts, best = set(), defaultdict(list), {}
        for place, w in lookups:
            for k, q in self.postings[w]:
                at = place - q
                if (k, at) in seen:
                    continue
                seen.add((k, at))
                t = self.items[k]
                score = self._aligned(text, at, t, self.weight[k])
                if score < (1.0 if t.base else min_score) or not all(_stands(text, max(at, 0), at + len(t.words), p) for p in t.phrases):
                    continue
                best[k] = max(best.get(k, 0.0), score)
                if t.base:
                    starts[k].append(at)
        return starts, best

    def _aligned(self, text: list[bytes], at: int, t: Template, weight: float) -> float:
        missed = sum(self.idf[w] for q, w in enumerate(t.words) if not (0 <= at + q < len(text) and text[at + q] == w))
        return 1.0 if not missed else 1.0 - missed / weight


def _stands(text: list[bytes], start: int, stop: int, phrase: tuple[bytes, ...]) -> bool:
    n, want = len(phrase), list(phrase)
    return any(text[i : i + n] == want for i in range(start, min(stop, len(text)) - n + 1))


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those holding each indexed word; the
    result has one entry per vocabulary word, whatever the corpus."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = defaultdict(int)
        for part in text_groups(batches):
            for t in text_bytes(part):
                counts[b""] += 1
                for w in vocabulary.intersection(words(t)):
                    counts[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    summed = docs.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").sum("n").collect()
    found = {bytes(w): n for w, n in summed}
    return found.pop(b"", 0), found


RESULTS = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, items: list[Template] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with the columns of ``RESULTS``."""
    items = templates() if items is None else items
    names = [x.split()[0] for x in RESULTS.split(", ")]
    docs = docs.drop(*names)
    n, found = document_frequencies(docs, {w for t in items for w in t.words})
    index = docs.sparkSession.sparkContext.broadcast(Index(items, n, found))  # size set by the templates

    def one(text: bytes) -> tuple:
        at = words(text)
        starts, best = index.value.scan(at, min_score)
        every = [i for s in starts.values() for i in s]
        base = sorted({items[k].label for k in starts})
        labels = sorted({items[k].label for k in best})
        return (len(at), len(every), min(every, default=None), max(every, default=None), ",".join(base), ",".join(labels), max(best.values(), default=0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for part in text_groups(batches):
            cols = zip(*[one(t) for t in text_bytes(part)], strict=True)
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*part.schema.names, *names])

    return docs.mapInArrow(run, with_columns(docs, RESULTS))
