"""Alignment of two tokenizers' tokens, each distinct text once.

Tokenizer A (byte-level BPE) takes a space and the text, tokenizer B
(sentence pieces) the text, to which it adds the space.  Where tokens of
both end at the same byte a group ends; every A and every B token of a
group are linked.  The count of a pair of ids is the number of documents
that hold it linked.

1.  Documents are shuffled by their full text and counted (partial counts
    first, so a text that a third of all rows share is one row per task).
2.  Each distinct text is encoded and aligned once, in batches of
    ``BATCH_BYTES`` of text.  A batch is one row: its texts' measures, its
    sorted distinct pairs with the documents that hold them (the copies of a
    text count), and each text's links as places in that pair list.
3.  Pair counts are summed over the batches; the highest count of each A id
    comes from them.  Both go back to the batches' pair lists, never to
    single links: a batch lists a pair once however often it occurs.
4.  Each batch meets its pairs' counts and sums them over its texts' links.
5.  The measures are joined to the documents by the text's SHA-256.  Texts
    with more than ``1 / HOT_PARTS`` of all documents, at most ``HOT_PARTS``
    of them, are broadcast; the rest is shuffled.

Null and empty texts, and texts whose tokens' bytes are not the space and
the text (bytes that are no UTF-8, signs that B rewrites), have no tokens
and get zeros and an empty group digest.  Repeated rows each keep their
row.  ``docs`` needs ``doc_id`` (any type, null is a value) and ``text``;
columns that bear the name of an added one are replaced.

A is encoded with the tiktoken library where the driver has checked that its
file's merges reach every entry (then ranks and merges give the same ids),
else with the tokenizers library.  Vocabulary files are read by the driver
and broadcast; their size does not depend on the data.  The library
functions need this package on the executors' path.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import parts
from .common import text_groups, written

BATCH_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
LINKS_AT_ONCE = 1 << 20
HOT_PARTS = 10_000

#: How the byte-level pre-tokenizer of the tokenizers library splits; fixed value.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes in order for the code points from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _entries(spec: dict) -> dict[int, bytes]:
    byte = _byte_of_char()
    out = {i: bytes(byte[c] for c in entry) for entry, i in spec["model"]["vocab"].items()}
    for t in spec.get("added_tokens") or ():
        out.setdefault(t["id"], t["content"].encode())
    return out


def ranks_are_merges(spec_text: str) -> bool:
    """Whether merging by rank gives the ids that the file's merges give:
    merged entries come in the order of their ids, one merge each, and the
    merges turn every entry's characters into that entry.  (Two neighbours
    that join to an entry t can then only be the two halves of t's merge,
    since what is merged inside them is what t alone would merge.)"""
    spec = json.loads(spec_text)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    odd = model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges")
    if model["type"] != "BPE" or spec.get("normalizer") or not plain or odd:
        return False
    vocab = model["vocab"]
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if made != sorted(set(made)) or len(made) + 256 != len(vocab):
        return False
    bpe = tokenizers.Tokenizer.from_str(spec_text).model
    return all([t.id for t in bpe.tokenize(entry)] == [i] for entry, i in vocab.items())


class Aligner:
    """Both tokenizers, and tables of their tokens' bytes."""

    def __init__(self, a_spec: str, b_model: bytes, by_rank: bool):
        spec = json.loads(a_spec)
        entries = _entries(spec)
        if by_rank:
            ranks = {entries[i]: i for i in spec["model"]["vocab"].values()}
            encoding = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

            def encode(text: str) -> list[int]:
                out: list[int] = []
                for part, one in parts(text):
                    out += encoding._encode_single_piece(part) if one else encoding.encode_ordinary(part)
                return out
        else:
            tokenizer = tokenizers.Tokenizer.from_str(a_spec)
            tokenizer.encode_special_tokens = True
            tokenizer.no_truncation()
            tokenizer.no_padding()

            def encode(text: str) -> list[int]:
                return tokenizer.encode(text, add_special_tokens=False).ids

        self._encode_a = encode
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.n_a = max(entries, default=-1) + 1
        self.n_b = self._pieces.get_piece_size()
        self._a = pa.array([entries.get(i, b"") for i in range(self.n_a)], pa.binary())
        self._b = pa.array([self._piece_bytes(i) for i in range(self.n_b)], pa.binary())
        self._a_len, self._b_len = (np.diff(np.frombuffer(t.buffers()[1], np.int32)).astype(np.int64) for t in (self._a, self._b))
        a, b = [str(i) for i in range(self.n_a)], [str(i) for i in range(self.n_b)]
        self._words = pa.array([x + "," for x in a] + [x + "|" for x in a] + [x + "," for x in b] + [x + ";" for x in b], pa.binary())

    def _piece_bytes(self, i: int) -> bytes:
        piece = self._pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, texts: list[str]) -> Aligned:
        """Align texts; those without tokens have zeros everywhere."""
        b_ids = self._pieces.encode(texts, num_threads=1)
        raw = [(" " + t).encode("utf-8", "replace") if t else b"" for t in texts]
        a_ids = [self._encode_a(" " + t) if t else [] for t in texts]
        a_bytes, a_cut = self._joined(self._a, a_ids)
        b_bytes, b_cut = self._joined(self._b, b_ids)
        good = [bool(r) and a_bytes[a_cut[i] : a_cut[i + 1]] == r and b_bytes[b_cut[i] : b_cut[i + 1]] == r for i, r in enumerate(raw)]
        return Aligned(self, len(texts), [a if g else [] for a, g in zip(a_ids, good, strict=True)], [b if g else [] for b, g in zip(b_ids, good, strict=True)])

    @staticmethod
    def _joined(table: pa.Array, ids: list[list[int]]) -> tuple[bytes, list[int]]:
        """All tokens' bytes, and where each text's begin."""
        flat = np.concatenate([np.array(i, np.int32) for i in ids]) if ids else np.zeros(0, np.int32)
        joined = table.take(pa.array(flat))
        offsets = np.frombuffer(joined.buffers()[1], np.int32)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int32)
        first = np.cumsum([0, *(len(i) for i in ids)])
        data = joined.buffers()[2].to_pybytes() if len(flat) else b""
        return data, offsets[first].tolist()


class Aligned:
    """The groups and links of some texts, on flat arrays over all of them.
    Every text ends a group, so groups never span two texts."""

    def __init__(self, aligner: Aligner, n_texts: int, a_ids: list[list[int]], b_ids: list[list[int]]):
        self._of = aligner
        self._a, self.n_a, a_text = _flat(a_ids)
        self._b, self.n_b, _ = _flat(b_ids)
        a_end, b_end = np.cumsum(aligner._a_len[self._a]), np.cumsum(aligner._b_len[self._b])
        a_closes, b_closes = _members(a_end, b_end), _members(b_end, a_end)
        self._a_group, self._b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
        self._a_closes, self._b_closes = a_closes, b_closes
        groups = int(a_closes.sum())
        self._p, self._q = np.bincount(self._a_group, minlength=groups), np.bincount(self._b_group, minlength=groups)
        self._a_first, self._b_first = np.cumsum(self._p) - self._p, np.cumsum(self._q) - self._q
        self._text = a_text[self._a_first] if groups else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self._text, minlength=n_texts)
        self.n_links = np.zeros(n_texts, np.int64)
        np.add.at(self.n_links, self._text, self._p * self._q)

    def groups(self) -> list[memoryview]:
        """Each text's groups, ``a1,a2|b1;a3|b2,b3``, as ASCII."""
        of = self._of
        words = np.empty(len(self._a) + len(self._b), np.int64)
        words[np.arange(len(self._a)) + self._b_first[self._a_group]] = self._a + of.n_a * self._a_closes
        a_upto = (self._a_first + self._p)[self._b_group]
        words[np.arange(len(self._b)) + a_upto] = 2 * of.n_a + self._b + of.n_b * self._b_closes
        cut = np.cumsum([0, *(self.n_a + self.n_b)])
        if not len(words):
            return [memoryview(b"")] * len(self.n_a)
        done = of._words.take(pa.array(words))
        offsets = np.frombuffer(done.buffers()[1], np.int32)[: len(words) + 1][cut].tolist()
        data = memoryview(done.buffers()[2])
        return [data[x : max(x, y - 1)] for x, y in zip(offsets, offsets[1:], strict=False)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, occurrences) of the texts' distinct linked pairs, in
        order; a pair is a * n_b + b.  Links are written out at most
        ``LINKS_AT_ONCE`` at a time; a larger group by its distinct ids."""
        span = self._of.n_a * self._of.n_b
        size = self._p * self._q
        found: list[tuple[np.ndarray, np.ndarray]] = []
        large = np.flatnonzero(size > LINKS_AT_ONCE)
        usual = np.flatnonzero(size <= LINKS_AT_ONCE)
        total = np.cumsum(size[usual])
        at = 0
        while at < len(usual):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + LINKS_AT_ONCE, "right")))
            g = usual[at:stop]
            n = size[g]
            group = np.repeat(g, n)
            k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
            a = self._a[self._a_first[group] + k // self._q[group]]
            b = self._b[self._b_first[group] + k % self._q[group]]
            found.append(np.unique(self._text[group] * span + a * self._of.n_b + b, return_counts=True))
            at = stop
        for g in large.tolist():
            a, x = np.unique(self._a[self._a_first[g] : self._a_first[g] + self._p[g]], return_counts=True)
            b, y = np.unique(self._b[self._b_first[g] : self._b_first[g] + self._q[g]], return_counts=True)
            step = max(1, LINKS_AT_ONCE // len(b))
            for i in range(0, len(a), step):
                keys = int(self._text[g]) * span + (a[i : i + step, None] * self._of.n_b + b).ravel()
                found.append((keys, (x[i : i + step, None] * y).ravel()))
        keys, n = _summed(found)
        return keys // span, keys % span, n


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, how many each text has, and the text of each."""
    n = np.array([len(i) for i in ids], np.int64)
    flat = np.concatenate([np.array(i, np.int64) for i in ids]) if ids else np.zeros(0, np.int64)
    return flat, n, np.repeat(np.arange(len(ids)), n)


def _members(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the sorted values are among the sorted others, as 0 and 1."""
    if not len(among):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return (among[at] == values).astype(np.int64)


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their numbers."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(found) == 1:
        return found[0]
    keys, inverse = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, inverse, np.concatenate([c for _, c in found]))
    return keys, n


TEXT_DDL = "key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string"
BATCH_DDL = f"batch binary, texts array<struct<{', '.join(c.replace(' ', ':', 1) for c in TEXT_DDL.split(', ')).replace(' ', '')}>>, pairs array<struct<pair:bigint,docs:bigint>>, links binary"
_TEXT = pa.struct(
    [("key", pa.binary()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string())]
)
_BATCH = pa.schema([("batch", pa.binary()), ("texts", pa.list_(_TEXT)), ("pairs", pa.list_(pa.struct([("pair", pa.int64()), ("docs", pa.int64())]))), ("links", pa.binary())])


class _Batch:
    """Texts of one output row."""

    def __init__(self, aligner: Aligner, keep_groups: bool):
        self._aligner, self._keep_groups = aligner, keep_groups
        self.bytes, self._texts, self._found = 0, [], []

    def add(self, texts: list[str], copies: list[int]) -> None:
        done = self._aligner.align(texts)
        text, pair, n = done.links()
        self._found.append((text + len(self._texts), pair, n))
        columns = zip(texts, copies, done.n_a.tolist(), done.n_b.tolist(), done.n_groups.tolist(), done.n_links.tolist(), done.groups(), strict=True)
        for t, c, a, b, g, links, words in columns:
            raw = t.encode("utf-8", "replace")
            self.bytes += len(raw)
            row = {"key": hashlib.sha256(raw).digest(), "copies": c, "n_a": a, "n_b": b, "n_groups": g, "n_links": links}
            row |= {"groups_sha256": hashlib.sha256(words).hexdigest() if a else "", "groups": bytes(words).decode() if self._keep_groups else None}
            self._texts.append(row)

    def row(self) -> pa.RecordBatch:
        text, pair, n = (np.concatenate([f[k] for f in self._found]) for k in range(3))
        pairs, place = np.unique(pair, return_inverse=True)
        copies = np.array([t["copies"] for t in self._texts], np.int64)
        docs = np.zeros(len(pairs), np.int64)
        np.add.at(docs, place, copies[text])
        per_text = np.bincount(text, minlength=len(self._texts))
        name = hashlib.sha256(b"".join(t["key"] for t in self._texts)).digest()
        listed = pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.StructArray.from_arrays([pa.array(pairs, pa.int64()), pa.array(docs)], ["pair", "docs"]))
        columns = [pa.array([name], pa.binary()), pa.array([self._texts], pa.list_(_TEXT)), listed, pa.array([pack_links(per_text, place, n)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=_BATCH)


def pack_links(per_text: np.ndarray, place: np.ndarray, n: np.ndarray) -> bytes:
    """Pairs per text, their places in the batch's list, their occurrences."""
    head = np.array([len(per_text), len(place)], "<i8").tobytes()
    body = [per_text.astype("<i8").tobytes(), np.diff(place, prepend=0).astype("<i4").tobytes(), n.astype("<i8").tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(body))


def unpack_links(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    texts, links = np.frombuffer(raw, "<i8", 2).tolist()
    per_text = np.frombuffer(raw, "<i8", texts, 16)
    steps = np.frombuffer(raw, "<i4", links, 16 + 8 * texts)
    return per_text, np.cumsum(steps, dtype=np.int64), np.frombuffer(raw, "<i8", links, 16 + 8 * texts + 4 * links)


_aligners: dict[tuple[bytes, bytes, bool], Aligner] = {}


def aligner(a_spec: str, b_model: bytes, by_rank: bool) -> Aligner:
    """The worker's aligner, built once per process."""
    key = hashlib.sha256(a_spec.encode()).digest(), hashlib.sha256(b_model).digest(), by_rank
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(a_spec, b_model, by_rank)
    return _aligners[key]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text, copies) of every text that is not empty."""
    text = F.col("text").cast("string")
    return docs.select(text.alias("text")).filter(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


def align_texts(texts: DataFrame, a_path: str, b_path: str, *, batch_bytes: int = BATCH_BYTES, keep_groups: bool = False) -> DataFrame:
    """Batches of aligned texts (text, copies): see ``BATCH_DDL``."""
    with open(a_path, encoding="utf-8") as f:
        a_spec = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    files = texts.sparkSession.sparkContext.broadcast((a_spec, b_model, ranks_are_merges(a_spec)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = aligner(*files.value)
        batch = None
        for part in text_groups(batches, SLICE_BYTES):
            batch = batch or _Batch(a, keep_groups)
            raw = part.column(0).cast(pa.binary()).to_pylist()
            batch.add([t.decode("utf-8", "replace") for t in raw], part.column(1).to_pylist())
            if batch.bytes >= batch_bytes:
                yield batch.row()
                batch = None
        if batch is not None:
            yield batch.row()

    return texts.select("text", "copies").mapInArrow(run, BATCH_DDL)


def pair_counts(batches: DataFrame, n_b: int) -> DataFrame:
    """(pair, a, b, docs, best): how many documents hold a pair linked, and
    whether that is the highest count of its A id."""
    a = F.expr(f"pair div {n_b}")
    counts = batches.select(F.inline("pairs")).groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = counts.select("pair", a.alias("a"), F.expr(f"pair % {n_b}").alias("b"), "docs")
    top = counts.groupBy("a").agg(F.max("docs").alias("_top"))
    return counts.join(top, "a").select("pair", "a", "b", "docs", (F.col("docs") == F.col("_top")).alias("best"))


MEASURE_DDL = f"{TEXT_DDL}, n_best bigint, count_sum bigint"


def _measure(batch: pa.Table, counts: pa.Table) -> pa.Table:
    """The texts of one batch with the sums over their links."""
    kinds = [f.type for f in _TEXT] + [pa.int64(), pa.int64()]
    names = [f.name for f in _TEXT] + ["n_best", "count_sum"]
    size = counts.num_rows
    docs, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    place = counts.column("place").to_numpy()
    docs[place], best[place] = counts.column("docs").to_numpy(), counts.column("best").to_numpy()
    tables = []
    for k in range(batch.num_rows):
        texts = batch.column("texts")[k].values
        per_text, at, n = unpack_links(batch.column("links")[k].as_py())
        owner = np.repeat(np.arange(len(per_text)), per_text)
        sums = np.zeros((2, len(per_text)), np.int64)
        np.add.at(sums[0], owner, n * best[at])
        np.add.at(sums[1], owner, n * docs[at])
        tables.append(pa.Table.from_arrays([*texts.flatten(), *(pa.array(s) for s in sums)], names=names))
    return pa.concat_tables(tables) if tables else pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)


def text_measures(batches: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per distinct text: ``MEASURE_DDL``."""
    lists = batches.select(F.col("batch").alias("of"), F.posexplode("pairs").alias("place", "p")).select("of", "place", F.col("p.pair").alias("pair"))
    told = lists.join(counts.select("pair", "docs", F.col("best").cast("bigint").alias("best")), "pair").select("of", "place", "docs", "best")
    rows = batches.select("batch", "texts", "links")
    return rows.groupBy("batch").cogroup(told.groupBy("of")).applyInArrow(_measure, MEASURE_DDL)


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align_documents(docs: DataFrame, a_path: str, b_path: str, *, batch_bytes: int = BATCH_BYTES, keep_groups: bool = False, hot_parts: int = HOT_PARTS) -> DataFrame:
    """``docs`` without ``text`` and with ``n_a``, ``n_b`` (tokens),
    ``n_groups``, ``n_links``, ``n_best`` (links whose count is the highest of
    their A id), ``count_sum`` (over the links), ``groups_sha256`` and, if
    asked for, ``groups`` itself."""
    added = [*MEASURES, "groups"] if keep_groups else [*MEASURES]
    batches = written(align_texts(distinct_texts(docs), a_path, b_path, batch_bytes=batch_bytes, keep_groups=keep_groups), "aligned")
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    counts = written(pair_counts(batches, n_b), "pair-counts")
    measures = written(text_measures(batches, counts), "measures")
    return join_measures(docs, measures, added, hot_parts)


def join_measures(docs: DataFrame, measures: DataFrame, added: list[str], hot_parts: int = HOT_PARTS) -> DataFrame:
    """Give every document its text's measures."""
    rest = [f"`{c}`" for c in docs.columns if c not in ("text", *MEASURES, "groups")]
    total = measures.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    told = measures.select("key", F.struct(*added).alias("_told"), (F.col("copies") * hot_parts > total).alias("_hot"))
    text = F.col("text").cast("string")
    keyed = docs.select(*rest, F.when(F.length(text) > 0, F.unhex(F.sha2(text.cast("binary"), 256))).alias("_key"))
    hot = told.filter("_hot").select(F.col("key").alias("_key"), F.col("_told").alias("_common"))
    marked = keyed.join(F.broadcast(hot), "_key", "left")
    # rows that are done already meet nothing below: their key is spread
    done = F.col("_key").isNull() | F.col("_common").isNotNull()
    spread = F.concat(F.lit("-"), F.xxhash64(*rest).cast("string")).cast("binary")
    marked = marked.withColumn("_key", F.when(done, spread).otherwise(F.col("_key")))
    usual = told.filter("not _hot").select(F.col("key").alias("_key"), F.col("_told").alias("_rare"))
    both = marked.join(usual, "_key", "left").withColumn("_told", F.coalesce("_common", "_rare"))
    empty = {c: F.lit("") if c.startswith("groups") else F.lit(0).cast("bigint") for c in added}
    return both.select(*rest, *[F.coalesce(F.col(f"_told.{c}"), empty[c]).alias(c) for c in added])
