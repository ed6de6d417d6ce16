"""MinHash near-duplicates with odd sketches.

A document's set is its distinct ``size``-word shingles (A-Z lower-cased,
words without ASCII white space; a shorter text is one shingle).  From
``BANDS * ROWS`` MinHash samples come two things: band keys, which bring
possible pairs together, and an odd sketch, a bitmap in which each sample
flips one bit, so that samples two documents share cancel in the XOR.  Its
population count d estimates the similarity as
1 + n / 4k * ln(1 - 2 d / n) (n bits, k samples), most precisely for
similar sets.  Pairs estimated below ``MIN_ESTIMATE`` go no further; all
others are confirmed on the full sets: linked if
100 * |intersection| >= percent * |union|.

Documents with equal sets are folded to their smallest doc_id first.  In
each band bucket every member is first paired with the bucket's smallest
member only (hot members are salted), and the links' components are
found.  Buckets that still hold several components are then searched for
pairs across components, in blocks, by a finer odd sketch of their members
(``FINE`` samples), and those pairs are confirmed too.  So every pair of different sets that shares a band and
passes the sketch is either confirmed or already in one component, and no
group is expanded into all its pairs.

A pair with similarity 0.8 shares no band with probability
(1 - 0.8**4)**32 = 5e-8; the estimate of such a pair falls below 0.55, or
its fine estimate below 0.745 (both about five standard deviations), with
probability near 1e-6.

Null or empty texts and texts without words have an empty set and link
with nothing.  Rows with one doc_id are one node.  A null doc_id links
with nothing: component null, kept.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_bytes, text_column, text_groups, written
from .components import connected_components

BANDS, ROWS = 32, 4
SKETCH_WORDS = 8  # of 64 bits
MIN_ESTIMATE = 0.55
FINE, FINE_WORDS, FINE_ESTIMATE = 2048, 128, 0.745
#: Members confirmed against one smallest member in one group.
GROUP_MEMBERS = 256
#: Members of a bucket compared by sketch at once.
BLOCK = 2048
#: Bytes of text whose sets are made at once.
GROUP = 1 << 20

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 31, FINE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, FINE, dtype=np.uint32)
_C = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, size: int) -> set[tuple[bytes, ...]]:
    """The full set, for confirmation."""
    w = text.lower().split()
    if len(w) < size:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(size)), strict=False))


def hashed_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle digests of each text."""
    lower = pa.array([t.lower() for t in texts], pa.binary()).cast(pa.string())
    runs = pc.ascii_split_whitespace(lower)
    flat = runs.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(runs).to_numpy())
    keep = pc.binary_length(flat).to_numpy() > 0
    coded = flat.filter(pa.array(keep)).dictionary_encode()
    digest = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    word = digest[coded.indices.to_numpy()] if len(digest) else digest
    counts = np.bincount(owner[keep], minlength=len(texts))
    ends = np.cumsum(counts)
    n = max(len(word) - size + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled = _mix(rolled + word[i : i + n] * _C[i % 64])
    out = []
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(word[a:b].tobytes(), seed=b - a)], np.uint64))
        else:
            out.append(word[:0])
    return out


def minhashes(sets: list[np.ndarray], count: int = BANDS * ROWS) -> np.ndarray:
    """Samples (count, sets) of non-empty sets."""
    out = np.empty((count, len(sets)), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= 1 << 15):
            total += len(sets[last])
            last += 1
        part = sets[first:last]
        x = np.concatenate(part).astype(np.uint32)
        starts = np.cumsum([0, *(len(s) for s in part[:-1])])
        for j in range(count):
            out[j, first:last] = np.minimum.reduceat(x * _A[j] + _B[j], starts)
        first = last
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys; equal keys of different bands differ."""
    keys = np.empty((samples.shape[1], BANDS), np.int64)
    for b in range(BANDS):
        h = np.full(samples.shape[1], b + 1, np.uint64)
        for r in range(ROWS):
            h = _mix(h * _C[r] + samples[b * ROWS + r].astype(np.uint64))
        keys[:, b] = h.view(np.int64)
    return keys


def odd_sketches(samples: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """(sets, words) parity bitmaps of the samples."""
    out = np.zeros((samples.shape[1], words), np.uint64)
    rows = np.arange(samples.shape[1])
    for j, v in enumerate(samples):
        bit = _mix(v.astype(np.uint64) + (_C[j % 64 : j % 64 + 1] * np.uint64(j + 1))) % np.uint64(64 * words)
        out[rows, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
    return out


def most_different_bits(estimate: float = MIN_ESTIMATE, k: int = BANDS * ROWS, words: int = SKETCH_WORDS) -> int:
    """The largest XOR population count whose estimate reaches ``estimate``."""
    n = 64 * words
    return int((1 - np.exp((estimate - 1) * 4 * k / n)) * n / 2)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set digest (d1, d2), bands, sketch."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches, GROUP):
            sets = hashed_sets(text_bytes(part), size)
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            sketch: list = [None] * len(sets)
            if full:
                samples = minhashes([sets[i] for i in full])
                for i, b, k in zip(full, band_keys(samples), odd_sketches(samples).view(np.int64), strict=True):
                    bands[i], sketch[i] = b, k
            digest = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]
            cols = [part.column(0), [len(s) for s in sets], [int(d[0]) for d in digest], [int(d[1]) for d in digest], bands, sketch]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    schema = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def fine_sketches(texts: DataFrame, size: int) -> DataFrame:
    """(id, sketch) of texts (id, text) that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_groups(batches, GROUP):
            sets = hashed_sets(text_bytes(part), size)
            full = [i for i, s in enumerate(sets) if len(s)]
            if full:
                sketch = odd_sketches(minhashes([sets[i] for i in full], FINE), FINE_WORDS).view(np.int64)
                ids = part.column(0).take(pa.array(full, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(list(sketch), pa.list_(pa.int64()))], names=["id", "sketch"])

    return texts.select("id", "text").mapInArrow(run, "id bigint, sketch array<bigint>")


def _close(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sketches allow the threshold."""
    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("_x"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("_y"))
    apart = F.aggregate(F.zip_with("_x", "_y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    return pairs.join(left, "a").join(right, "b").filter(apart <= most_different_bits()).select("a", "b")


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets.  Each b is sent
    once per ``GROUP_MEMBERS`` of its partners."""
    groups = pairs.groupBy("b").agg(F.ceil(F.count("*") / GROUP_MEMBERS).cast("int").alias("_groups"))
    members = pairs.join(groups, "b").join(texts.select(F.col("doc_id").alias("a"), "text"), "a")
    members = members.select("b", F.pmod(F.xxhash64("a"), F.col("_groups")).cast("int").alias("part"), F.col("a"), "text")
    heads = groups.join(texts.select(F.col("doc_id").alias("b"), "text"), "b")
    heads = heads.select("b", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("part"), F.lit(None).cast("bigint").alias("a"), "text")
    both = heads.unionByName(members).repartition("b", "part").sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sets = None, []
        for part in text_groups(batches, GROUP):
            found: tuple[list, list] = ([], [])
            for b, p, a, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), text_bytes(part), strict=True):
                if (b, p) != group:
                    group, sets = (b, p), []
                own = shingle_set(t, size)
                if a is None:
                    sets.append(own)
                    continue
                for s in sets:
                    common = len(own & s)
                    if common and 100 * common >= percent * (len(own) + len(s) - common):
                        found[0].append(a)
                        found[1].append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

    return both.mapInArrow(run, "a bigint, b bigint")


def _matrices(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The columns as arrays, those of sketches (as bits) and bands as
    matrices; as Python numbers they would take six times the memory."""
    out = []
    for name, c in zip(batch.schema.names, batch.columns, strict=True):
        if pa.types.is_list(c.type):
            c = c.flatten().to_numpy().reshape(len(c), FINE_WORDS if name == "sketch" else BANDS)
        else:
            c = c.to_numpy()
        out.append(c.view(np.uint64) if name == "sketch" else c)
    return out


def _across(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of one bucket but different components whose sketches
    are close; members: (key, part, id, component, head, sketch, bands,
    half).  Pairs with the bucket's smallest member are known already; a
    pair that shares several buckets is given by the first of them."""
    limit = most_different_bits(FINE_ESTIMATE, FINE, FINE_WORDS)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(key: int, rows: list[list[np.ndarray]]) -> Iterator[tuple[int, int]]:
        # half: 0: compare within; 1 and 2: across
        ids, comp, head, bits, bands, half = (np.concatenate(c) for c in zip(*rows, strict=True))
        names, size = np.unique(comp, return_counts=True)
        largest = names[size.argmax()]
        for i in np.flatnonzero(comp != largest).tolist():
            other = (comp != comp[i]) & (ids != head) & (ids[i] != head[i]) & ((comp == largest) | (ids > ids[i]))
            if half[i]:
                other &= half != half[i]
            near = np.flatnonzero(other)
            near = near[np.bitwise_count(bits[near] ^ bits[i]).sum(axis=1) <= limit] if len(near) else near
            shared = (bands[near] == bands[i]).argmax(axis=1)
            for j in near[bands[i][shared] == key].tolist():
                yield max(int(ids[i]), int(ids[j])), min(int(ids[i]), int(ids[j]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def flush() -> pa.RecordBatch:
            found = list(pairs(group[0], rows))
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], schema=schema)

        for batch in batches:
            key, part, *cols = _matrices(batch)
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])]) if len(key) else key
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)], strict=True) if len(key) else ():
                if (place := (int(key[a]), int(part[a]))) != group:
                    if sum(len(r[0]) for r in rows) > 1:
                        yield flush()
                    group, rows = place, []
                rows.append([c[a:b] for c in cols])
        if sum(len(r[0]) for r in rows) > 1:
            yield flush()

    order = members.select("key", "part", "id", "component", "head", "sketch", "bands", "half")
    return order.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(run, "a bigint, b bigint")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Adds part and half: buckets of more than ``BLOCK`` members are cut
    into blocks, and each pair of blocks is a part of its own."""
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    rows = members.join(sizes, "key").withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    rows = rows.withColumn("_other", F.explode(others))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    half = F.when(F.col("_own") == F.col("_other"), 0).when(F.col("_own") < F.col("_other"), 1).otherwise(2)
    return rows.withColumn("part", low * F.col("_blocks") + high).withColumn("half", half)


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (smallest doc_id reachable by links), kept."""
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, size, percent)


def _near_duplicates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    sig = written(signatures(docs, size), "signatures")
    nodes = sig.filter("n_shingles > 0 and doc_id is not null")
    folded = nodes.groupBy("d1", "d2").agg(F.min("doc_id").alias("id"))
    folded = written(nodes.join(folded, ["d1", "d2"]).select("doc_id", "id", "bands", "sketch"), "folded")
    copies = folded.filter("doc_id != id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    heads = folded.filter("doc_id = id").dropDuplicates(["id", "bands"])

    keys = heads.select("id", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("_last")).filter("head != _last").select("key", "head")
    members = written(keys.join(buckets, "key"), "buckets")
    sketches = heads.select("id", "sketch")
    star = members.filter("id != head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    star = written(_close(star, sketches), "star")

    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = written(texts.join(wanted, "doc_id", "left_semi"), "texts")
    links = written(_confirm(star, texts, size, percent), "star-links")
    first = connected_components(links)

    labelled = members.join(first.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("_a"), F.max("component").alias("_b"), F.count("*").alias("_n")).filter("_a != _b and _n > 2").select("key")
    open_ = written(labelled.join(mixed, "key").select("key", "id", "component", "head"), "mixed")
    fine = texts.join(open_.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    fine = written(fine_sketches(fine.withColumnRenamed("doc_id", "id"), size), "fine")
    open_ = open_.join(fine, "id").join(heads.select("id", "bands"), "id")
    across = written(_across(_in_blocks(open_)), "across")
    more = written(_confirm(across, texts, size, percent), "across-links")

    final = connected_components(links.unionByName(more).unionByName(copies))
    out = sig.select("doc_id", "n_shingles").join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _row_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, _text, _id): a number for every distinct doc_id and text, in
    the order of the doc_ids (null first); ``_text`` is the text's SHA-256."""
    rows = docs.select(F.col("doc_id"), F.sha2(text_column().cast("binary"), 256).alias("_text")).distinct()
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_text").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_text")
    return written(ordered.withColumn("_near_dup_id", F.monotonically_increasing_id()), "row-ids")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that of
    the smallest doc_id.  A document is a doc_id and a text: rows equal in
    both stay or go together.  Where doc_ids are null or name several texts,
    documents are numbered first, so that each text has its own fate."""
    text = text_column().cast("binary")
    named = docs.groupBy("doc_id").agg(F.min(F.xxhash64(text)).alias("_a"), F.max(F.xxhash64(text)).alias("_b"))
    if named.filter("doc_id is null or _a != _b").isEmpty():
        gone = near_duplicates(docs, **options).filter("not kept").select(F.col("doc_id").alias("_near_dup_gone")).distinct()
        return docs.join(gone, F.col("doc_id") == F.col("_near_dup_gone"), "left_anti")
    ids = _row_ids(docs)
    own = ids.select(F.col("doc_id").alias("_near_dup_doc"), F.col("_text").alias("_near_dup_own"), "_near_dup_id")
    numbered = docs.join(own, F.col("doc_id").eqNullSafe(F.col("_near_dup_doc")) & (F.sha2(text, 256) == F.col("_near_dup_own")))
    numbered = written(numbered.drop("_near_dup_doc", "_near_dup_own"), "numbered")
    gone = near_duplicates(numbered.select(F.col("_near_dup_id").alias("doc_id"), "text"), **options).filter("not kept").select(F.col("doc_id").alias("_near_dup_gone"))
    return numbered.join(gone, F.col("_near_dup_id") == F.col("_near_dup_gone"), "left_anti").drop("_near_dup_id")
