"""BPE encoding and decoding with a tokenization automaton.

The merge list is compiled into a deterministic automaton over tokens that
accepts exactly the correct tokenizations.  It starts with one state that
loops on every alphabet symbol.  Each merge (u, v), in rank order, applies
one merge gadget: the state s that arcs labelled u lead to is cloned
without its arc v, the arcs u are turned to the clone, and every state
with an arc u gains an arc uv to where v led from s.  All arcs of one
label always share their end, so the automaton is held as

* ``target[token]``: the state an arc of that label leads to,
* per state: the state it was cloned from, the label it lost, and when.

Whether state s has an arc t follows from these: a token made after s has
an arc exactly if its left half has one; an older one if it is not the
lost label and the state cloned from has it.  Arcs so found are kept in a
transition table.  Every prefix of a word has exactly one correct
tokenization, so a word is encoded left to right: at each end place the
one token is taken whose arc leaves the state at its start place.  Work
per word is its length times the longest token, for words of any length.

A merge whose halves do not come earlier in the list, or two merges with
one result, are refused: priority merging and this construction need not
agree there.

Decoding emits the arc labels (the tokens' strings) joined by one blank,
which is what a tokenizer file without a decoder does.

Null text encodes as empty: no ids, empty decoded text.  Special tokens
written in a text become their ids, as in the library.  Rows are handled
one by one, so repeated rows, nulls elsewhere and extra columns pass
through; input columns named ``n_tokens``, ``ids`` or ``decoded`` are
replaced.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, text_groups, with_columns

#: Entries of a worker's word cache; it starts anew when full.
CACHE_WORDS = 600_000
#: Bytes of text encoded together: words repeated within are looked up once.
ENCODE_BYTES = 8 << 20
#: Entries of the transition table kept by a worker.
TABLE_ARCS = 400_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte value: bytes that print as
    themselves keep their character, the others follow from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    table = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Automaton:
    """Merges compiled by successive gadgets; see the module text."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end_mark: str = ""):
        self.vocab, self.end_mark = vocab, end_mark
        size = max(vocab.values(), default=-1) + 1
        self.left = [-1] * size
        self.made = [0] * size  # when the token was made; 0: alphabet
        self.live = [True] * size
        self.target = [0] * size
        self.parent, self.lost, self.born = [-1], [-1], [0]
        known = set(vocab.values())
        for a, b in merges:
            known.discard(vocab.get(a + b, -1))
        for when, (a, b) in enumerate(merges, 1):
            u, v, t = vocab[a], vocab[b], vocab[a + b]
            if u not in known or v not in known or t in known:
                raise ValueError(f"merge {when} ({a!r}, {b!r}) is not in a proper order")
            known.add(t)
            self._gadget(u, v, t, when)
        self.longest = max(map(len, vocab), default=0)
        self._table: dict[int, bool] = {}

    def _gadget(self, u: int, v: int, t: int, when: int) -> None:
        s = self.target[u]
        self.left[t], self.made[t], self.target[t] = u, when, self.target[v]
        if not (self.live[u] and self.live[v] and self.has(s, v)):
            self.live[t] = False
            return
        self.parent.append(s)
        self.lost.append(v)
        self.born.append(when)
        self.target[u] = len(self.parent) - 1

    def has(self, state: int, token: int) -> bool:
        """Whether the state has an arc with this label."""
        made, born = self.made, self.born
        while True:
            if not self.live[token]:
                return False
            if made[token] >= born[state]:
                if self.left[token] < 0:
                    return True
                token = self.left[token]
            elif self.lost[state] == token:
                return False
            else:
                state = self.parent[state]

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-split word, given as byte stand-ins."""
        return next(self.encode_sorted([word]))

    def encode_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each word; a place's state depends on the letters before
        it alone, so words in sorted order share the walk of their common
        beginnings."""
        get, table, target, longest, end = self.vocab.get, self._table, self.target, self.longest, self.end_mark
        size = len(self.left)
        if len(table) > TABLE_ARCS:
            table.clear()
        state, start, label = [0], [0], [-1]
        before = ""
        for word in words:
            n = len(word)
            if not n:
                yield []
                continue
            same, most = 0, min(len(before), n) - 1
            while same < most and before[same] == word[same]:
                same += 1
            del state[same + 1 :], start[same + 1 :], label[same + 1 :]
            before = word
            for j in range(same + 1, n + 1):
                mark = end if j == n else ""
                for i in range(j - 1, max(-1, j - longest - 1), -1):
                    token = get(word[i:j] + mark)
                    if token is None:
                        continue
                    arc = state[i] * size + token
                    ok = table.get(arc)
                    if ok is None:
                        ok = table[arc] = self.has(state[i], token)
                    if ok:
                        state.append(target[token])
                        start.append(i)
                        label.append(token)
                        break
                else:
                    raise ValueError(f"no arc spells place {j} of {word!r}")
            ids, j = [], n
            while j:
                ids.append(label[j])
                j = start[j]
            yield ids[::-1]


# Fixed value: the split pattern of the tokenizer files this module reads.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for lower-case text below U+0240 without U+0085 and U+00A0.
_PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}\t-\r ]+"
#: Bytes that do not begin characters from U+0240 on.
_USUAL = bytes(range(0xC9))


class WordEncoder:
    """Text handling of one tokenizer file (its JSON text): special tokens,
    normalization and pre-splitting.  Characters below U+0240 need only
    lower case and the split pattern, done for many texts at once; other
    texts go through the file's own normalizer and splitter.  Subclasses
    turn distinct pre-split words into ids."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        conf = json.loads(spec)
        if PATTERN not in {p.get("pattern", {}).get("Regex") for p in conf["pre_tokenizer"].get("pretokenizers", [])}:
            raise ValueError("the file's split pattern is not the supported one")
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        stops = sorted((re.escape(t.encode()) for t in self.special), key=len, reverse=True)
        self._stop = re.compile(b"(" + b"|".join(stops) + b")") if stops else None
        model = conf["model"] | {"vocab": {}, "merges": []}
        bare = Tokenizer.from_str(json.dumps(conf | {"model": model, "added_tokens": []}))
        self._normal, self._split = bare.normalizer, bare.pre_tokenizer
        self._symbols = byte_symbols()
        self._words: dict[str, bytes] = {}

    def word_ids(self, words: list[str]) -> Iterator[bytes]:
        """Ids of pre-split words (byte stand-ins, in sorted order)."""
        raise NotImplementedError

    def _ids(self, words: list[str]) -> list[bytes]:
        have, symbols = self._words, self._symbols
        if len(have) > CACHE_WORDS:
            have.clear()
        new = {"".join([symbols[x] for x in w.encode()]): w for w in words if w not in have}
        missing = sorted(new)
        have.update(zip([new[m] for m in missing], self.word_ids(missing), strict=True))
        return [have[w] for w in words]

    def _spaced(self, text: bytes) -> str:
        """The pre-split words of an unusual text, set apart by blanks."""
        line = self._normal.normalize_str(text.decode("utf-8"))
        return " ".join([line[a:b] for _, (a, b) in self._split.pre_tokenize_str(line)])

    def _pieces(self, texts: list[bytes]) -> tuple[list[bytes], list[int]]:
        """The texts cut at special tokens, and the text of each piece."""
        pieces, owner = [], []
        for k, t in enumerate(texts):
            for p in self._stop.split(t) if self._stop is not None else [t]:
                pieces.append(p)
                owner.append(k)
        return pieces, owner

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces, owner = self._pieces(texts)
        ends = np.array([pieces[i].decode("ascii", "ignore") in self.special if pieces[i][:1] == b"<" else False for i in range(len(pieces))], bool)
        unusual = [k for k, p in enumerate(pieces) if not ends[k] and (p.translate(None, _USUAL) or b"\xc4\xb0" in p)]  # U+0130 has a lower case of two characters
        spaced = {k: self._spaced(pieces[k]) for k in unusual}
        plain = pa.array([b"" if ends[k] or k in spaced else p.replace(b"\xc2\xa0", b" ").replace(b"\xc2\x85", b" ") for k, p in enumerate(pieces)], pa.binary())
        marked = pc.replace_substring_regex(pc.utf8_lower(plain.cast(pa.string())), _PLAIN, r"\0 ")
        if spaced:
            marked = pa.array([spaced.get(k, m) for k, m in enumerate(marked.to_pylist())], pa.string())
        runs = pc.ascii_split_whitespace(marked)
        flat = runs.flatten()
        run_piece = np.repeat(np.arange(len(pieces)), pc.list_value_length(runs).to_numpy())
        keep = pc.binary_length(flat).to_numpy() > 0
        coded = flat.filter(pa.array(keep)).dictionary_encode()
        index, run_piece = coded.indices.to_numpy(), run_piece[keep]
        ids = self._ids(_strings(coded.dictionary))
        for k in np.flatnonzero(ends).tolist():  # special tokens, in their place
            at = np.searchsorted(run_piece, k, side="right")
            index, run_piece = np.insert(index, at, len(ids)), np.insert(run_piece, at, k)
            ids.append(np.array([self.special[pieces[k].decode()]], "<u4").tobytes())
        size = np.array([len(i) // 4 for i in ids], np.int64)
        first = np.cumsum(size) - size
        n = size[index]
        total = np.cumsum(n)
        all_ids = np.frombuffer(b"".join(ids), "<u4")
        out = all_ids[np.repeat(first[index] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        per_text = np.bincount(np.array(owner, np.int64)[run_piece], weights=n, minlength=len(texts)).astype(np.int64)
        raw, stop = out.tobytes(), np.cumsum(per_text) * 4
        return [raw[a:b] for a, b in zip((stop - per_text * 4).tolist(), stop.tolist(), strict=True)]


class Codec(WordEncoder):
    """Encoder and decoder of one tokenizer file by its automaton."""

    def __init__(self, spec: str):
        super().__init__(spec)
        model = json.loads(spec)["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], pairs, model.get("end_of_word_suffix") or "")
        labels = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self._labels = pa.array([labels.get(i, "") for i in range(max(labels) + 1)], pa.string())

    def word_ids(self, words: list[str]) -> Iterator[bytes]:
        for ids in self.automaton.encode_sorted(words):
            yield array("I", ids).tobytes()

    def decode(self, ids: list[bytes]) -> pa.Array:
        """The arc labels of each id sequence, joined by one blank."""
        offsets = np.cumsum([0, *(len(i) // 4 for i in ids)])
        labels = self._labels.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), labels), " ")


def _strings(words: pa.Array) -> list[str]:
    """Python strings of an array whose values hold no blank."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py().split(" ")


_codecs: dict[str, Codec] = {}


def codec(spec: str) -> Codec:
    """The worker's codec of a tokenizer file, built once per process."""
    if spec not in _codecs:
        _codecs.clear()
        _codecs[spec] = Codec(spec)
    return _codecs[spec]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (binary, little-endian
    unsigned 32-bit).  The vocabulary file is read by the driver and
    broadcast; its size does not depend on the data."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    docs = docs.drop("n_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        for part in text_groups(batches, ENCODE_BYTES):
            ids = c.encode(text_bytes(part))
            added = [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, "n_tokens", "ids"])

    return docs.mapInArrow(run, with_columns(docs, "n_tokens bigint, ids binary"))


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the labels of its ``ids``."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        for part in text_groups(batches, column="ids"):
            yield pa.RecordBatch.from_arrays([*part.columns, c.decode(text_bytes(part, "ids"))], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, with_columns(encoded, "decoded string"))


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``decoded``, by one worker a
    task that holds one vocabulary."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    docs = docs.drop("n_tokens", "ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        for part in text_groups(batches):
            ids = c.encode(text_bytes(part))
            added = [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), c.decode(ids)]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, "n_tokens", "ids", "decoded"])

    return docs.mapInArrow(run, with_columns(docs, "n_tokens bigint, ids binary, decoded string"))


def digests(df: DataFrame) -> DataFrame:
    return df.withColumn("ids_sha256", F.sha2("ids", 256)).withColumn("decoded_sha256", F.sha2(F.col("decoded").cast("binary"), 256))
