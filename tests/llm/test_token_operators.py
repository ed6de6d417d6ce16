"""Byte-level BPE, tokenizer alignment and fill-in-middle against plain
versions, on rows with nulls, empty and long texts, ties, repeats and
clashing columns."""

import base64
import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import regex
import sentencepiece
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from logsift.llm import alignment, byte_bpe, fim

from .test_operators import LONG, ODD, frame

RANKS = P.path("byte_bpe_50k.tiktoken")
A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
GAP = " " * 40_000
MORE = [
    (20, "it's we'll '9 ''s x'ré 12ab!?c \t\n  　 中文，字 a'" + "b" * 300),
    (21, "lead" + GAP + "tail"),
    (22, "ends" + GAP),
    (23, GAP + "\n"),
    (24, "中文字，" * 30_000),
    (25, "x<P>y"),
    (26, "split <S" + "> mark"),
    (27, "spans  two\n\nblank lines   "),
    (28, "▁literal sign"),
    (29, "<0x41> <unk> <s> aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"),
    (30, "Same words here now again"),
]
ROWS = [*ODD, *MORE]


def encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


# byte-level BPE

TEXT = st.text(alphabet=st.sampled_from("ab Z19'.,!s tré\n\t　中，、_-<`"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(1, 6), st.integers(2, 4))
def test_parts_keep_the_matches(text, part_chars, long_blank):
    matches = []
    for part, one in byte_bpe.parts(text, part_chars, long_blank):
        matches += [part] if one else regex.findall(P.PATTERN, part)
    assert matches == regex.findall(P.PATTERN, text)


def test_parts_are_bounded():
    cut = [p for p, _ in byte_bpe.parts("word " * 100_000)]
    assert "".join(cut) == "word " * 100_000 and max(map(len, cut)) <= byte_bpe.PART_CHARS + 5


def test_long_white_space_is_encoded(spark, llm):
    text = "a" + " " * 3_000_000 + "b"
    row = byte_bpe.round_trip(frame(spark, [(1, text)]), RANKS, P.PATTERN).first()
    assert bytes(row.decoded).decode() == text and row.n_tokens > 1


def test_round_trip_against_the_library(spark, llm):
    own = encoding()
    done = byte_bpe.round_trip(frame(spark, ROWS, ("ids", "n_tokens", "other")), RANKS, P.PATTERN, tuple(byte_bpe._KINDS))
    got = done.collect()
    assert len(got) == len(ROWS) and {r.other for r in got} == {"clash"}
    assert Counter((r.doc_id, r.text) for r in got) == Counter(ROWS)
    for r in got:
        ids = own.encode_ordinary(r.text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    again = byte_bpe.decode(done.drop("decoded"), RANKS, P.PATTERN).collect()
    assert {(r.doc_id, bytes(r.decoded)) for r in again} == {(i, (t or "").encode()) for i, t in ROWS}
    assert byte_bpe.round_trip(frame(spark, []).limit(0), RANKS, P.PATTERN).count() == 0


def test_a_token_may_end_inside_a_character(spark, llm):
    ids = encoding().encode_ordinary("한")
    assert len(ids) > 1
    df = spark.createDataFrame([(1, bytearray(np.array(ids[:1], "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    got = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(df, RANKS, P.PATTERN).collect()}
    assert "한".encode().startswith(got[1]) and 0 < len(got[1]) < 3 and got[2] == b""


# alignment


def plain_groups(a_tok, b_tok, text):
    """Groups of one text as [(A ids, B ids)], by walking both lists."""
    if not text:
        return []
    alphabet = alignment._byte_of_char()
    raw = (" " + text).encode()
    a_ids = a_tok.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(alphabet[c] for c in a_tok.id_to_token(i)) for i in a_ids]
    b_ids = b_tok.encode(text)
    names = [b_tok.id_to_piece(i) for i in b_ids]
    b_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, names, strict=True)]
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return []
    out, a, b, i, j = [], [], [], 0, 0
    x = y = 0
    while i < len(a_ids) or j < len(b_ids):
        if x <= y and i < len(a_ids):
            x, i, _ = x + len(a_bytes[i]), i + 1, a.append(a_ids[i])
        else:
            y, j, _ = y + len(b_bytes[j]), j + 1, b.append(b_ids[j])
        if x == y:
            out.append((a, b))
            a, b = [], []
    return out


def plain_alignment(rows):
    a_tok = tokenizers.Tokenizer.from_file(A_PATH)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    groups = [plain_groups(a_tok, b_tok, t) for _, t in rows]
    links = [Counter((a, b) for p, q in g for a in p for b in q) for g in groups]
    count = Counter(pair for one in links for pair in one)
    top = Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (i, _), g, one in zip(rows, groups, links, strict=True):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        best = sum(n for pair, n in one.items() if count[pair] == top[pair[0]])
        total = sum(n * count[pair] for pair, n in one.items())
        digest = hashlib.sha256(text.encode()).hexdigest() if g else ""
        out.append((i, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), one.total(), best, total, digest, text))
    return out, count


def aligned(spark, rows, **options):
    docs = frame(spark, rows, ("n_a", "groups", "other")).repartition(5)
    done = alignment.align_documents(docs, A_PATH, B_PATH, keep_groups=True, **options)
    assert done.columns == ["doc_id", "other", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups) for r in done.collect()]


@pytest.mark.parametrize(("batch_bytes", "hot_parts"), [(8 << 20, 10_000), (1, 1)])
def test_alignment_against_walking_both_lists(spark, llm, batch_bytes, hot_parts):
    rng = random.Random(3)
    words = ["the", "Thé", "un", "ation", "x9", "_", "naïve", "café", "中", "tokenization", " ", "🙂", "don't"]
    rows = [*ROWS, *((40 + k, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for k in range(30)), *[(99, "a third of all rows")] * 20]
    want, _ = plain_alignment(rows)
    assert sorted(aligned(spark, rows, batch_bytes=batch_bytes, hot_parts=hot_parts), key=repr) == sorted(want, key=repr)


def test_alignment_of_nothing(spark, llm):
    assert alignment.align_documents(frame(spark, []).limit(0), A_PATH, B_PATH).count() == 0
    got = alignment.align_documents(frame(spark, [(1, None), (2, "")]), A_PATH, B_PATH).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_pair_counts(spark, llm):
    rows = [(1, "the cat"), (2, "the cat"), (3, "the dog the dog")]
    batches = alignment.align_texts(alignment.distinct_texts(frame(spark, rows)), A_PATH, B_PATH)
    got = {(r.a, r.b): (r.docs, r.best) for r in alignment.pair_counts(batches, 32_000).collect()}
    _, count = plain_alignment(rows)
    assert {k: v[0] for k, v in got.items()} == dict(count)
    assert all(best for _, best in got.values())


def test_a_large_group_is_counted_by_its_ids(monkeypatch):
    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        al = alignment.Aligner(f.read(), g.read(), True)
    texts = ["a" * 997 + "b" * 301, "the end", "", "ab" * 700]
    usual = [x.tolist() for x in al.align(texts).links()]
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 3)
    assert [x.tolist() for x in al.align(texts).links()] == usual


def test_both_encoders_of_the_byte_level_file_agree():
    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        spec, model = f.read(), g.read()
    assert alignment.ranks_are_merges(spec)
    assert not alignment.ranks_are_merges(spec.replace('"use_regex":true', '"use_regex":false').replace('"use_regex": true', '"use_regex": false'))
    by_rank, by_merge = alignment.Aligner(spec, model, True), alignment.Aligner(spec, model, False)
    rng = random.Random(5)
    entries = [e.decode("utf-8", "ignore") for e in alignment._entries(json.loads(spec)).values()]
    for _ in range(2_000):
        text = "".join(rng.choices(entries, k=rng.randint(1, 12)))
        assert by_rank._encode_a(text) == by_merge._encode_a(text)


# fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(key, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\té中<PSM>", max_size=40), st.integers(1, 7), st.data())
def test_frames_cut_and_restore(text, frame_bytes, data):
    raw = text.encode()
    stored = fim.store(raw, frame_bytes)
    units = UNIT.findall(text)
    assert stored.n == len(units) and b"".join(fim.opened([stored.frame(k) for k in range(len(stored.sizes))])) == raw
    first, last = sorted((data.draw(st.integers(0, len(units))), data.draw(st.integers(0, len(units)))))
    if stored.marked or not text:
        return
    p, m, s = "".join(units[:first]), "".join(units[first:last]), "".join(units[last:])
    for form, want in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}"), ("plain", text)):
        frames, prefix, middle = fim.rearrange(stored, form, first, last)
        assert b"".join(fim.opened(frames)) == want.encode()
        assert (prefix, middle) == ((None, None) if form == "plain" else (len(p), len(m)))
        assert b"".join(fim.restored(frames, form)) == raw


def test_whole_frames_are_taken_over():
    raw = LONG.encode()
    stored = fim.store(raw, 1 << 12)
    frames, _, _ = fim.rearrange(stored, "spm", stored.n // 3, stored.n // 2)
    kept = {stored.frame(k) for k in range(len(stored.sizes))}
    assert sum(f not in kept for f in frames) <= 3 + 4


@pytest.mark.parametrize("frame_bytes", [fim.FRAME_BYTES, 16])
def test_fim_against_plain_strings(spark, llm, frame_bytes):
    rows = [*ROWS, *((100 + k, f"some words é {k}  and more\n{'tail ' * (k % 5)}") for k in range(60))]
    stored = fim.store_frames(frame(spark, rows, ("form", "n", "frames", "other")), frame_bytes)
    got = fim.transform(stored, tuple(fim._OUT)).collect()
    assert len(got) == len(rows) and {r.other for r in got} == {"clash"}
    want = Counter((i, *plain_fim(i, t), t or "") for i, t in rows)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in got) == Counter(
        {(i, n, form, p, m, sha(out), sha(t)): c for (i, n, form, p, m, out, t), c in want.items()}
    )
    assert {r.doc_id: r.output for r in got if r.doc_id == 27} == {27: plain_fim(27, MORE[7][1])[4]}
    assert fim.transform(fim.store_frames(frame(spark, []).limit(0))).count() == 0


def test_a_missing_mark_is_an_error():
    with pytest.raises(ValueError, match="marks"):
        list(fim.restored([fim._press.compress(b"<P>a<S>b")], "psm"))
