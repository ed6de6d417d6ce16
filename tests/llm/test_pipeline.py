"""The pipeline against a plain version of its stages on sf0.001."""

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from logsift.llm import decontaminate, suffix_dedup
from logsift.llm.catalog import ORACLE_SQL

from .test_operators import ODD, components_of, frame, repeats, word_passages

SF = "/root/testdata/sf0.001"


def test_pipeline_on_documents(spark, llm):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    good = []
    for i, t in docs:
        w = t.split()
        if len(w) >= 50 and 100 * repeats(w, 3) <= 50 * len(w) and 100 * repeats(w, 8) <= 50 * len(w):
            good.append((i, t))
    near = components_of(good, 5, 80)
    one = [(i, t) for i, t in good if near[i] == i]
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES[:4]:
        frames.append(stage(spark, frames[-1], SF).cache())
        assert frames[-1].columns == frames[0].columns
    ids = [sorted(r.doc_id for r in f.select("doc_id").collect()) for f in frames[1:]]
    assert ids[0] == sorted(i for i, _ in good)
    assert ids[1] == sorted(i for i, _ in one)
    cut = {r.doc_id: r.text for r in frames[3].select("doc_id", "text").collect()}
    n = suffix_dedup.PASSAGE_WORDS
    counts = Counter(tuple(w[k : k + n]) for _, t in one for w in [t.encode().split()] for k in range(len(w) - n + 1))
    assert {i: t.encode() for i, t in cut.items()} == {i: word_passages(t.encode(), counts, n)[0] for i, t in one}
    assert any(cut[i] != t for i, t in one)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = lambda t: b" ".join(decontaminate.words(t.encode()))
    leaking = {i for i, t in cut.items() if any(plain(x) in plain(t) for x in items)}
    assert leaking.isdisjoint(ids[3])
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == ids[3]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows[:20]:
        assert np.frombuffer(r.ids, "<u4").tolist() == tokenizer.encode(cut[r.doc_id], add_special_tokens=False).ids


def test_stages_on_odd_rows(spark, llm):
    """Nulls, empty and long texts, repeated and null ids, clashing and
    missing columns, and no rows at all."""
    clash = ("_doc", "kept", "spans", "n_tokens", "ids", "form")
    for docs in (frame(spark, ODD), frame(spark, ODD, clash), frame(spark, [], clash).limit(0)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            done = stage(spark, docs, SF)
            rows = done.collect()
            assert len(rows) <= n
            if name == "tokens":
                assert len(rows) == n and "doc_id" in done.columns
                continue
            assert done.columns == docs.columns
            assert all(r[c] == "clash" for r in rows for c in docs.columns[2:])
            if name == "near duplicates":  # 5 and 6 are copies, 7 and 8 near copies
                assert {r.doc_id for r in rows} == ({i for i, _ in ODD} - {6, 8} if n else set())
            elif name != "quality rules":
                assert len(rows) == n
        twice = frame(spark, [(1, "x y " * 40), (None, None)]).select("doc_id", "text")
        assert corpus_pipeline.repeats_stage(spark, twice, SF).count() == 2


def test_sql_of_the_queries_runs(spark, llm):
    from logsift.llm.catalog import QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for name, sql in ORACLE_SQL.items():
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        got = [tuple(r) for r in QUERIES[name](spark, SF).select(*names).collect()]
        assert sorted(got) == sorted(want.fetchall())
