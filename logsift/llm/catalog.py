"""Registered queries of this subpackage, and the SQL for those that SQL
can express.  Each query applies its operator with production parameters
to the whole table and derives the contract's columns from its output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, byte_bpe, decontaminate, fim, html_text, licenses, near_dup, pitman_yor, quality, sharding, suffix_dedup, token_files
from .common import ship, table, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
SHARDS = 40


def op1_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_odd_sketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op3_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    key = F.xxhash64("doc_id", "text").alias("doc")
    done = suffix_dedup.remove_repeats(docs, length=400).select(key, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    shared = suffix_dedup.shared_seeds(docs.select(key, "text"))
    return done.join(shared, "doc").drop("doc")


def op4_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"), words=True)


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.digests(bpe.round_trip(docs, TOKENIZER))
    return done.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op7_host_suffix_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op8_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shard(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_suffix_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality.quality_measures(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "base_failed", "kept")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.read_token_files(token_files.write_token_files(docs, TOKENIZER, END_ID))


def op11_tiktoken_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, ("n_tokens", "ids_sha256", "decoded_sha256"))
    return done.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op12_text_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = alignment.align_documents(docs, BYTE_TOKENIZER, PIECES)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_framed_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = written(fim.store_frames(table(spark, sf_dir, "documents").select("doc_id", "text")), "frames")
    digests = ("form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    return fim.transform(stored, digests).select("doc_id", "n", *digests)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(ship(spark), sf_dir)


QUERIES = {
    q.__name__: _shipped(q)
    for q in (
        op1_benchmark_leaks,
        op2_odd_sketch_near_dup,
        op3_suffix_family,
        op4_pitman_yor_scores,
        op5_bpe_automaton,
        op6_license_index,
        op7_host_suffix_text,
        op8_hypergeometric_shards,
        op9_suffix_quality,
        op10_token_files,
        op11_tiktoken_bytes,
        op12_text_alignment,
        op13_framed_fim,
    )
}

ORACLE_SQL = {
    "op2_odd_sketch_near_dup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS shingles FROM d
), sizes AS (
  SELECT doc_id, len(shingles)::BIGINT AS n FROM s
), e AS (
  SELECT doc_id, unnest(shingles) AS h FROM s
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM link UNION SELECT b, a FROM link
), reach AS (
  SELECT a AS doc_id, a AS r FROM both_ways UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a
), comp AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT sizes.doc_id, n AS n_shingles, coalesce(component_id, sizes.doc_id) AS component_id, coalesce(component_id, sizes.doc_id) = sizes.doc_id AS kept
FROM sizes LEFT JOIN comp USING (doc_id)
""",
    # a word is covered by repeats of at least r words exactly if it lies in
    # an r-word window that occurs twice in its document
    "op9_suffix_quality": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT row_number() OVER () AS k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), pos AS (
  SELECT k, words, unnest(range(1, len(words) + 1)) AS i FROM w
), win AS (
  SELECT k, i,
         CASE WHEN i + 2 <= len(words) THEN array_to_string(words[i:i + 2], ' ') END AS w3,
         CASE WHEN i + {quality.MIN_REPEAT - 1} <= len(words) THEN array_to_string(words[i:i + {quality.MIN_REPEAT - 1}], ' ') END AS wr,
         CASE WHEN i + {quality.MAX_REPEAT_WORDS} <= len(words) THEN md5(array_to_string(words[i:i + {quality.MAX_REPEAT_WORDS}], ' ')) END AS wl
  FROM pos
), rep AS (
  SELECT k, i,
         w3 IS NOT NULL AND count(*) OVER (PARTITION BY k, w3) > 1 AS r3,
         wr IS NOT NULL AND count(*) OVER (PARTITION BY k, wr) > 1 AS rr,
         wl IS NOT NULL AND count(*) OVER (PARTITION BY k, wl) > 1 AS rl
  FROM win
), cov AS (
  SELECT k,
         max(r3::int) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
         max(rr::int) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN {quality.MIN_REPEAT - 1} PRECEDING AND CURRENT ROW) AS cr,
         rl
  FROM rep
), per AS (
  SELECT k, sum(c3)::BIGINT AS n_repeat_words, sum(cr)::BIGINT AS n_covered_words, bool_or(rl) AS long_repeat FROM cov GROUP BY k
), lines AS (
  SELECT k, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_covered_words, 0) AS n_covered_words, coalesce(long_repeat, false) AS long_repeat
  FROM w LEFT JOIN per USING (k) LEFT JOIN lines USING (k)
), f AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words, base_failed,
       NOT base_failed AND 100 * n_covered_words <= {quality.MAX_COVERED_PERCENT} * n_words AND NOT long_repeat AS kept
FROM f
""",
    "op13_framed_fim": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""",
}
