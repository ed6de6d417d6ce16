"""Corpus pipeline: quality rules, near duplicates, repeated passages,
benchmark decontamination, then BPE encoding, each stage on what the one
before kept.  All stages but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.llm import bpe, decontaminate, near_dup, quality, suffix_dedup
from logsift.llm.catalog import TOKENIZER
from logsift.llm.common import ship, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ship(spark)
    return quality.keep_good(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the smallest doc_id."""
    ship(spark)
    return near_dup.keep_one(docs, size=5, percent=80)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that repeat, whole
    words only; n_chars, if there is one, is counted anew where text goes."""
    ship(spark)
    # other columns go under names that no result of the operator bears
    own = {c: f"_own{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    plain = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(o) for c, o in own.items()])
    kept = suffix_dedup.remove_repeats(plain, length=suffix_dedup.PASSAGE_WORDS, unit="words")
    text = F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        chars = F.when(F.col("n_removed") > 0, F.char_length(text)).otherwise(F.col(own["n_chars"]))
        new["n_chars"] = chars.cast(docs.schema["n_chars"].dataType)
    return kept.select(*[new.get(c, F.col(own.get(c, c))).alias(c) for c in docs.columns])


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    ship(spark)
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source where there are any, n_tokens, ids, and the
    digests of ids and of the decoded text."""
    ship(spark)
    own = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    done = bpe.digests(bpe.round_trip(docs.select(*own, "text"), TOKENIZER))
    return done.select(*own, "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_dup_stage),
    ("repeated passages", repeats_stage),
    ("benchmark leaks", leaks_stage),
    ("tokens", tokens_stage),
]

#: Substring removal, alignment and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
