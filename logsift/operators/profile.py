"""Profile of the log format (operators D01-D19).

Each function takes profile-dialect records (:func:`parse_profile_lines`)
and returns a small DataFrame; together they are the profile report.
Every count is a partial aggregate; the few global steps (a percentage,
a top-k, the first samples) run after aggregation or through Spark's
bounded ``orderBy().limit()``, never over a whole group of raw rows.
Ties of every top-k are broken by key, ascending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsift.functions import fixed
from logsift.functions.text import id_prefix, trim_python
from logsift.functions.timestamps import date_token, is_http_timestamp_profile

def _rt() -> Column:
    return F.col("record_type")


def file_order() -> list[Column]:
    """Numeric file order (names are digit strings), then line order."""
    return [F.length("source_file_id"), F.col("source_file_id"), F.col("line_number")]


def profile_summary(precs: DataFrame) -> DataFrame:
    """D01-D03, D09-D13, D15 in one pass: one row of counters."""

    def count_if(cond: Column) -> Column:
        return F.count(F.when(cond, F.lit(1)))

    qs, sr = _rt() == fixed.QUICK_SEARCH, _rt() == fixed.SEARCH_RESULTS
    event = _rt() != fixed.EMPTY
    return precs.agg(
        F.count_distinct(F.when(event, F.col("source_file_id"))).alias("files_processed"),
        count_if(event).alias("total_events"),
        count_if(_rt() == fixed.EMPTY).alias("empty_lines"),
        count_if(_rt() == fixed.UNPARSEABLE).alias("unparseable_lines"),
        count_if(qs & F.col("query_text").isNotNull() & (trim_python(F.col("query_text")) == "")).alias("qs_empty_query"),
        count_if(qs & is_http_timestamp_profile(F.col("timestamp"))).alias("timestamp_http_format_lines"),
        count_if(qs & (F.coalesce(F.size("document_ids_inline"), F.lit(0)) > 0)).alias("qs_inline_doc_ids"),
        count_if(sr & F.col("search_id").startswith("-")).alias("negative_search_id_lines"),
        count_if(_rt() == fixed.DOCUMENT_OPEN).alias("doc_open_with_ts"),
        count_if(_rt() == fixed.DOCUMENT_OPEN_NO_TS).alias("doc_open_no_ts"),
        count_if((_rt() == fixed.CARD_SEARCH_QUERY) & F.col("document_id").isNotNull()).alias("card_query_with_doc_id"),
    )


def _format_table(spark: SparkSession) -> DataFrame:
    """The fixed format table as a literal relation (built in the JVM)."""
    rows = [
        F.struct(
            F.lit(t).alias("record_type"),
            F.lit(p).alias("pattern"),
            F.lit("; ".join(f"{name}: {text}" for of, name, text in fixed.RECORD_FIELDS if of == t)).alias("fields"),
            F.lit(n or None).cast("string").alias("note"),
        )
        for t, p, n in fixed.RECORD_FORMATS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def profile_record_types(precs: DataFrame) -> DataFrame:
    """D04 + D05: records per type, percent of events, format, fields and note.

    The format table is a fixed list of eleven rows, so broadcasting it is
    bounded by construction; the percentage window runs over at most that
    many aggregated rows."""
    counts = precs.filter(_rt() != fixed.EMPTY).groupBy("record_type").agg(F.count(F.lit(1)).alias("records"))
    total = F.sum("records").over(Window.partitionBy())
    formats = F.broadcast(_format_table(precs.sparkSession))
    return (
        counts.select("record_type", "records", (F.lit(100.0) * F.col("records") / total).alias("percent"))
        .join(formats, "record_type", "left")
        .select("record_type", "records", "percent", F.coalesce("pattern", F.lit("—")).alias("pattern"), "fields", "note")
        .orderBy(F.desc("records"), "record_type")
    )


def _counted(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def profile_parse_errors(precs: DataFrame) -> DataFrame:
    """Lines per parse error (all of them; most frequent first)."""
    errs = precs.filter(F.col("parse_error").isNotNull())
    return _counted(errs, F.col("parse_error"), "parse_error").orderBy(F.desc("count"), "parse_error")


def profile_card_params(precs: DataFrame) -> DataFrame:
    """Card queries per parameter token (``$0``, ``$134``...)."""
    return _counted(precs.filter(_rt() == fixed.CARD_SEARCH_QUERY), F.col("card_param"), "card_param").orderBy(
        F.desc("count"), "card_param"
    )


def profile_result_sizes(precs: DataFrame, top: int = 20) -> DataFrame:
    """Result lines per number of ids on the line; the top 20."""
    sizes = _counted(precs.filter(_rt() == fixed.SEARCH_RESULTS), F.col("document_count"), "document_count")
    return sizes.orderBy(F.desc("count"), "document_count").limit(top)


def profile_date_tokens(precs: DataFrame, top: int = 20) -> DataFrame:
    """Timestamp prefixes before the first ``_`` (the date, or the
    weekday of an HTTP-style stamp); the top 20."""
    dated = precs.filter(F.col("timestamp").isNotNull())
    return _counted(dated, date_token(F.col("timestamp")), "date_token").orderBy(F.desc("count"), "date_token").limit(top)


def profile_doc_prefixes(precs: DataFrame, top: int = 30) -> DataFrame:
    """Id prefixes over result ids and single document ids (inline
    quick-search ids are not counted); the top 30."""
    ids = F.concat(
        F.coalesce(F.col("document_ids"), F.array().cast("array<string>")),
        F.when(F.col("document_id").isNotNull(), F.array("document_id")).otherwise(F.array().cast("array<string>")),
    )
    exploded = precs.select(F.explode(ids).alias("doc_id"))
    return _counted(exploded, id_prefix(F.col("doc_id")), "prefix").orderBy(F.desc("count"), "prefix").limit(top)


def profile_commands(precs: DataFrame) -> DataFrame:
    """Legacy command totals (types mapped to command names, summed)."""
    names = F.create_map(*[F.lit(x) for pair in fixed.LEGACY_COMMANDS for x in pair])
    typed = precs.filter(_rt() != fixed.EMPTY)
    name = F.coalesce(names[_rt()], _rt())
    return typed.groupBy(name.alias("command")).agg(F.count(F.lit(1)).alias("total_occurrences")).orderBy("command")


def profile_unparseable_samples(precs: DataFrame, k: int = 20) -> DataFrame:
    """The first 20 unparseable lines in file order, cut to 200
    characters.  ``orderBy().limit()`` keeps k rows per task, then k."""
    return (
        precs.filter(_rt() == fixed.UNPARSEABLE)
        .orderBy(*file_order())
        .limit(k)
        .select("source_file_id", "line_number", F.substring("raw", 1, 200).alias("line"), F.col("parse_error").alias("error"))
    )


#: Parsed fields of a profile record, in the order the report lists them.
SAMPLE_FIELDS = (
    "timestamp", "search_id", "document_ids", "document_count", "card_param", "document_id",
    "query_text", "params", "query_raw", "document_ids_inline", "tail_raw",
)


def profile_type_samples(precs: DataFrame, k: int = 2, *, with_fields: bool = False) -> DataFrame:
    """The first two records of each type but EMPTY, raw line cut to
    160; with ``with_fields`` also the record's parsed fields as a JSON
    object (the fields a record does not have are left out).  The rank limit
    is applied in each task before rows of a type meet."""
    cols = ["record_type", "sample_rank", "source_file_id", "line_number", F.substring("raw", 1, 160).alias("raw")]
    if with_fields:
        cols.append(F.to_json(F.struct(*SAMPLE_FIELDS)).alias("fields"))
    ties = [F.col("source_path")] if "source_path" in precs.columns else []
    rank = F.row_number().over(Window.partitionBy("record_type").orderBy(*file_order(), *ties))
    typed = precs.filter(_rt() != fixed.EMPTY).withColumn("sample_rank", rank)
    return typed.filter(F.col("sample_rank") <= k).select(*cols)
