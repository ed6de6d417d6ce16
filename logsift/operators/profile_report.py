"""The format profile as one document (K5 over D01-D19).

Two reads of the profile records give everything the report holds:

* :func:`profile_counts`, one tagged aggregate: every record emits the
  (section, key) pairs it counts for, and one partial hash aggregate sums
  them, whatever the section;
* :func:`profile_samples`, the first records in file order of each type and
  of the unreadable lines, under one window whose rank limit runs in each
  task before rows meet.

:func:`profile_document` turns both into the lines of one JSON document.
The lines are rows, each with its place, so the document is sorted and
written by many tasks and no section has to fit in one: parse errors are as
many as there are different bad tokens.  Concatenated in the order of their
names, the part files are the document.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.functions import fixed
from logsift.functions.fence import fence
from logsift.functions.text import id_prefix, trim_python
from logsift.functions.timestamps import date_token, is_http_timestamp_profile
from logsift.operators.profile import SAMPLE_FIELDS, file_order

#: Sections of the tagged counts: letter of the tag, name.
COUNTED = (
    ("t", "record_type"),
    ("e", "parse_error"),
    ("p", "card_param"),
    ("s", "document_count"),
    ("d", "date_token"),
    ("x", "doc_prefix"),
    ("c", "flag"),
    ("f", "file"),
)
_MARK = "\x01"  # starts a tag; a document id starts with a letter

TOP = {"doc_prefix": 30, "document_count": 20, "date_token": 20}
UNPARSEABLE_SAMPLES, TYPE_SAMPLES = 20, 2


def _tag(letter: str, key: Column) -> Column:
    return F.concat(F.lit(_MARK + letter), key)


def _tags() -> list[Column]:
    """What a record counts for; null where it does not."""
    rt = F.col("record_type")
    qs, results, card = rt == fixed.QUICK_SEARCH, rt == fixed.SEARCH_RESULTS, rt == fixed.CARD_SEARCH_QUERY
    by_type = (
        F.when(rt == fixed.UNPARSEABLE, _tag("e", F.col("parse_error")))
        .when(card, _tag("p", F.col("card_param")))
        .when(results, _tag("s", F.col("document_count").cast("string")))
    )
    blank = F.col("query_text").isNotNull() & (trim_python(F.col("query_text")) == "")
    flag = (
        F.when(qs & blank, _tag("c", F.lit("qs_empty_query")))
        .when(results & F.col("search_id").startswith("-"), _tag("c", F.lit("negative_search_id_lines")))
        .when(card & F.col("document_id").isNotNull(), _tag("c", F.lit("card_query_with_doc_id")))
    )
    http = F.when(qs & is_http_timestamp_profile(F.col("timestamp")), _tag("c", F.lit("timestamp_http_format_lines")))
    inline = F.when(qs & (F.coalesce(F.size("document_ids_inline"), F.lit(0)) > 0), _tag("c", F.lit("qs_inline_doc_ids")))
    file = F.when(rt != fixed.EMPTY, _tag("f", F.col("source_file_id")))
    return [_tag("t", rt), by_type, _tag("d", date_token(F.col("timestamp"))), _tag("x", id_prefix(F.col("document_id"))), flag, http, inline, file]


def profile_counts(precs: DataFrame) -> DataFrame:
    """(section, key, count) of everything the profile counts, in one pass:
    records by type, parse error, card parameter, ids on a result line, date
    token and id prefix, the flagged lines, and the events of each file."""
    ids = F.coalesce(F.col("document_ids"), F.array().cast("array<string>"))
    items = precs.select(F.explode(F.concat(F.array(*_tags()), ids)).alias("_item")).filter(F.col("_item").isNotNull())
    tagged = F.col("_item").startswith(_MARK)
    names = F.create_map(*[F.lit(x) for pair in COUNTED for x in pair])
    section = F.when(tagged, names[F.substring("_item", 2, 1)]).otherwise(F.lit("doc_prefix"))
    key = F.when(tagged, F.substr("_item", F.lit(3))).otherwise(id_prefix(F.col("_item")))
    return items.groupBy(section.alias("section"), key.alias("key")).agg(F.count(F.lit(1)).alias("count"))


def profile_samples(precs: DataFrame) -> DataFrame:
    """(sample_of, sample_rank, raw, error, fields): the first records in
    file order of each type but EMPTY, with their fields as JSON, and, under
    ``sample_of`` null, of the unreadable lines."""
    rt = F.col("record_type")
    groups = F.when(rt == fixed.UNPARSEABLE, F.array(rt, F.lit(None).cast("string"))).otherwise(F.array(rt))
    ties = [F.col("source_path")] if "source_path" in precs.columns else []
    kept = precs.filter(rt != fixed.EMPTY).withColumn("sample_of", F.explode(groups))
    rank = F.row_number().over(Window.partitionBy("sample_of").orderBy(*file_order(), *ties))
    ranked = kept.withColumn("sample_rank", rank).filter(F.col("sample_rank") <= UNPARSEABLE_SAMPLES)
    ranked = ranked.filter(F.col("sample_of").isNull() | (F.col("sample_rank") <= TYPE_SAMPLES))
    return ranked.select(
        "sample_of",
        "sample_rank",
        F.when(F.col("sample_of").isNull(), F.substring("raw", 1, 200)).otherwise(F.substring("raw", 1, 160)).alias("raw"),
        F.col("parse_error").alias("error"),
        F.to_json(F.struct(*SAMPLE_FIELDS)).alias("fields"),
    )


#: The document's members in order: name, kind, and what fills it.  ``number``:
#: one of the totals; ``object`` and ``pairs``: a section of the counts as
#: {key: count} or [[key, count], ...]; the others are built by name.
LAYOUT = (
    ("files_processed", "number", ""),
    ("total_events", "number", ""),
    ("empty_lines", "number", ""),
    ("unparseable_lines", "number", ""),
    ("record_counts", "object", "record_type"),
    ("record_formats", "formats", ""),
    ("samples_by_type", "object", "samples"),
    ("qs_empty_query", "number", ""),
    ("timestamp_http_format_lines", "number", ""),
    ("qs_inline_doc_ids", "number", ""),
    ("negative_search_id_lines", "number", ""),
    ("doc_open_with_ts", "number", ""),
    ("doc_open_no_ts", "number", ""),
    ("card_param_counts", "object", "card_param"),
    ("card_query_with_doc_id", "number", ""),
    ("doc_prefixes_top30", "pairs", "doc_prefix"),
    ("search_results_doc_count_distribution", "object", "document_count"),
    ("date_formats_top20", "pairs", "date_token"),
    ("parse_errors", "object", "parse_error"),
    ("unparseable_samples", "list", "unparseable"),
    ("commands", "object", "commands"),
)
_PLACE = {name: k for k, (name, _, _) in enumerate(LAYOUT)}
_FILLS = {fill: (k, kind) for k, (_, kind, fill) in enumerate(LAYOUT) if fill}
_OPEN, _ENTRY, _CLOSE = 0, 1, 2


def _json_string(c: Column) -> Column:
    listed = F.to_json(F.array(c))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def record_formats() -> dict[str, dict]:
    """The fixed description of every record type."""
    out: dict[str, dict] = {}
    for record_type, pattern, note in fixed.RECORD_FORMATS:
        out[record_type] = {"pattern": pattern, "fields": {name: text for of, name, text in fixed.RECORD_FIELDS if of == record_type}}
        if note:
            out[record_type]["notes"] = note
    return out


def _totals(counts: DataFrame) -> DataFrame:
    """The document's plain numbers as (place, value)."""
    section, key, n = F.col("section"), F.col("key"), F.col("count")

    def of(kind: str, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when((section == kind) & cond, n)), F.lit(0))

    values = {
        "files_processed": F.count(F.when(section == "file", F.lit(1))),
        "total_events": of("record_type", key != fixed.EMPTY),
        "empty_lines": of("record_type", key == fixed.EMPTY),
        "unparseable_lines": of("record_type", key == fixed.UNPARSEABLE),
        "doc_open_with_ts": of("record_type", key == fixed.DOCUMENT_OPEN),
        "doc_open_no_ts": of("record_type", key == fixed.DOCUMENT_OPEN_NO_TS),
    }
    names = [name for name, kind, _ in LAYOUT if kind == "number"]
    cells = [F.struct(F.lit(_PLACE[c]).alias("place"), values.get(c, of("flag", key == c)).cast("long").alias("value")) for c in names]
    return counts.agg(F.array(*cells).alias("_all")).select(F.inline("_all"))


def _entry(place: int | Column, order: Column, key: Column, text: Column) -> list[Column]:
    place = place if isinstance(place, Column) else F.lit(place)
    return [place.cast("int").alias("place"), order.cast("long").alias("rank"), key.alias("key"), text.alias("text")]


def _entries(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """(place, rank, key, text) of every entry of the document's objects and
    lists, without commas."""
    place = F.create_map(*[F.lit(x) for _, name in COUNTED if name in _FILLS for x in (name, _FILLS[name][0])])
    section, key, n = F.col("section"), F.col("key"), F.col("count")
    paired = section.isin(*[s for s, (_, kind) in _FILLS.items() if kind == "pairs"])
    text = F.when(paired, F.concat(F.lit("["), _json_string(key), F.lit(", "), n, F.lit("]"))).otherwise(F.concat(_json_string(key), F.lit(": "), n))
    # equal counts come in the order of their keys, numbers as numbers
    number = F.when(section == "document_count", F.lpad(key, 10, "0")).otherwise(key)
    listed = counts.filter(section.isin(*[name for _, name in COUNTED if name in _FILLS]) & ~((section == "record_type") & (key == fixed.EMPTY)))
    best = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("count"), number))
    limit = F.create_map(*[F.lit(x) for pair in TOP.items() for x in pair])
    topped = listed.filter(section.isin(*TOP)).withColumn("_best", best).filter(F.col("_best") <= max(TOP.values()))
    topped = topped.filter(F.col("_best") <= limit[section]).drop("_best")
    ranked = listed.filter(~section.isin(*TOP)).unionByName(topped).select(*_entry(place[section], -n, number, text))

    names = F.create_map(*[F.lit(x) for pair in fixed.LEGACY_COMMANDS for x in pair])
    commands = (
        counts.filter((section == "record_type") & (key != fixed.EMPTY))
        .groupBy(F.coalesce(names[key], key).alias("key"))
        .agg(F.sum("count").alias("count"))
        .select(*_entry(_FILLS["commands"][0], F.lit(0), key, F.concat(_json_string(key), F.lit(': {"total_occurrences": '), n, F.lit("}"))))
    )
    unparseable = samples.filter("sample_of is null").select(
        *_entry(_FILLS["unparseable"][0], F.col("sample_rank"), F.lit(""), F.to_json(F.struct(F.col("raw").alias("line"), "error")))
    )
    shown = F.concat(F.lit('{"raw": '), _json_string(F.col("raw")), F.lit(', "fields": '), F.col("fields"), F.lit("}"))
    typed = samples.filter("sample_of is not null").groupBy("sample_of").agg(F.array_sort(F.collect_list(F.struct("sample_rank", shown.alias("text")))).alias("_all"))
    joined = F.concat(_json_string(F.col("sample_of")), F.lit(": ["), F.array_join(F.col("_all.text"), ", "), F.lit("]"))
    by_type = typed.select(*_entry(_FILLS["samples"][0], F.lit(0), F.col("sample_of"), joined))
    return ranked.unionByName(commands).unionByName(unparseable).unionByName(by_type)


def _frame_lines() -> list[tuple[int, int, str]]:
    """(place, part, line) of the document's brackets and fixed texts."""
    lines = [(-1, _OPEN, "{"), (len(LAYOUT), _CLOSE, "}")]
    for k, (name, kind, _) in enumerate(LAYOUT):
        comma = "," if k + 1 < len(LAYOUT) else ""
        if kind == "formats":
            text = json.dumps(record_formats(), ensure_ascii=False, indent=2).replace("\n", "\n  ")
            lines.append((k, _OPEN, f'  "{name}": {text}{comma}'))
        elif kind != "number":
            start, stop = "{}" if kind == "object" else "[]"
            lines += [(k, _OPEN, f'  "{name}": {start}'), (k, _CLOSE, f"  {stop}{comma}")]
    return lines


def profile_document(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """The lines of the report (place, part, rank, key, value): sorted by the
    first four, the values are one JSON document.  A value may itself hold
    line breaks."""
    counts, samples = fence(counts), fence(samples)  # all uses read the one exchange of each
    entries = _entries(counts, samples)
    last = entries.groupBy("place").agg(F.max(F.struct("rank", "key")).alias("_last")).withColumnRenamed("place", "_place")
    # one row a section
    marked = entries.join(F.broadcast(last), F.col("place") == F.col("_place"))
    comma = F.when(F.struct("rank", "key") == F.col("_last"), "").otherwise(",")
    rows = marked.select("place", F.lit(_ENTRY).alias("part"), "rank", "key", F.concat(F.lit("    "), "text", comma).alias("value"))
    names = F.create_map(*[F.lit(x) for name, k in _PLACE.items() for x in (k, name)])
    numbers = _totals(counts).select(
        "place", F.lit(_ENTRY).alias("part"), F.lit(0).cast("long").alias("rank"), F.lit("").alias("key"),
        F.concat(F.lit('  "'), names[F.col("place")], F.lit('": '), F.col("value"), F.lit(",")).alias("value"),
    )
    fixed_rows = [F.struct(F.lit(p).alias("place"), F.lit(q).alias("part"), F.lit(0).cast("long").alias("rank"), F.lit("").alias("key"), F.lit(v).alias("value")) for p, q, v in _frame_lines()]
    frame = counts.sparkSession.range(1).select(F.inline(F.array(*fixed_rows)))
    return rows.unionByName(numbers).unionByName(frame)
