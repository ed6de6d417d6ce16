"""Per-session state as window expressions (operators A1-A5).

The session fold of the log format keeps three pieces of state while it
walks a session in line order:

* the last *control* record (card-search start, quick search or search
  results): a card block is open exactly while that record is a
  card-search start, and the start's position identifies the block;
* the date of the last quick search (an impossible date resets it);
* the date of the session's first ``SESSION_START`` (whole-session scope).

The first two are "last value before this row" scans; the third is a
minimum over the whole window group (combined across the chunks of a large
session; :func:`session_dates` gives it as a plain aggregate).  A scan is
written as ``last(..., ignorenulls)`` over a frame ending one row before
the current one.  Values are wrapped in a struct so
that a null date stays visible instead of being skipped.

Scale: a window group is processed by one task, so a session must never
be one unbounded group.  Rows are ordered by ``(line_number, path_rank,
source_path)``, and every row belongs to a *segment* of its session, a
contiguous range of that order.  Sessions of up to ``chunk_rows`` rows are
one segment; larger ones are cut into segments bounded in size whether the
session is one huge file or many copies of one file name.  The state before
a segment is its *carry-in*: one summary row per segment of the large
sessions, and a window over these summaries.

All of this is one lazy plan for every size, and building it runs no job.
The list of large sessions is part of the plan: an aggregate of the session
sizes, joined by broadcast.  It is bounded: the ``max_listed`` largest sessions are
cut, and any other one holds less than the total rows over ``max_listed``.
When the list turns out empty (the usual case), adaptive execution
drops both joins and the whole summary branch, and what runs is one exchange
on the session id and one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.config import DEFAULT_CHUNK_ROWS, MAX_LISTED_SESSIONS
from logsift.functions import fixed
from logsift.functions.cache import session_cached
from logsift.functions.timestamps import extract_date

SID = "source_file_id"
_CONTROL_TYPES = (fixed.CARD_SEARCH_START, fixed.QUICK_SEARCH, fixed.SEARCH_RESULTS)
_DATED_TYPES = (fixed.SESSION_START, fixed.QUICK_SEARCH, fixed.DOCUMENT_OPEN)
_RANK_MAX = (1 << 63) - 1  # path_rank lies in [0, 2^63)


def with_order_keys(records: DataFrame) -> DataFrame:
    """Add ``source_path`` (null for table input) and ``path_rank``, the
    hash of the path that orders copies sharing a line number."""
    df = records if "source_path" in records.columns else records.withColumn("source_path", F.lit(None).cast("string"))
    return df.withColumn("path_rank", F.xxhash64("source_path").bitwiseAND(F.lit(_RANK_MAX)))


def target_hit(target: str) -> Column:
    """the record mentions the target document.  A lone id or a result
    id must equal it; free query text only has to contain it."""
    return (
        F.coalesce(F.col("document_id") == target, F.lit(False))
        | F.coalesce(F.col("query_text").contains(target), F.lit(False))
        | F.coalesce(F.array_contains("document_ids", target), F.lit(False))
    )


def relevant_events(records: DataFrame, target: str = fixed.TARGET_DOCUMENT) -> DataFrame:
    """F2/F3 plus the narrow row that crosses the session shuffle.

    The target test and the date are computed here, before any exchange,
    and text columns are dropped; result ids ride along only on result rows.
    """
    relevant = records.filter(F.col("record_type") != fixed.UNPARSEABLE)
    return with_order_keys(relevant).select(*_relevant_exprs(target))


@session_cached
def _relevant_exprs(target: str) -> list:
    rt = F.col("record_type")
    return [
        SID,
        "line_number",
        "source_path",
        "path_rank",
        "record_type",
        F.when(rt.isin(*_DATED_TYPES), extract_date("timestamp")).alias("event_date"),
        "document_id",
        F.when(rt == fixed.SEARCH_RESULTS, F.col("document_ids")).alias("document_ids"),
        F.when(rt.isin(fixed.CARD_SEARCH_QUERY, fixed.SEARCH_RESULTS), target_hit(target))
        .otherwise(F.lit(False))
        .alias("hit"),
    ]


def session_sizes(rows: DataFrame) -> DataFrame:
    """Rows and distinct paths per session.  Any upper bound on a session's
    record count will do, so callers pass the cheap ``log_lines`` (a count
    per session id, no parsing) when they have it."""
    df = rows if "source_path" in rows.columns else rows.withColumn("source_path", F.lit(None).cast("string"))
    return df.groupBy(SID).agg(
        F.count(F.lit(1)).alias("rows"),
        F.approx_count_distinct("source_path").alias("copies"),
    )


def large_sessions(sizes: DataFrame, chunk_rows: int, max_listed: int = MAX_LISTED_SESSIONS) -> DataFrame:
    """Sessions to cut (source_file_id, lines_per_chunk, path_parts), lazily.

    They are the ``max_listed`` largest of those with more than
    ``chunk_rows`` rows (a few MB, safe to broadcast at any size).  Which
    sessions are cut never changes a result, and one that is not listed
    holds at most the total rows over ``max_listed``, so segments stay a
    vanishing share of the input."""
    n = int(chunk_rows)
    listed = sizes.filter(F.col("rows") > n).orderBy(F.col("rows").desc(), SID).limit(max_listed)
    # lines_per_chunk * copies <= n rows per segment; with more copies than n,
    # one line number per segment and the copies split into path_parts ranges
    return listed.selectExpr(
        SID,
        f"CAST(greatest({n} div greatest(copies, 1), 1) AS BIGINT) AS lines_per_chunk",
        f"CAST(greatest(ceil(greatest(copies, 1) / {n}), 1) AS BIGINT) AS path_parts",
    )


def _chunked(events: DataFrame, large: DataFrame) -> DataFrame:
    """Attach ``chunk_line``/``chunk_part``: (0, 0) for ordinary sessions,
    contiguous bounded ranges of the row order for large ones."""
    joined = events.join(F.broadcast(large), SID, "left")
    return joined.select(
        *events.columns,
        F.coalesce(F.expr("line_number div lines_per_chunk"), F.lit(0)).cast("long").alias("chunk_line"),
        F.coalesce(F.expr("shiftright(shiftright(path_rank, 32) * path_parts, 31)"), F.lit(0)).cast("long").alias("chunk_part"),
        F.col("lines_per_chunk").isNotNull().alias("large_session"),
    )


@session_cached
def _control_struct() -> Column:
    return F.when(
        F.col("record_type").isin(*_CONTROL_TYPES),
        F.struct(
            F.col("line_number").alias("line"),
            F.col("path_rank").alias("rank"),
            F.col("source_path").alias("path"),
            F.col("record_type").alias("type"),
        ),
    )


@session_cached
def _qs_struct() -> Column:
    return F.when(
        F.col("record_type") == fixed.QUICK_SEARCH,
        F.struct(
            F.col("line_number").alias("line"),
            F.col("path_rank").alias("rank"),
            F.col("source_path").alias("path"),
            F.col("event_date").alias("date"),
        ),
    )


@session_cached
def _start_struct() -> Column:
    return F.when(
        F.col("record_type") == fixed.SESSION_START,
        F.struct(
            F.col("line_number").alias("line"),
            F.col("path_rank").alias("rank"),
            F.col("source_path").alias("path"),
            F.col("event_date").alias("date"),
        ),
    )


def _carry_in(chunked: DataFrame) -> DataFrame:
    """Per chunk of a large session: the last control record and the last
    quick search before the chunk, and the session's first start.  A partial
    aggregate per chunk over the large sessions' rows only, then windows
    over the chunk summaries (few rows)."""
    summaries = (
        chunked.filter("large_session")
        .groupBy(SID, "chunk_line", "chunk_part")
        .agg(
            F.max(_control_struct()).alias("_ctl"),
            F.max(_qs_struct()).alias("_qs"),
            F.min(_start_struct()).alias("_start"),
        )
    )
    chunks = Window.partitionBy(SID).orderBy("chunk_line", "chunk_part")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    whole = chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return summaries.select(
        SID,
        "chunk_line",
        "chunk_part",
        F.last("_ctl", ignorenulls=True).over(before).alias("carry_ctl"),
        F.last("_qs", ignorenulls=True).over(before).alias("carry_qs"),
        F.min("_start").over(whole).alias("session_start"),
    )


_EVENT_COLUMNS = ("line_number", "source_path", "path_rank", "record_type", "event_date", "document_id", "document_ids", "hit")


def session_events(
    records: DataFrame,
    target: str = fixed.TARGET_DOCUMENT,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    sizes: DataFrame | None = None,
    max_listed: int = MAX_LISTED_SESSIONS,
) -> DataFrame:
    """A1, A3, A5: every relevant record with its session state.

    Output columns: source_file_id, line_number, source_path, path_rank,
    record_type, event_date, document_id, document_ids, hit, in_block,
    block_line, block_path (the card-search start that opened the block),
    qs_date (date of the last quick search before the row) and
    session_date (A2: date of the session's first start).

    ``sizes`` (see :func:`session_sizes`) may come from the line table;
    without it the sizes are counted on the records.  One plan: rows are
    exchanged once on (session, segment), a window scans each segment, and
    segments of large sessions start from their carry-in (see the module's
    notes on scale).
    """
    relevant = relevant_events(records, target)
    large = large_sessions(sizes if sizes is not None else session_sizes(relevant), chunk_rows, max_listed)
    segment = [SID, "chunk_line", "chunk_part"]
    chunked = _chunked(relevant, large)
    local = chunked.select(SID, *segment[1:], *_EVENT_COLUMNS, *_scan_exprs(*segment))
    return local.join(_carry_in(chunked), segment, "left").select(SID, *_EVENT_COLUMNS, *_state_exprs())


@session_cached
def _scan_exprs(*partition: str) -> list[Column]:
    """The scans over one window group (a session, or a chunk of one):
    last control record and last quick search before the row, first start
    of the group."""
    group = Window.partitionBy(*partition).orderBy("line_number", "path_rank", "source_path")
    before = group.rowsBetween(Window.unboundedPreceding, -1)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return [
        F.last(_control_struct(), ignorenulls=True).over(before).alias("_ctl"),
        F.last(_qs_struct(), ignorenulls=True).over(before).alias("_qs"),
        F.min(_start_struct()).over(whole).alias("_start"),
    ]


@session_cached
def _state_exprs() -> list[Column]:
    control = F.coalesce("_ctl", "carry_ctl")
    in_block = F.coalesce(control["type"] == fixed.CARD_SEARCH_START, F.lit(False))
    return [
        in_block.alias("in_block"),
        F.when(in_block, control["line"]).alias("block_line"),
        F.when(in_block, control["path"]).alias("block_path"),
        F.coalesce("_qs", "carry_qs")["date"].alias("qs_date"),
        F.coalesce("session_start", "_start")["date"].alias("session_date"),
    ]


def start_key(date: Column) -> Column:
    """Line number, path rank and date (yyyymmdd, 0 for an impossible one) of
    a record in one decimal, so that the first start of a session is a plain
    minimum, which Spark aggregates by hash."""
    code = F.coalesce(F.regexp_replace(date, "-", "").cast("int"), F.lit(0))
    place = F.expr(f"CAST(line_number AS DECIMAL(10, 0)) * {_RANK_MAX + 1}BD + CAST(path_rank AS DECIMAL(19, 0))")
    return (place.cast("decimal(29,0)") * F.lit(10**8).cast("decimal(9,0)") + code.cast("decimal(10,0)")).cast("decimal(38,0)")


def start_date(key: Column) -> Column:
    """The date of a :func:`start_key`; null for an impossible one."""
    code = F.lpad((key % F.lit(10**8).cast("decimal(9,0)")).cast("int").cast("string"), 8, "0")
    iso = F.concat_ws("-", F.substring(code, 1, 4), F.substring(code, 5, 2), F.substring(code, 7, 2))
    return F.when(code != "00000000", iso)


def session_dates(records: DataFrame) -> DataFrame:
    """A2: every session with a parsed record and the date of its first
    ``SESSION_START`` (null when that date is impossible, no later start is
    tried, or when there is no start).  One scan, one aggregate."""
    rt = F.col("record_type")
    key = F.when(rt == fixed.SESSION_START, start_key(extract_date("timestamp")))
    relevant = with_order_keys(records.filter(rt != fixed.UNPARSEABLE)).select(SID, key.alias("_key"))
    return relevant.groupBy(SID).agg(F.min("_key").alias("_key")).select(SID, start_date(F.col("_key")).alias("session_date"))


def quick_search_attribution(events: DataFrame) -> DataFrame:
    """A5 on result lines outside card blocks: the quick-search date each
    one is attributed to (null: none before it, or an impossible date)."""
    return events.filter((F.col("record_type") == fixed.SEARCH_RESULTS) & ~F.col("in_block")).select(
        SID, "line_number", "source_path", "qs_date"
    )
