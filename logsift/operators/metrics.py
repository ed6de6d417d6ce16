"""Card-search and quick-search-open metrics.

Everything here is an aggregate over :func:`session_events` or over the
records directly; aggregates are partial (map-side) first, so a hot key
is collapsed before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.functions import fixed
from logsift.functions.fence import fence
from logsift.functions.timestamps import extract_date
from logsift.operators.sessions import SID, start_date, start_key, with_order_keys

_BLOCK = [SID, "block_line", "block_path"]


def card_blocks(events: DataFrame) -> DataFrame:
    """A3/A4: every card-search block and whether it touched the target.

    A block is the card-search start plus the queries after it and the
    first result line that closes it.  One pass: each start and each block
    member names its block, then a partial aggregate per block.  Columns:
    source_file_id, block_start_line, block_path, hit.
    """
    rt = F.col("record_type")
    is_start = rt == fixed.CARD_SEARCH_START
    member = F.col("in_block") & rt.isin(fixed.CARD_SEARCH_QUERY, fixed.SEARCH_RESULTS)
    return (
        events.filter(is_start | member)
        .select(
            SID,
            F.when(is_start, F.col("line_number")).otherwise(F.col("block_line")).alias("block_start_line"),
            F.when(is_start, F.col("source_path")).otherwise(F.col("block_path")).alias("block_path"),
            (~is_start & F.col("hit")).alias("hit"),
        )
        .groupBy(SID, "block_start_line", "block_path")
        .agg(F.max("hit").alias("hit"))
    )


def hit_blocks(events: DataFrame) -> DataFrame:
    """Distinct blocks that touched the target (source_file_id, block)."""
    return events.filter(F.col("in_block") & F.col("hit")).select(*_BLOCK).distinct()


def card_search_count(events: DataFrame, target: str = fixed.TARGET_DOCUMENT) -> DataFrame:
    """G1 (Task 1): one row (document_id, card_search_count); 0 on empty input."""
    return hit_blocks(events).agg(F.count(F.lit(1)).alias("card_search_count")).select(
        F.lit(target).alias("document_id"), "card_search_count"
    )


def quick_search_pairs(events: DataFrame) -> DataFrame:
    """A6 per session: (source_file_id, date, document_id) of every id on a
    result line outside a card block, dated by the last quick search."""
    rt = F.col("record_type")
    return events.filter((rt == fixed.SEARCH_RESULTS) & ~F.col("in_block") & F.col("qs_date").isNotNull()).select(
        SID, F.col("qs_date").alias("date"), F.explode("document_ids").alias("document_id")
    )


def quick_search_docs(events: DataFrame) -> DataFrame:
    """A6 + G2: distinct (date, document_id) shown by quick search."""
    return quick_search_pairs(events).select("date", "document_id").distinct()


def document_opens(records: DataFrame) -> DataFrame:
    """A7 + G3: opens per (date, document_id) over all sessions, straight
    from the records (no session window needed).

    One scan and one aggregate: timestamped opens per (date, document);
    opens without a date per (session, document), since they take their
    session's date; and each session's first start.  All three are read off
    the exchange of that aggregate.  A session's one start row is then
    joined to its opens, where adaptive execution splits a session that
    holds too many.  Opens with no date are not counted."""
    rt = F.col("record_type")
    opened = F.col("document_id").isNotNull()
    own = F.when(rt.isin(fixed.DOCUMENT_OPEN, fixed.SESSION_START), extract_date("timestamp"))
    timed = (rt == fixed.DOCUMENT_OPEN) & opened
    untimed = (rt == fixed.DOCUMENT_OPEN_NO_TS) & opened
    start = rt == fixed.SESSION_START
    facts = with_order_keys(records.filter(timed | untimed | start)).withColumn("_own", own)
    grouped = (
        facts.select(
            F.when(rt != fixed.DOCUMENT_OPEN, F.col(SID)).alias("_session"),
            F.when(rt == fixed.DOCUMENT_OPEN, F.col("_own")).alias("_date"),
            F.when(~start, F.col("document_id")).alias("document_id"),
            F.when(start, start_key(F.col("_own"))).alias("_key"),
            F.when(start, 0).otherwise(1).alias("_open"),
        )
        .filter(F.col("_session").isNotNull() | F.col("_date").isNotNull())
        .groupBy("_session", "_date", "document_id")
        .agg(F.sum("_open").alias("n"), F.min("_key").alias("_key"))
    )
    grouped = fence(grouped)  # the filters below stay above the aggregate, so its exchange is shared
    dated = grouped.filter("_session is null").select(F.col("_date").alias("date"), "document_id", "n")
    starts = grouped.filter("_session is not null and document_id is null").select(
        F.col("_session").alias("_started"), start_date(F.col("_key")).alias("date")
    )
    undated = grouped.filter("_session is not null and document_id is not null")
    taken = undated.join(starts.filter("date is not null"), F.col("_session") == F.col("_started"))
    return (
        dated.unionByName(taken.select("date", "document_id", "n"))
        .groupBy("date", "document_id")
        .agg(F.sum("n").cast("long").alias("open_count"))
    )


def _fact_flags() -> tuple[Column, Column, Column]:
    """``shown``: a result line outside a card block with a quick-search
    date; ``opened``: a dated open (own date, else the session date); and
    that open's date.  A row is at most one of the two (different types)."""
    rt = F.col("record_type")
    shown = (rt == fixed.SEARCH_RESULTS) & ~F.col("in_block") & F.col("qs_date").isNotNull()
    open_date = F.when(rt == fixed.DOCUMENT_OPEN, F.col("event_date")).when(
        rt == fixed.DOCUMENT_OPEN_NO_TS, F.col("session_date")
    )
    opened = open_date.isNotNull() & F.col("document_id").isNotNull()
    return shown, opened, open_date


def _shown_and_opened(events: DataFrame) -> DataFrame:
    """One row per (date, document) fact of a session: every id of a shown
    result line, dated by its quick search, and every dated open.  A plain
    ``explode`` (code-generated), with date and flag taken from the row."""
    shown, opened, open_date = _fact_flags()
    ids = F.when(shown, F.col("document_ids")).otherwise(F.array("document_id"))
    return events.filter(shown | opened).select(
        SID,
        F.when(shown, F.col("qs_date")).otherwise(open_date).alias("date"),
        (~shown).alias("opened"),
        F.explode(ids).alias("document_id"),
    )


def quick_search_opens(events: DataFrame) -> DataFrame:
    """G4 + G5 + G7 (Task 2): opens of documents that quick search showed on
    the same date, in any session; sorted by (date, document_id).

    The semi-join of distinct shown pairs with summed opens is one
    aggregate over (date, document): a pair is kept when it was shown and
    opened.  Partial aggregation collapses hot pairs before the shuffle."""
    return (
        _shown_and_opened(events)
        .groupBy("date", "document_id")
        .agg(
            F.count(F.when(F.col("opened"), F.lit(1))).alias("open_count"),
            F.max(~F.col("opened")).alias("_shown"),
        )
        .filter(F.col("_shown") & (F.col("open_count") > 0))
        .select("date", "document_id", "open_count")
        .orderBy("date", "document_id")
    )


def session_summary(events: DataFrame) -> DataFrame:
    """Per session with a parsed record: target hits (distinct blocks),
    distinct quick-search (date, document) pairs and counted opens.

    One pass over the session events: every row emits its keys (a hit
    block, shown pairs, an open, or nothing), then two plain aggregates,
    per (session, kind, key) and per session.  Both group by the session
    id first, so on the window's session partitioning they need no
    shuffle; with chunked large sessions Spark adds partial-aggregated
    exchanges."""
    shown, opened, _ = _fact_flags()
    hit_block = F.col("in_block") & F.col("hit")
    kind = F.when(shown, "pair").when(opened, "open").when(hit_block, "block").otherwise("none")
    # shown lines give one key per id; every other row exactly one key
    elements = F.when(shown, F.col("document_ids")).otherwise(F.array(F.lit(None).cast("string")))
    keys = events.select(
        SID,
        kind.alias("kind"),
        F.when(kind == "block", F.col("block_line")).alias("n"),
        F.when(kind == "pair", F.col("qs_date")).when(kind == "block", F.col("block_path")).alias("a"),
        F.when(kind == "open", 1).otherwise(0).alias("opens"),
        F.explode(elements).alias("b"),
    )
    kind = F.col("kind")
    return (
        keys.groupBy(SID, "kind", "n", "a", "b")
        .agg(F.sum("opens").alias("opens"))
        .groupBy(SID)
        .agg(
            F.count(F.when(kind == "block", F.lit(1))).cast("long").alias("card_hits"),
            F.count(F.when(kind == "pair", F.lit(1))).cast("long").alias("quick_search_docs"),
            F.coalesce(F.sum(F.when(kind == "open", F.col("opens"))), F.lit(0)).cast("long").alias("opens"),
        )
    )
