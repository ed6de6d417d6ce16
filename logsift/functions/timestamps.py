"""Timestamp recognition and date extraction as column expressions.

Two token shapes are timestamps: ``dd.MM.yyyy_HH:mm:ss`` and
``Mon,_d_Mon_yyyy_HH:mm:ss_+ZZZZ``.  Recognition checks the shape only;
the date is kept only when it is a real calendar date (proleptic
Gregorian, year 0000 allowed) and returned as an ISO ``yyyy-MM-dd``
string.  Times and offsets are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsift.functions import fixed
from logsift.functions.cache import session_cached


def is_timestamp(tok: Column | str) -> Column:
    """True when the token has either timestamp shape; null token -> false.
    A column name gives an expression reused within the application."""
    if isinstance(tok, str):
        return _is_timestamp_named(tok)
    return F.coalesce(tok.rlike(fixed.TS_STANDARD) | tok.rlike(fixed.TS_HTTP), F.lit(False))


@session_cached
def _is_timestamp_named(name: str) -> Column:
    return is_timestamp(F.col(name))


def extract_date(tok: Column | str) -> Column:
    """ISO date string of a timestamp token, null for impossible dates,
    unknown (case-sensitive) month names or tokens of neither shape.

    The ISO text is assembled from the matched groups with string
    functions only, then kept when it is a real calendar date: Spark's
    date parser rejects impossible days without throwing and accepts year
    0000, as the log format's date rules do.  A column name gives an
    expression reused within the application."""
    if isinstance(tok, str):
        return _extract_date_named(tok)
    std_iso = F.concat_ws(
        "-",
        F.regexp_extract(tok, fixed.TS_STANDARD, 3),
        F.regexp_extract(tok, fixed.TS_STANDARD, 2),
        F.regexp_extract(tok, fixed.TS_STANDARD, 1),
    )
    month = F.array_position(F.array(*[F.lit(m) for m in fixed.MONTHS]), F.regexp_extract(tok, fixed.TS_HTTP, 3))
    http_iso = F.concat_ws(
        "-",
        F.regexp_extract(tok, fixed.TS_HTTP, 4),
        F.lpad(month.cast("string"), 2, "0"),
        F.lpad(F.regexp_extract(tok, fixed.TS_HTTP, 2), 2, "0"),
    )
    iso = F.when(tok.rlike(fixed.TS_STANDARD), std_iso).when(tok.rlike(fixed.TS_HTTP), http_iso)
    return F.when(iso.try_cast("date").isNotNull(), iso)


@session_cached
def _extract_date_named(name: str) -> Column:
    return extract_date(F.col(name))


def is_timestamp_profile(tok: Column | str) -> Column:
    """Timestamp shape as the profile dialect tests it (Unicode digits)."""
    if isinstance(tok, str):
        return _is_timestamp_profile_named(tok)
    return F.coalesce(tok.rlike(fixed.P_TS_STANDARD) | tok.rlike(fixed.P_TS_HTTP), F.lit(False))


@session_cached
def _is_timestamp_profile_named(name: str) -> Column:
    return is_timestamp_profile(F.col(name))


def date_token(tok: Column) -> Column:
    """Part of a timestamp before its first ``_`` (profile date-format key)."""
    return F.substring_index(tok, "_", 1)


def is_http_timestamp_profile(tok: Column) -> Column:
    """HTTP-style timestamp shape, profile dialect (Unicode digits)."""
    return F.coalesce(tok.rlike(fixed.P_TS_HTTP), F.lit(False))
