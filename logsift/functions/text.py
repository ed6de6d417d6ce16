"""String column helpers shared by both parser dialects.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsift.functions import fixed


_TRIM_CHARS = "".join(chr(c) for c in range(0x21))  # U+0000..U+0020


def trim_ascii(col: Column) -> Column:
    """Strip characters U+0000..U+0020 from both ends (Java ``String.trim``):
    Spark's ``trim`` with that character set (no regex)."""
    return F.trim(col, F.lit(_TRIM_CHARS))


def trim_python(col: Column) -> Column:
    """Strip Python's whitespace (``str.strip()``) from both ends."""
    return F.trim(col, F.lit(fixed.PY_WHITESPACE))


def java_decoded(raw: Column) -> Column:
    """Text read from files, decoded the way a Java reader with the REPLACE
    action decodes it: malformed UTF-8 becomes U+FFFD under the JDK's rules
    (for example an encoded surrogate ``ED A0 80`` is one U+FFFD, where
    ``make_valid_utf8`` writes three).  A regex replace that never matches
    routes the bytes through a JVM string, which applies exactly those
    rules; valid text passes unchanged."""
    return F.regexp_replace(raw, r"\A\z", "")


def tokens(raw: Column, pattern: str = fixed.TOKEN_SPLIT) -> Column:
    """Split a trimmed line on runs of whitespace (Java ``\\s+`` by default)."""
    return F.split(raw, pattern)


def token(parts: Column, i: int) -> Column:
    """0-based token ``i``; null when the line is shorter (safe under ANSI)."""
    return F.get(parts, i)


def after_first_token(raw: Column, first: Column, trim=trim_ascii) -> Column:
    """The text after the first token, trimmed (used for card queries)."""
    return trim(F.substring(raw, F.length(first) + 1, 2147483647))


def after_two_tokens(raw: Column, pattern: str = r"(?s)^\S++\s++\S++\s++(.*)\z") -> Column:
    """Rest of a line after its first two whitespace-separated tokens."""
    return F.regexp_extract(raw, pattern, 1)


def document_ids(text: Column, pattern: str = fixed.DOC_ID) -> Column:
    """Every ``[A-Z]+_\\d+`` in the text, in order, duplicates kept."""
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def id_prefix(doc_id: Column) -> Column:
    """Part of an id before its first ``_`` (the whole id if none)."""
    return F.substring_index(doc_id, "_", 1)


_NOT_PRINTABLE = r"^[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\p{Zs}]\z"
_NEEDS_ESCAPE = r"[\\\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\p{Zs}]"


def python_quoted(text: Column) -> Column:
    """Show a token the way the profile report does (Python ``repr``):
    in single quotes, or double quotes when it holds a single quote and no
    double quote; backslashes and the quote in use are escaped, and
    characters that are not printable are written as ``\\xNN``,
    ``\\uNNNN`` or ``\\UNNNNNNNN``.  Works per code point."""
    double = text.contains("'") & ~text.contains('"')
    quote = F.when(double, F.lit('"')).otherwise(F.lit("'"))

    def escape(c: Column) -> Column:
        code = F.ascii(c)
        digits = F.lower(F.hex(code))
        return (
            F.when(c == "\\", F.lit("\\\\"))
            .when((c == "'") & ~double, F.lit("\\'"))
            .when((code < 0x20) | (code == 0x7F), F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
            .when(
                c.rlike(_NOT_PRINTABLE) & (c != " "),
                F.when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
                .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
                .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0"))),
            )
            .otherwise(c)
        )

    plain = ~text.rlike(_NEEDS_ESCAPE) & ~(text.contains("'") & text.contains('"'))
    body = F.when(plain, text).otherwise(F.array_join(F.transform(F.split(text, ""), escape), ""))
    return F.concat(quote, body, quote)
