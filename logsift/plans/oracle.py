"""DuckDB oracle: every registered query restated in plain SQL.

Written from the log grammar, not from the Spark expressions: tokens come
from ``string_split_regex``, dates from ``try_strptime``, and the session
state from ``ASOF`` joins (last control record / last quick search with a
smaller line number) instead of window scans.  Each query starts from the
same ``log_lines`` rendering of ``events`` that the Spark side uses.
"""

from __future__ import annotations

from logsift.functions import fixed
from logsift.sources.fixture_sql import log_lines_sql_for_duckdb

TARGET = fixed.TARGET_DOCUMENT
WS = r"[\t\n\x0B\f\r ]"
TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
TS_STD = r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}_[0-9]{2}:[0-9]{2}:[0-9]{2}"
TS_HTTP = r"(Mon|Tue|Wed|Thu|Fri|Sat|Sun),_([0-9]{1,2})_([A-Za-z]{3})_([0-9]{4})_[0-9]{2}:[0-9]{2}:[0-9]{2}_\+[0-9]{4}"
DOC = r"[A-Z]+_[0-9]+"
MONTHS = "(" + ", ".join(f"'{m}'" for m in fixed.MONTHS) + ")"
COMMANDS = "(" + ", ".join(f"'{c}'" for c in fixed.KNOWN_COMMANDS) + ")"


def _is_ts(c: str) -> str:
    return f"coalesce(regexp_full_match({c}, '{TS_STD}') OR regexp_full_match({c}, '{TS_HTTP}'), false)"


def _date(c: str) -> str:
    http_day = f"regexp_extract({c}, '^{TS_HTTP}$', 2)"
    http_mon = f"regexp_extract({c}, '^{TS_HTTP}$', 3)"
    http_year = f"regexp_extract({c}, '^{TS_HTTP}$', 4)"
    return (
        f"(CASE WHEN regexp_full_match({c}, '{TS_STD}') "
        f"THEN strftime(try_strptime(substr({c}, 1, 10), '%d.%m.%Y'), '%Y-%m-%d') "
        f"WHEN regexp_full_match({c}, '{TS_HTTP}') AND {http_mon} IN {MONTHS} "
        f"THEN strftime(try_strptime({http_day} || ' ' || {http_mon} || ' ' || {http_year}, '%d %b %Y'), '%Y-%m-%d') END)"
    )


def _trim(c: str) -> str:
    return f"regexp_replace({c}, '{TRIM}', '', 'g')"


def _quoted(c: str) -> str:
    esc = f"replace({c}, '\\', '\\\\')"
    return (
        f"(CASE WHEN contains({c}, '''') AND NOT contains({c}, '\"') THEN '\"' || {esc} || '\"' "
        f"ELSE '''' || replace({esc}, '''', '\\''') || '''' END)"
    )


# log_lines -> tokens (t0..t3 are the first four tokens, 0-based names)
_BASE = f"""WITH log_lines AS ({log_lines_sql_for_duckdb()}),
tk AS (
  SELECT source_file_id, line_number, line, raw, CAST(len(p) AS INTEGER) AS n,
         p[1] AS t0, p[2] AS t1, p[3] AS t2, p[4] AS t3, {_is_ts('p[2]')} AS t1ts
  FROM (SELECT *, string_split_regex(raw, '{WS}+') AS p
        FROM (SELECT source_file_id, line_number, line, {_trim('line')} AS raw FROM log_lines))),
cls AS (
  SELECT *,
    CASE
      WHEN regexp_full_match(t0, '-?[0-9]+') AND NOT t1ts THEN 'SEARCH_RESULTS'
      WHEN regexp_full_match(t0, '\\$[0-9]+') THEN 'CARD_SEARCH_QUERY'
      WHEN t0 NOT IN {COMMANDS} THEN 'UNPARSEABLE'
      WHEN t0 = 'CARD_SEARCH_END' THEN CASE WHEN n = 1 OR (n = 2 AND t1ts) THEN NULL ELSE 'UNPARSEABLE' END
      WHEN n < 2 THEN 'UNPARSEABLE'
      WHEN NOT t1ts THEN CASE WHEN t0 = 'DOC_OPEN' AND n >= 3 THEN 'DOCUMENT_OPEN_NO_TS' ELSE 'UNPARSEABLE' END
      WHEN t0 = 'SESSION_START' THEN 'SESSION_START'
      WHEN t0 = 'SESSION_END' THEN NULL
      WHEN t0 = 'CARD_SEARCH_START' THEN 'CARD_SEARCH_START'
      WHEN t0 = 'QS' THEN 'QUICK_SEARCH'
      WHEN n = 4 THEN 'DOCUMENT_OPEN'
      ELSE 'UNPARSEABLE' END AS record_type,
    CASE
      WHEN regexp_full_match(t0, '-?[0-9]+') AND NOT t1ts THEN NULL
      WHEN regexp_full_match(t0, '\\$[0-9]+') THEN NULL
      WHEN t0 NOT IN {COMMANDS} THEN 'unknown token: ' || t0
      WHEN t0 = 'CARD_SEARCH_END' THEN CASE WHEN n = 1 OR (n = 2 AND t1ts) THEN NULL ELSE 'CARD_SEARCH_END: unexpected tokens' END
      WHEN n < 2 THEN 'missing timestamp'
      WHEN NOT t1ts THEN CASE WHEN t0 = 'DOC_OPEN' AND n >= 3 THEN NULL ELSE 'invalid timestamp: ' || t1 END
      WHEN t0 <> 'DOC_OPEN' OR n = 4 THEN NULL
      ELSE 'DOC_OPEN: expected 4 tokens, got ' || CAST(n AS VARCHAR) END AS parse_error,
    {_trim('substr(raw, length(t0) + 1)')} AS rest
  FROM tk WHERE raw <> ''),
rec AS (
  SELECT record_type, source_file_id, line_number,
    CASE WHEN record_type IN ('SESSION_START','CARD_SEARCH_START','QUICK_SEARCH','DOCUMENT_OPEN') THEN t1 END AS timestamp,
    CASE WHEN record_type = 'CARD_SEARCH_QUERY' AND regexp_full_match(rest, '{DOC}') THEN rest
         WHEN record_type = 'DOCUMENT_OPEN' THEN t3
         WHEN record_type = 'DOCUMENT_OPEN_NO_TS' THEN t2 END AS document_id,
    CASE WHEN record_type = 'SEARCH_RESULTS' THEN regexp_extract_all(raw, '{DOC}') ELSE []::VARCHAR[] END AS document_ids,
    CASE WHEN record_type = 'CARD_SEARCH_QUERY' AND NOT regexp_full_match(rest, '{DOC}') AND rest <> '' THEN rest END AS query_text,
    parse_error,
    CASE WHEN record_type = 'UNPARSEABLE' THEN raw END AS raw_line
  FROM cls WHERE record_type IS NOT NULL)"""

# relevant records with their session state
_SESSION = _BASE + f""",
ev AS (
  SELECT *, {_date('timestamp')} AS event_date,
    (record_type IN ('CARD_SEARCH_QUERY','SEARCH_RESULTS')
     AND (coalesce(document_id = '{TARGET}', false) OR coalesce(contains(query_text, '{TARGET}'), false)
          OR list_contains(document_ids, '{TARGET}'))) AS hit
  FROM rec WHERE record_type <> 'UNPARSEABLE'),
ctl AS (SELECT source_file_id, line_number AS ctl_line, record_type AS ctl_type FROM ev
        WHERE record_type IN ('CARD_SEARCH_START','QUICK_SEARCH','SEARCH_RESULTS')),
qs AS (SELECT source_file_id, line_number AS qs_line, event_date AS qs_date FROM ev WHERE record_type = 'QUICK_SEARCH'),
st AS (
  SELECT e.*, c.ctl_line, coalesce(c.ctl_type = 'CARD_SEARCH_START', false) AS in_block, q.qs_date
  FROM ev e
  ASOF LEFT JOIN ctl c ON e.source_file_id = c.source_file_id AND e.line_number > c.ctl_line
  ASOF LEFT JOIN qs q ON e.source_file_id = q.source_file_id AND e.line_number > q.qs_line),
first_start AS (SELECT source_file_id, min(line_number) AS ss_line FROM ev WHERE record_type = 'SESSION_START' GROUP BY 1),
sd AS (
  SELECT s.source_file_id, e.event_date AS session_date
  FROM (SELECT DISTINCT source_file_id FROM ev) s
  LEFT JOIN first_start f ON f.source_file_id = s.source_file_id
  LEFT JOIN ev e ON e.source_file_id = f.source_file_id AND e.line_number = f.ss_line AND e.record_type = 'SESSION_START'),
hits AS (SELECT DISTINCT source_file_id, ctl_line FROM st WHERE in_block AND hit),
qpairs AS (
  SELECT DISTINCT source_file_id, date, document_id FROM (
    SELECT source_file_id, qs_date AS date, unnest(document_ids) AS document_id FROM st
    WHERE record_type = 'SEARCH_RESULTS' AND NOT in_block AND qs_date IS NOT NULL)),
qsd AS (SELECT DISTINCT date, document_id FROM qpairs),
op AS (
  SELECT source_file_id, event_date AS date, document_id FROM ev
  WHERE record_type = 'DOCUMENT_OPEN' AND event_date IS NOT NULL AND document_id IS NOT NULL
  UNION ALL
  SELECT e.source_file_id, d.session_date, e.document_id FROM ev e JOIN sd d ON d.source_file_id = e.source_file_id
  WHERE e.record_type = 'DOCUMENT_OPEN_NO_TS' AND d.session_date IS NOT NULL AND e.document_id IS NOT NULL),
dopen AS (SELECT date, document_id, CAST(count(*) AS BIGINT) AS open_count FROM op GROUP BY 1, 2)"""

# profile dialect records
_PROFILE = f"""WITH log_lines AS ({log_lines_sql_for_duckdb()}),
tk AS (
  SELECT source_file_id, line_number, line, raw, CAST(len(p) AS INTEGER) AS n,
         p[1] AS t0, p[2] AS t1, p[3] AS t2, p[4] AS t3, {_is_ts('p[2]')} AS t1ts,
         regexp_extract(raw, '(?s)^[^\\t\\n\\x0B\\f\\r ]+{WS}+[^\\t\\n\\x0B\\f\\r ]+{WS}+(.*)$', 1) AS tail2
  FROM (SELECT *, string_split_regex(raw, '{WS}+') AS p
        FROM (SELECT source_file_id, line_number, line, {_trim('line')} AS raw FROM log_lines))),
pc AS (
  SELECT *,
    CASE
      WHEN raw = '' THEN 'EMPTY'
      WHEN regexp_full_match(t0, '-?[0-9]+') AND NOT t1ts THEN 'SEARCH_RESULTS'
      WHEN regexp_matches(t0, '^\\$[0-9]+') THEN 'CARD_SEARCH_QUERY'
      WHEN t0 NOT IN {COMMANDS} THEN 'UNPARSEABLE'
      WHEN t0 = 'CARD_SEARCH_END' THEN CASE WHEN n = 1 OR (n = 2 AND t1ts) THEN 'CARD_SEARCH_END' ELSE 'UNPARSEABLE' END
      WHEN n < 2 THEN 'UNPARSEABLE'
      WHEN NOT t1ts THEN CASE WHEN t0 = 'DOC_OPEN' AND n >= 3 THEN 'DOCUMENT_OPEN_NO_TS' ELSE 'UNPARSEABLE' END
      WHEN t0 IN ('SESSION_START','SESSION_END','CARD_SEARCH_START') THEN t0
      WHEN t0 = 'QS' THEN 'QUICK_SEARCH'
      WHEN n = 4 THEN 'DOCUMENT_OPEN'
      WHEN n = 3 THEN 'DOCUMENT_OPEN_NO_TS'
      ELSE 'UNPARSEABLE' END AS record_type,
    CASE
      WHEN raw = '' THEN NULL
      WHEN regexp_full_match(t0, '-?[0-9]+') AND NOT t1ts THEN NULL
      WHEN regexp_matches(t0, '^\\$[0-9]+') THEN NULL
      WHEN t0 NOT IN {COMMANDS} THEN 'unknown command: ' || {_quoted('t0')}
      WHEN t0 = 'CARD_SEARCH_END' THEN CASE WHEN n = 1 OR (n = 2 AND t1ts) THEN NULL ELSE 'CARD_SEARCH_END with unexpected tokens' END
      WHEN n < 2 THEN 'missing timestamp'
      WHEN NOT t1ts THEN CASE WHEN t0 = 'DOC_OPEN' AND n >= 3 THEN NULL ELSE 'invalid timestamp: ' || {_quoted('t1')} END
      WHEN t0 <> 'DOC_OPEN' OR n IN (3, 4) THEN NULL
      ELSE 'DOC_OPEN token count=' || CAST(n AS VARCHAR) END AS parse_error,
    {_trim('substr(raw, length(t0) + 1)')} AS rest
  FROM tk),
pq AS (
  SELECT *, regexp_matches(tail2, '^\\{{[^}}]*\\}}') AS braced,
    {_trim(f"regexp_extract(tail2, '(?s)^\\{{[^}}]*\\}}{WS}*(.*)$', 1)")} AS qtail
  FROM pc),
prec AS (
  SELECT source_file_id, line_number, record_type, line AS raw, parse_error,
    CASE WHEN record_type IN ('SESSION_START','SESSION_END','CARD_SEARCH_START','QUICK_SEARCH','DOCUMENT_OPEN')
              OR (record_type = 'CARD_SEARCH_END' AND n = 2) THEN t1 END AS timestamp,
    CASE WHEN record_type = 'SEARCH_RESULTS' THEN t0 WHEN record_type = 'DOCUMENT_OPEN' THEN t2
         WHEN record_type = 'DOCUMENT_OPEN_NO_TS' THEN t1 END AS search_id,
    CASE WHEN record_type = 'SEARCH_RESULTS' THEN regexp_extract_all(raw, '{DOC}') END AS document_ids,
    CASE WHEN record_type = 'SEARCH_RESULTS' THEN CAST(len(regexp_extract_all(raw, '{DOC}')) AS INTEGER) END AS document_count,
    CASE WHEN record_type = 'CARD_SEARCH_QUERY' THEN t0 END AS card_param,
    CASE WHEN record_type = 'CARD_SEARCH_QUERY' AND regexp_full_match(rest, '{DOC}') THEN rest
         WHEN record_type = 'DOCUMENT_OPEN' THEN t3 WHEN record_type = 'DOCUMENT_OPEN_NO_TS' THEN t2 END AS document_id,
    CASE WHEN record_type = 'CARD_SEARCH_QUERY' AND NOT regexp_full_match(rest, '{DOC}') AND rest <> '' THEN rest
         WHEN record_type = 'QUICK_SEARCH' AND braced THEN regexp_extract(tail2, '^\\{{([^}}]*)\\}}', 1) END AS query_text,
    CASE WHEN record_type = 'CARD_SEARCH_START' AND tail2 <> '' THEN tail2 END AS params,
    CASE WHEN record_type = 'QUICK_SEARCH' AND NOT braced THEN tail2 END AS query_raw,
    CASE WHEN record_type = 'QUICK_SEARCH' AND braced AND qtail <> '' THEN regexp_extract_all(qtail, '{DOC}') END AS document_ids_inline,
    CASE WHEN record_type = 'QUICK_SEARCH' AND braced AND qtail <> '' THEN qtail END AS tail_raw
  FROM pq)"""

def _sql_row(*values: str) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_FORMATS = f"""(
  SELECT f.record_type, f.pattern, nullif(f.note, '') AS note,
         coalesce(string_agg(d.name || ': ' || d.text, '; ' ORDER BY d.place), '') AS fields
  FROM (VALUES {", ".join(_sql_row(*r) for r in fixed.RECORD_FORMATS)}) AS f(record_type, pattern, note)
  LEFT JOIN (SELECT *, row_number() OVER () AS place
             FROM (VALUES {", ".join(_sql_row(*r) for r in fixed.RECORD_FIELDS)}) AS v(record_type, name, text)) AS d
  ON d.record_type = f.record_type GROUP BY 1, 2, 3) AS f"""

_FILE_ORDER = "length(source_file_id), source_file_id, line_number"

ORACLE_SQL: dict[str, str] = {
    "parsed_records": _BASE + """
SELECT record_type, source_file_id, line_number, timestamp, document_id, array_to_string(document_ids, ' ') AS document_ids,
       query_text, parse_error, raw_line FROM rec""",
    "document_lines": r"""
SELECT source_file_id, CAST(pos AS INTEGER) AS line_number, line FROM (
  SELECT CAST(doc_id AS VARCHAR) AS source_file_id, len(pieces) AS n,
         unnest(pieces) AS line, generate_subscripts(pieces, 1) AS pos
  FROM (SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS pieces FROM documents))
WHERE NOT (pos = n AND line = '')""",
    "line_tokens": _BASE + """
SELECT source_file_id, line_number, raw, n AS n_tokens, t0 AS first_token FROM tk WHERE raw <> ''""",
    "timestamps_dates": _BASE + f"""
SELECT source_file_id, line_number, t1 AS token, t1ts AS is_timestamp, {_date('t1')} AS event_date
FROM tk WHERE raw <> '' AND t1 IS NOT NULL""",
    "document_mentions": _BASE + f"""
SELECT document_id, CAST(count(*) AS BIGINT) AS mentions
FROM (SELECT unnest(regexp_extract_all(raw, '{DOC}')) AS document_id FROM tk WHERE raw <> '') GROUP BY 1""",
    "search_results": _BASE + """
SELECT source_file_id, line_number, array_to_string(document_ids, ' ') AS document_ids,
       CAST(len(document_ids) AS INTEGER) AS n_documents FROM rec WHERE record_type = 'SEARCH_RESULTS'""",
    "card_queries": _BASE + """
SELECT source_file_id, line_number, document_id, query_text FROM rec WHERE record_type = 'CARD_SEARCH_QUERY'""",
    "document_opens_lines": _BASE + f"""
SELECT source_file_id, line_number, record_type, timestamp, document_id, {_date('timestamp')} AS event_date
FROM rec WHERE record_type IN ('DOCUMENT_OPEN', 'DOCUMENT_OPEN_NO_TS')""",
    "unparseable_lines": _BASE + """
SELECT source_file_id, line_number, parse_error, raw_line FROM rec WHERE record_type = 'UNPARSEABLE'""",
    "session_dates": _SESSION + """
SELECT source_file_id, session_date FROM sd""",
    "card_blocks": _SESSION + """
SELECT source_file_id, block_start_line, bool_or(hit) AS hit FROM (
  SELECT source_file_id, line_number AS block_start_line, false AS hit FROM st WHERE record_type = 'CARD_SEARCH_START'
  UNION ALL
  SELECT source_file_id, ctl_line, hit FROM st WHERE in_block AND record_type IN ('CARD_SEARCH_QUERY', 'SEARCH_RESULTS'))
GROUP BY 1, 2""",
    "card_search_count": _SESSION + f"""
SELECT '{TARGET}' AS document_id, CAST(count(*) AS BIGINT) AS card_search_count FROM hits""",
    "quick_search_attribution": _SESSION + """
SELECT source_file_id, line_number, qs_date FROM st WHERE record_type = 'SEARCH_RESULTS' AND NOT in_block""",
    "quick_search_docs": _SESSION + """
SELECT date, document_id FROM qsd""",
    "document_opens": _SESSION + """
SELECT date, document_id, open_count FROM dopen""",
    "session_summary": _SESSION + """
SELECT s.source_file_id,
  CAST(coalesce(h.n, 0) AS BIGINT) AS card_hits,
  CAST(coalesce(q.n, 0) AS BIGINT) AS quick_search_docs,
  CAST(coalesce(o.n, 0) AS BIGINT) AS opens
FROM (SELECT DISTINCT source_file_id FROM ev) s
LEFT JOIN (SELECT source_file_id, count(*) AS n FROM hits GROUP BY 1) h ON h.source_file_id = s.source_file_id
LEFT JOIN (SELECT source_file_id, count(*) AS n FROM qpairs GROUP BY 1) q ON q.source_file_id = s.source_file_id
LEFT JOIN (SELECT source_file_id, count(*) AS n FROM op GROUP BY 1) o ON o.source_file_id = s.source_file_id""",
    "quick_search_opens": _SESSION + """
SELECT date, document_id, open_count FROM dopen o
WHERE EXISTS (SELECT 1 FROM qsd q WHERE q.date = o.date AND q.document_id = o.document_id)""",
    "profile_records": _PROFILE + """
SELECT source_file_id, line_number, record_type, raw, parse_error, timestamp, search_id,
  array_to_string(document_ids, ' ') AS document_ids, coalesce(document_count, 0) AS document_count, card_param, document_id, query_text,
  params, query_raw, array_to_string(document_ids_inline, ' ') AS document_ids_inline, tail_raw FROM prec""",
    "profile_summary": _PROFILE + f"""
SELECT
  count(DISTINCT CASE WHEN record_type <> 'EMPTY' THEN source_file_id END) AS files_processed,
  count(*) FILTER (WHERE record_type <> 'EMPTY') AS total_events,
  count(*) FILTER (WHERE record_type = 'EMPTY') AS empty_lines,
  count(*) FILTER (WHERE record_type = 'UNPARSEABLE') AS unparseable_lines,
  count(*) FILTER (WHERE record_type = 'QUICK_SEARCH' AND query_text IS NOT NULL AND {_trim('query_text')} = '') AS qs_empty_query,
  count(*) FILTER (WHERE record_type = 'QUICK_SEARCH' AND coalesce(regexp_full_match(timestamp, '{TS_HTTP}'), false)) AS timestamp_http_format_lines,
  count(*) FILTER (WHERE record_type = 'QUICK_SEARCH' AND coalesce(len(document_ids_inline), 0) > 0) AS qs_inline_doc_ids,
  count(*) FILTER (WHERE record_type = 'SEARCH_RESULTS' AND starts_with(search_id, '-')) AS negative_search_id_lines,
  count(*) FILTER (WHERE record_type = 'DOCUMENT_OPEN') AS doc_open_with_ts,
  count(*) FILTER (WHERE record_type = 'DOCUMENT_OPEN_NO_TS') AS doc_open_no_ts,
  count(*) FILTER (WHERE record_type = 'CARD_SEARCH_QUERY' AND document_id IS NOT NULL) AS card_query_with_doc_id
FROM prec""",
    "profile_record_types": _PROFILE + f"""
SELECT c.record_type, c.records, 100.0::DOUBLE * c.records / sum(c.records) OVER () AS percent,
       coalesce(f.pattern, '—') AS pattern, f.fields, f.note
FROM (SELECT record_type, count(*) AS records FROM prec WHERE record_type <> 'EMPTY' GROUP BY 1) c
LEFT JOIN {_FORMATS} ON f.record_type = c.record_type""",
    "profile_parse_errors": _PROFILE + """
SELECT parse_error, count(*) AS count FROM prec WHERE parse_error IS NOT NULL GROUP BY 1""",
    "profile_card_params": _PROFILE + """
SELECT card_param, count(*) AS count FROM prec WHERE record_type = 'CARD_SEARCH_QUERY' GROUP BY 1""",
    "profile_result_sizes": _PROFILE + """
SELECT document_count, count(*) AS count FROM prec WHERE record_type = 'SEARCH_RESULTS'
GROUP BY 1 ORDER BY count DESC, document_count LIMIT 20""",
    "profile_date_tokens": _PROFILE + """
SELECT split_part(timestamp, '_', 1) AS date_token, count(*) AS count FROM prec WHERE timestamp IS NOT NULL
GROUP BY 1 ORDER BY count DESC, date_token LIMIT 20""",
    "profile_doc_prefixes": _PROFILE + """
SELECT split_part(doc_id, '_', 1) AS prefix, count(*) AS count
FROM (SELECT unnest(list_concat(coalesce(document_ids, []::VARCHAR[]),
             CASE WHEN document_id IS NOT NULL THEN [document_id] ELSE []::VARCHAR[] END)) AS doc_id FROM prec)
GROUP BY 1 ORDER BY count DESC, prefix LIMIT 30""",
    "profile_commands": _PROFILE + """
SELECT CASE record_type WHEN 'QUICK_SEARCH' THEN 'QS' WHEN 'SEARCH_RESULTS' THEN 'NUMERIC_COMMAND'
            WHEN 'DOCUMENT_OPEN' THEN 'DOC_OPEN' WHEN 'DOCUMENT_OPEN_NO_TS' THEN 'DOC_OPEN' ELSE record_type END AS command,
       count(*) AS total_occurrences
FROM prec WHERE record_type <> 'EMPTY' GROUP BY 1""",
    "profile_unparseable_samples": _PROFILE + f"""
SELECT source_file_id, line_number, substr(raw, 1, 200) AS line, parse_error AS error
FROM prec WHERE record_type = 'UNPARSEABLE' ORDER BY {_FILE_ORDER} LIMIT 20""",
    "profile_type_samples": _PROFILE + f"""
SELECT record_type, sample_rank, source_file_id, line_number, substr(raw, 1, 160) AS raw FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY record_type ORDER BY {_FILE_ORDER}) AS INTEGER) AS sample_rank FROM prec WHERE record_type <> 'EMPTY')
WHERE sample_rank <= 2""",
    "profile_counts": _PROFILE + f"""
SELECT section, key, count(*) AS count FROM (
  SELECT 'record_type' AS section, record_type AS key FROM prec
  UNION ALL SELECT 'parse_error', parse_error FROM prec WHERE parse_error IS NOT NULL
  UNION ALL SELECT 'card_param', card_param FROM prec WHERE record_type = 'CARD_SEARCH_QUERY'
  UNION ALL SELECT 'document_count', CAST(document_count AS VARCHAR) FROM prec WHERE record_type = 'SEARCH_RESULTS'
  UNION ALL SELECT 'date_token', split_part(timestamp, '_', 1) FROM prec WHERE timestamp IS NOT NULL
  UNION ALL SELECT 'doc_prefix', split_part(doc_id, '_', 1) FROM (SELECT unnest(document_ids) AS doc_id FROM prec)
  UNION ALL SELECT 'doc_prefix', split_part(document_id, '_', 1) FROM prec WHERE document_id IS NOT NULL
  UNION ALL SELECT 'file', source_file_id FROM prec WHERE record_type <> 'EMPTY'
  UNION ALL SELECT 'flag', 'qs_empty_query' FROM prec WHERE record_type = 'QUICK_SEARCH' AND query_text IS NOT NULL AND {_trim('query_text')} = ''
  UNION ALL SELECT 'flag', 'timestamp_http_format_lines' FROM prec WHERE record_type = 'QUICK_SEARCH' AND coalesce(regexp_full_match(timestamp, '{TS_HTTP}'), false)
  UNION ALL SELECT 'flag', 'qs_inline_doc_ids' FROM prec WHERE record_type = 'QUICK_SEARCH' AND coalesce(len(document_ids_inline), 0) > 0
  UNION ALL SELECT 'flag', 'negative_search_id_lines' FROM prec WHERE record_type = 'SEARCH_RESULTS' AND starts_with(search_id, '-')
  UNION ALL SELECT 'flag', 'card_query_with_doc_id' FROM prec WHERE record_type = 'CARD_SEARCH_QUERY' AND document_id IS NOT NULL)
GROUP BY 1, 2""",
    "file_scan_roundtrip": _BASE + """
SELECT source_file_id, line_number, line FROM log_lines""",
}
