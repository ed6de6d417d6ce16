"""SQL that renders the driver's ``events`` table as session log lines.

Test data, not part of the engine: one session per ``user_id``, lines in
``(ts, event_id)`` order.  The same text runs in Spark (``events`` bound
to a DataFrame argument) and in DuckDB (``events`` a view), so every oracle starts
from identical ``log_lines``.  Every line shape of the grammar, every
error text and both timestamp shapes occur in it.
"""

LOG_LINES_FROM_EVENTS = r"""
WITH e AS (
 SELECT user_id, event_id, event_type,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS line_number,
  lpad(CAST(day(ts) AS STRING),2,'0')||'.'||lpad(CAST(month(ts) AS STRING),2,'0')||'.'||CAST(year(ts) AS STRING)||'_'||
  lpad(CAST(hour(ts) AS STRING),2,'0')||':'||lpad(CAST(minute(ts) AS STRING),2,'0')||':'||lpad(CAST(second(ts) AS STRING),2,'0') AS d,
  substr(dayname(ts),1,3)||',_'||CAST(day(ts) AS STRING)||'_'||substr(monthname(ts),1,3)||'_'||CAST(year(ts) AS STRING)||'_'||
  lpad(CAST(hour(ts) AS STRING),2,'0')||':'||lpad(CAST(minute(ts) AS STRING),2,'0')||':'||lpad(CAST(second(ts) AS STRING),2,'0')||'_+0300' AS h,
  CASE WHEN event_id%3=0 THEN '-' ELSE '' END||CAST(100000+event_id AS STRING) AS sid,
  CASE event_id%4 WHEN 0 THEN 'LAW_' ELSE 'ACC_' END||CAST(45610+(event_id*7)%12 AS STRING) AS d1,
  'ACC_'||CAST(45610+(event_id*5)%11 AS STRING) AS d2,
  'PBI_'||CAST(45610+(event_id*3)%10 AS STRING) AS d3
 FROM events)
SELECT CAST(user_id AS STRING) AS source_file_id, line_number,
 CASE
  WHEN line_number=1 AND user_id%7<>0 THEN 'SESSION_START '||CASE WHEN user_id%5=0 THEN h ELSE d END
  WHEN event_type='view' THEN CASE event_id%8
     WHEN 0 THEN 'DOC_OPEN  '||sid||' '||d1
     WHEN 1 THEN 'DOC_OPEN '||h||' '||sid||' '||d1
     WHEN 2 THEN 'DOC_OPEN '||d||' '||sid
     WHEN 3 THEN 'DOC_OPEN 31.02.2024_10:00:00 '||sid||' '||d1
     ELSE 'DOC_OPEN '||d||' '||sid||' '||d1 END
  WHEN event_type='click' THEN CASE WHEN event_id%16=5 THEN sid||' '||d ELSE sid||' '||d1||' '||d2||' '||d3 END
  WHEN event_type='purchase' THEN CASE
     WHEN event_id%13=0 THEN 'QS bad'
     WHEN event_id%11=0 THEN 'QS '||d||' {tax} '||d1||' '||d2
     WHEN event_id%7=0 THEN 'QS '||h||' {tax}'
     WHEN event_id%5=0 THEN 'QS '||d||' {}'
     WHEN event_id%17=0 THEN 'QS 30.02.2024_10:00:00 {tax}'
     WHEN event_id%19=0 THEN 'QS '||d||' no braces'
     ELSE '  QS '||d||' {tax  code}  ' END
  WHEN event_type='signup' THEN CASE event_id%10
     WHEN 0 THEN '$0 '||d1
     WHEN 1 THEN '$134 note '||d2||'0 more'
     WHEN 2 THEN '$134'
     WHEN 3 THEN '$12x '||d1
     WHEN 4 THEN '$0 '||d2
     WHEN 5 THEN 'CARD_SEARCH_START '||d||' p1 p2'
     ELSE 'CARD_SEARCH_START '||d END
  ELSE CASE event_id%12
     WHEN 0 THEN '' WHEN 1 THEN 'CARD_SEARCH_END' WHEN 2 THEN 'CARD_SEARCH_END '||d
     WHEN 3 THEN 'CARD_SEARCH_END x y' WHEN 4 THEN 'SESSION_END '||d WHEN 5 THEN 'QS'
     WHEN 6 THEN 'GARBAGE '||sid ELSE sid||' '||d2||' '||d1 END
 END AS line
FROM e
"""


def log_lines_sql_for_duckdb() -> str:
    """The renderer with ``events`` as a plain table name."""
    return LOG_LINES_FROM_EVENTS


def log_lines_sql_for_spark() -> str:
    """The renderer for ``spark.sql(text, events=df)``: literal braces are
    doubled and the table name becomes the ``{events}`` argument."""
    escaped = LOG_LINES_FROM_EVENTS.replace("{", "{{").replace("}", "}}")
    return escaped.replace(" FROM events)\n", " FROM {events})\n")
