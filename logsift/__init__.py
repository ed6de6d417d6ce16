"""logsift: session-log analytics as Spark DataFrame plans.

Session logs (one text file per user session) are scanned into a
``log_lines`` table, classified line by line into typed ``records`` with
column expressions, folded per session with window functions, and
aggregated into the card-search and quick-search-open metrics plus a
profile of the log format.  Every step is a function from DataFrame to
DataFrame; only :mod:`logsift.plans.job` caches or writes.
"""

from logsift.operators.parse import parse_log_lines
from logsift.operators.profile_parse import parse_profile_lines
from logsift.operators.sessions import session_events, session_dates
from logsift.operators.metrics import (
    card_blocks,
    card_search_count,
    document_opens,
    quick_search_docs,
    quick_search_opens,
    session_summary,
)
from logsift.sources.session_files import read_session_files
from logsift.sources.tables import read_log_lines_table, render_log_lines_from_events

__all__ = [
    "parse_log_lines",
    "parse_profile_lines",
    "session_events",
    "session_dates",
    "card_blocks",
    "card_search_count",
    "document_opens",
    "quick_search_docs",
    "quick_search_opens",
    "session_summary",
    "read_session_files",
    "read_log_lines_table",
    "render_log_lines_from_events",
]
