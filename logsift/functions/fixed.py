"""Fixed values of the session-log format.

Everything in this module must stay byte-for-byte equal to the log format
the metrics were defined on: record type names, command tokens, the
patterns that recognise tokens, month names, error texts and the
descriptive format table of the profile report.  They are stated here once,
as plain text, and imported everywhere else.
"""

# --- Fixed values: record types (job dialect emits the first eight) -------
SESSION_START = "SESSION_START"
SESSION_END = "SESSION_END"
QUICK_SEARCH = "QUICK_SEARCH"
SEARCH_RESULTS = "SEARCH_RESULTS"
DOCUMENT_OPEN = "DOCUMENT_OPEN"
DOCUMENT_OPEN_NO_TS = "DOCUMENT_OPEN_NO_TS"
CARD_SEARCH_START = "CARD_SEARCH_START"
CARD_SEARCH_QUERY = "CARD_SEARCH_QUERY"
CARD_SEARCH_END = "CARD_SEARCH_END"
UNPARSEABLE = "UNPARSEABLE"
EMPTY = "EMPTY"  # profile dialect only

# --- Fixed values: command tokens (first token of a command line) ---------
CMD_SESSION_START = "SESSION_START"
CMD_SESSION_END = "SESSION_END"
CMD_QS = "QS"
CMD_DOC_OPEN = "DOC_OPEN"
CMD_CARD_SEARCH_START = "CARD_SEARCH_START"
CMD_CARD_SEARCH_END = "CARD_SEARCH_END"
KNOWN_COMMANDS = (
    "SESSION_START",
    "SESSION_END",
    "QS",
    "DOC_OPEN",
    "CARD_SEARCH_START",
    "CARD_SEARCH_END",
)

# --- Fixed values: patterns (Java regex; \z anchors the true end) ---------
LINE_BREAK = r"\r\n|\r|\n"
TOKEN_SPLIT = r"\s+"
TS_STANDARD = r"^(\d{2})\.(\d{2})\.(\d{4})_\d{2}:\d{2}:\d{2}\z"
TS_HTTP = (
    r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun),_(\d{1,2})_([A-Za-z]{3})_(\d{4})"
    r"_\d{2}:\d{2}:\d{2}_\+\d{4}\z"
)
DOC_ID = r"[A-Z]+_\d+"
DOC_ID_WHOLE = r"^[A-Z]+_\d+\z"
SEARCH_ID_WHOLE = r"^-?\d+\z"
CARD_PARAM_WHOLE = r"^\$\d+\z"  # job dialect: the whole first token
CARD_PARAM_PREFIX = r"^\$\d+"  # profile dialect: a prefix of the first token
NUMERIC_FILE_NAME = r"^\d+\z"
PROFILE_FILE_NAME = r"^(0|[1-9][0-9]{0,3})\z"

# --- Fixed values: profile dialect (a Python reader) ----------------------
# Whitespace of Python's str.split() / str.strip(), and \d = any Unicode
# decimal digit (\p{Nd}); the job dialect's JVM grammar uses ASCII.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


# The same set as a Java regex class: Java's whitespace property plus the
# four characters Python also treats as whitespace (checked over every BMP
# character in the tests).
PY_SPACE = r"[\p{javaWhitespace}\x85\xa0\u2007\u202f]"
PY_NONSPACE = r"[^\p{javaWhitespace}\x85\xa0\u2007\u202f]"
P_TOKEN_SPLIT = PY_SPACE + "+"
P_TS_STANDARD = r"^\p{Nd}{2}\.\p{Nd}{2}\.\p{Nd}{4}_\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}\z"
P_TS_HTTP = (
    r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun),_\p{Nd}{1,2}_[A-Za-z]{3}_\p{Nd}{4}"
    r"_\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}_\+\p{Nd}{4}\z"
)
P_DOC_ID = r"[A-Z]+_\p{Nd}+"
P_DOC_ID_WHOLE = r"^[A-Z]+_\p{Nd}+\z"
P_SEARCH_ID_WHOLE = r"^-?\p{Nd}+\z"
P_CARD_PARAM_PREFIX = r"^\$\p{Nd}+"
# possessive quantifiers: the classes are complements, so no backtracking is needed
P_AFTER_TWO_TOKENS = "(?s)^" + PY_NONSPACE + "++" + PY_SPACE + "++" + PY_NONSPACE + "++" + PY_SPACE + "++(.*)\\z"
P_QS_BRACE = r"(?s)^\{[^}]*\}"
P_QS_BRACE_BODY = r"(?s)^\{([^}]*)\}" + PY_SPACE + "*(.*)"

# --- Fixed values: month abbreviations of the HTTP-style timestamp --------
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# --- Fixed values: parse error texts --------------------------------------
# job dialect
ERR_UNKNOWN_TOKEN = "unknown token: "
ERR_CARD_END_TOKENS = "CARD_SEARCH_END: unexpected tokens"
ERR_MISSING_TS = "missing timestamp"
ERR_INVALID_TS = "invalid timestamp: "
ERR_DOC_OPEN_TOKENS = "DOC_OPEN: expected 4 tokens, got "
# profile dialect (token shown in single quotes)
PERR_UNKNOWN_COMMAND = "unknown command: "
PERR_CARD_END_TOKENS = "CARD_SEARCH_END with unexpected tokens"
PERR_MISSING_TS = "missing timestamp"
PERR_INVALID_TS = "invalid timestamp: "
PERR_DOC_OPEN_TOKENS = "DOC_OPEN token count="

# --- Fixed values: the default target document of the card-search metric --
TARGET_DOCUMENT = "ACC_45616"

# --- Fixed values: profile report, format table per record type -----------
# (record_type, pattern, note); note is empty where the format has none.
RECORD_FORMATS = (
    ("SESSION_START", "SESSION_START <timestamp>", "Начало сессии; один файл = одна сессия."),
    ("SESSION_END", "SESSION_END <timestamp>", ""),
    ("QUICK_SEARCH", "QS <timestamp> {<query_text>}", "Следующая строка — SEARCH_RESULTS с search_id и doc_id."),
    ("SEARCH_RESULTS", "<search_id> <doc_id> [<doc_id> ...]", "Строка без явной команды; привязана к предыдущему QS или CARD_SEARCH."),
    ("DOCUMENT_OPEN", "DOC_OPEN <timestamp> <search_id> <document_id>", ""),
    ("DOCUMENT_OPEN_NO_TS", "DOC_OPEN <search_id> <document_id>", "~6% DOC_OPEN: timestamp отсутствует (двойной пробел после DOC_OPEN в сыром логе)."),
    ("CARD_SEARCH_START", "CARD_SEARCH_START <timestamp>", "Далее CARD_SEARCH_QUERY, затем CARD_SEARCH_END, затем SEARCH_RESULTS."),
    ("CARD_SEARCH_QUERY", "$<n> [<free text>] | $<n> <document_id>", ""),
    ("CARD_SEARCH_END", "CARD_SEARCH_END", "Без timestamp; часто строка только из команды."),
    ("EMPTY", "(пустая строка)", ""),
    ("UNPARSEABLE", "?", ""),
)

# --- Fixed values: profile report, fields of each record type -------------
# (record_type, field, description); types without fields have no entry.
RECORD_FIELDS = (
    ("SESSION_START", "timestamp", "dd.MM.yyyy_HH:mm:ss | Mon,_d_Mon_yyyy_HH:mm:ss_+ZZZZ"),
    ("SESSION_END", "timestamp", "dd.MM.yyyy_HH:mm:ss | Mon,_d_Mon_yyyy_HH:mm:ss_+ZZZZ"),
    ("QUICK_SEARCH", "timestamp", "dd.MM.yyyy_HH:mm:ss | Mon,_d_Mon_yyyy_HH:mm:ss_+ZZZZ"),
    ("QUICK_SEARCH", "query_text", "текст в фигурных скобках (может быть пустым)"),
    ("SEARCH_RESULTS", "search_id", "целое, может быть отрицательным"),
    ("SEARCH_RESULTS", "document_ids", "список PREFIX_number через пробел"),
    ("DOCUMENT_OPEN", "timestamp", "dd.MM.yyyy_HH:mm:ss | HTTP-вариант"),
    ("DOCUMENT_OPEN", "search_id", "целое"),
    ("DOCUMENT_OPEN", "document_id", "PREFIX_number"),
    ("DOCUMENT_OPEN_NO_TS", "search_id", "целое"),
    ("DOCUMENT_OPEN_NO_TS", "document_id", "PREFIX_number"),
    ("CARD_SEARCH_START", "timestamp", "dd.MM.yyyy_HH:mm:ss"),
    ("CARD_SEARCH_QUERY", "card_param", "например $134 или $0"),
    ("CARD_SEARCH_QUERY", "query_text", "остаток строки (опционально)"),
    ("CARD_SEARCH_QUERY", "document_id", "редко: doc_id сразу после $0"),
)

# --- Fixed values: profile report, legacy command name per record type ----
LEGACY_COMMANDS = (
    ("SESSION_START", "SESSION_START"),
    ("SESSION_END", "SESSION_END"),
    ("QUICK_SEARCH", "QS"),
    ("SEARCH_RESULTS", "NUMERIC_COMMAND"),
    ("DOCUMENT_OPEN", "DOC_OPEN"),
    ("DOCUMENT_OPEN_NO_TS", "DOC_OPEN"),
    ("CARD_SEARCH_START", "CARD_SEARCH_START"),
    ("CARD_SEARCH_END", "CARD_SEARCH_END"),
    ("CARD_SEARCH_QUERY", "CARD_SEARCH_QUERY"),
)
