"""Column rules that turn raw log lines into typed events.

Everything here returns ``Column`` expressions, so the whole parse runs in
whole-stage codegen next to the scan.  Two formats are recognised, tried in
this order: the error/notice format and the access format (common or
combined).  A line matching neither is a reject.

Each matched line runs its pattern twice: once as an ``rlike`` gate, once as
a ``regexp_replace`` that writes all capture groups into one string which is
then split.  That is cheaper than one ``regexp_extract`` per group (eight for
the access format).  If a captured group itself contains the separator, the
split has the wrong size and that row falls back to per-group extraction, so
the result is exact for every input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: formats and rules that results must agree with -----------
# Error/notice format: [time] [level] [context]? message
ERROR_PATTERN = r"^\[([\w\s:/\+\-]+)\] \[(\w+)\](?:\s\[([^\]]+)\])?\s(.+)$"
# Access format (common, optionally combined with referer and user agent);
# not anchored at the end, so trailing text is accepted.
ACCESS_PATTERN = (
    r'^(\S+) \S+ \S+ \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) \S+" (\d{3}) (\S+)'
    r'(?: "([^"]*)" "([^"]*)")?'
)
# Client address inside the error-format context.
CLIENT_IP_PATTERN = r"client\s([\d\.]+)"
# Error-format time: weekday, month, day, time, year (%a %b %d %H:%M:%S %Y).
WEEKDAY_PATTERN = r"(?i)^(mon|tue|wed|thu|fri|sat|sun)\s+"
ERROR_TIME_FORMAT = "MMM d H:m:s yyyy"
# Access-format time before the zone offset (%d/%b/%Y:%H:%M:%S).
ACCESS_TIME_FORMAT = "d/MMM/yyyy:H:m:s"
# Error-format constants.
ERROR_METHOD = "LOG"
ERROR_LEVEL = "error"
ERROR_LEVEL_STATUS = 400
OTHER_LEVEL_STATUS = 200
MESSAGE_CHARS = 100
# Characters removed from both ends of a line before parsing.
STRIP_CHARS = " \t\n\r\x0b\x0c"
# ---------------------------------------------------------------------------

# Java's "." stops at U+0085/U+2028/U+2029; Python's stops only at "\n".
# UNIX_LINES mode ("(?d)") gives the Python behaviour.
_JAVA = "(?d)"
_SEP = "\u0001"

KIND_ERROR = "E"
KIND_ACCESS = "A"
KIND_REJECT = "X"

EVENT_FIELDS = ["ip", "timestamp", "method", "url", "status", "bytes", "referer", "user_agent"]


def strip_line(line: Column) -> Column:
    """Strip ASCII whitespace at both ends (``str.strip`` for ASCII text)."""
    return F.btrim(line, F.lit(STRIP_CHARS))


def line_kind(line: Column) -> Column:
    """'E' error format, 'A' access format, 'X' neither (tried in that order)."""
    return (
        F.when(line.rlike(_JAVA + ERROR_PATTERN), F.lit(KIND_ERROR))
        .when(line.rlike(_JAVA + ACCESS_PATTERN), F.lit(KIND_ACCESS))
        .otherwise(F.lit(KIND_REJECT))
    )


def _all_groups(line: Column, pattern: str, n: int, tail: str = "") -> Column:
    """All ``n`` capture groups of ``pattern`` as one array (one regex run)."""
    rep = _SEP.join(f"${i}" for i in range(1, n + 1))
    return F.split(F.regexp_replace(line, _JAVA + pattern + tail, rep), _SEP, -1)


def _group(line: Column, parts: Column, pattern: str, n: int, i: int) -> Column:
    """Group ``i`` (1-based) from ``parts``; exact fallback when the split is off."""
    return F.when(F.size(parts) == n, F.get(parts, i - 1)).otherwise(
        F.regexp_extract(line, _JAVA + pattern, i)
    )


def error_time(text: Column) -> Column:
    """``%a %b %d %H:%M:%S %Y``: weekday name checked, not compared with the date."""
    rest = F.regexp_replace(F.regexp_replace(text, WEEKDAY_PATTERN, ""), r"\s+", " ")
    return F.when(text.rlike(WEEKDAY_PATTERN), F.try_to_timestamp(rest, F.lit(ERROR_TIME_FORMAT)))


def access_time(text: Column) -> Column:
    """``%d/%b/%Y:%H:%M:%S`` on the text before the first blank; offset dropped."""
    return F.try_to_timestamp(F.regexp_extract(text, r"^(\S+)", 1), F.lit(ACCESS_TIME_FORMAT))


def parse_bytes(text: Column) -> Column:
    """'-' or anything that is not a 64-bit integer gives 0."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def client_ip(context: Column) -> Column:
    """First ``client <digits and dots>`` in the context, else ''."""
    return F.regexp_extract(context, CLIENT_IP_PATTERN, 1)


def level_status(level: Column) -> Column:
    """Exactly 'error' gives 400, any other level 200."""
    return F.when(level == F.lit(ERROR_LEVEL), F.lit(ERROR_LEVEL_STATUS)).otherwise(F.lit(OTHER_LEVEL_STATUS))


def truncate_message(message: Column) -> Column:
    return F.substring(message, 1, MESSAGE_CHARS)


def parse_lines(lines: DataFrame, line_col: str = "line", fallback_time: str = "ingested_at") -> DataFrame:
    """Classify and parse every line in one pass.

    Input: any DataFrame with a string column ``line_col`` (already stripped
    and non-blank, see :func:`logsift.sources.logs.clean_lines`) and a
    timestamp ``fallback_time`` used when the log time does not parse (the
    reference uses the wall clock there, which is not reproducible).

    Output: the input columns plus ``kind`` and the eight event fields; the
    fields are NULL for rejects (``kind = 'X'``).
    """
    line = F.col(line_col)
    staged = lines.withColumn("kind", line_kind(line)).withColumns(
        {
            "_e": F.when(F.col("kind") == KIND_ERROR, _all_groups(line, ERROR_PATTERN, 4)),
            "_a": F.when(F.col("kind") == KIND_ACCESS, _all_groups(line, ACCESS_PATTERN, 8, ".*")),
        }
    )
    e = lambda i: _group(line, F.col("_e"), ERROR_PATTERN, 4, i)
    a = lambda i: _group(line, F.col("_a"), ACCESS_PATTERN, 8, i)
    is_e = F.col("kind") == KIND_ERROR
    is_a = F.col("kind") == KIND_ACCESS
    fallback = F.col(fallback_time)

    def pick(err: Column, acc: Column) -> Column:
        return F.when(is_e, err).when(is_a, acc)

    fields = {
        "ip": pick(client_ip(e(3)), a(1)),
        "timestamp": pick(
            F.coalesce(error_time(e(1)), fallback), F.coalesce(access_time(a(2)), fallback)
        ),
        "method": pick(F.lit(ERROR_METHOD), a(3)),
        "url": pick(truncate_message(e(4)), a(4)),
        "status": pick(level_status(e(2)), a(5).cast("int")),
        "bytes": pick(F.lit(0).cast("bigint"), parse_bytes(a(6))),
        "referer": pick(e(3), a(7)),
        "user_agent": pick(e(2), a(8)),
    }
    return staged.withColumns(fields).drop("_e", "_a")
