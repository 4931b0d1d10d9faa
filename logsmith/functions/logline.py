"""Column expressions for NCSA common-log lines.

All of these are Catalyst expressions (JVM side, whole-stage codegen); none
calls Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must stay exactly as they are for results to match.
# Line grammar (anchored at the start only; a trailing referer/agent is ignored):
#   group 1 host, 2 ident, 3 user, 4 time with offset, 5 method, 6 url,
#   7 protocol, 8 status (3 digits or -), 9 bytes (digits or -)
LOG_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+)\s?(\S+)?\s?(\S+)?" (\d{3}|-) (\d+|-)'
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
DOTTED_QUAD = r"^\d+\.\d+\.\d+\.\d+"
STATUS_BANDS = [
    (200, 299, "2xx_success"),
    (300, 399, "3xx_redirect"),
    (400, 499, "4xx_client_error"),
    (500, 599, "5xx_server_error"),
]
STATUS_OTHER = "unknown"
# ---------------------------------------------------------------------------

FIELD_NAMES = ["ip", "client_identity", "user_id", "timestamp_str", "method",
               "url", "protocol", "status_str", "bytes_str"]

# One-pass parse: ``regexp_replace`` rewrites the matched prefix as the nine
# groups joined by a two-character separator, ``split`` cuts them.  Every
# \x01 already in the line is first escaped as \x01\x02, so the separator
# \x01\x03 can never occur inside a field; escaping only lengthens runs of
# non-space, non-word characters, so the pattern matches exactly as on the raw line.
_ESC, _ESCAPED = "\u0001", "\u0001\u0002"
_SEP = "\u0001\u0003"
_ONE_PASS_REPLACEMENT = _SEP.join(f"${i}" for i in range(1, 10)) + _SEP


def split_fields(value: Column) -> Column:
    """The split line: ten parts (nine groups and the ignored tail) when the line
    matches; an unmatched line keeps no separator and yields a single part."""
    escaped = F.replace(value, F.lit(_ESC), F.lit(_ESCAPED))
    return F.split(F.regexp_replace(escaped, LOG_PATTERN, _ONE_PASS_REPLACEMENT), _SEP, 10)


def is_match(parts: Column) -> Column:
    return F.size(parts) == 10


def matched_parts(value: Column) -> Column:
    """``[parts]`` for a matching line, ``[]`` otherwise (exploded to keep matched lines)."""
    return F.filter(F.array(split_fields(value)), is_match)


def unescape(field: Column) -> Column:
    return F.replace(field, F.lit(_ESCAPED), F.lit(_ESC))


def extract_fields_slow(value: Column) -> list[Column]:
    """Nine ``regexp_extract`` calls, one per group (the test oracle for ``split_fields``)."""
    return [F.regexp_extract(value, LOG_PATTERN, i + 1).alias(n) for i, n in enumerate(FIELD_NAMES)]


def parse_time(ts_str: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss Z`` to an instant; NULL for an impossible date."""
    return F.try_to_timestamp(ts_str, F.lit(TIME_FORMAT))


def parse_status(status_str: Column) -> Column:
    return F.when(status_str != "-", status_str.try_cast("int"))


def parse_bytes(bytes_str: Column) -> Column:
    """``-`` counts as 0 bytes; a number too large for a long becomes NULL."""
    return F.when(bytes_str != "-", bytes_str.try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def is_error(status: Column) -> Column:
    return F.when(status >= 400, F.lit(1)).otherwise(F.lit(0))


def status_category(status: Column) -> Column:
    expr = None
    for lo, hi, name in STATUS_BANDS:
        cond = status.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(STATUS_OTHER))


def looks_like_ip(col: Column) -> Column:
    """Dotted-quad prefix test (not anchored at the end, so ``1.2.3.4x`` passes)."""
    return col.rlike(DOTTED_QUAD)


def minute_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def utc_wall_clock(ts: Column) -> Column:
    """Instant -> ``timestamp_ntz`` holding the UTC wall clock (session is pinned to UTC)."""
    return ts.cast("timestamp_ntz")
