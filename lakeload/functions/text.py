"""Escaping for delimited export lines and for log text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The text form of an export clone.
FIELD_SEPARATOR = "\x01"
ESCAPE = "\\"
NULL_MARK = "\\N"
# What a log line escapes, and what it replaces.
LOG_ESCAPED = ("'", '"', ",")


def _replace(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def export_field(col: Column, separator: str = FIELD_SEPARATOR) -> Column:
    """One value on an export line. Line breaks are escaped, so a row stays on one line."""
    text = col.cast("string")
    for plain, written in (
        (ESCAPE, ESCAPE + ESCAPE),
        (separator, ESCAPE + separator),
        ("\n", ESCAPE + "n"),
        ("\r", ESCAPE + "r"),
    ):
        text = _replace(text, plain, written)
    return F.coalesce(text, F.lit(NULL_MARK))


def export_line(columns: list[str], separator: str = FIELD_SEPARATOR) -> Column:
    return F.concat_ws(separator, *[export_field(F.col(c), separator) for c in columns])


def escape_log(col: Column) -> Column:
    """Log text for the delimited log: quotes and commas escaped, on one line, trimmed."""
    stripped = F.regexp_replace(col, r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$", "")
    escaped = reduce(lambda c, ch: _replace(c, ch, ESCAPE + ch), LOG_ESCAPED, stripped)
    return _replace(_replace(escaped, "\n", " "), "\r", "")
