"""Lookup tables as single SQL expressions, which plan much faster than many literal columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value}L" if isinstance(value, int) and abs(value) > 2**31 - 1 else str(value)


def array_of(values) -> str:
    return f"array({', '.join(quoted(v) for v in values)})"


def map_of(entries: dict) -> Column:
    """A constant map; a list or tuple as value becomes an array."""
    parts = [f"{quoted(k)}, {array_of(v) if isinstance(v, (list, tuple)) else quoted(v)}" for k, v in entries.items()]
    return F.expr(f"map({', '.join(parts)})")


def find(entries: dict, key: Column) -> Column:
    """The value under ``key``, NULL where there is none."""
    return F.try_element_at(map_of(entries), key)
