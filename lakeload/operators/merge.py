"""Keyed changes to a table: insert if absent, replace if present, both.

``changes`` holds a key at most once. The current side is only ever probed with an anti
or semi join on the key, which adaptive execution can split when a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def one_per_key(changes: DataFrame, keys: list[str], newest: str | None = None) -> DataFrame:
    """One row of each key: that of the greatest ``newest``, of equals or without one that of the greatest values."""
    first = [newest] if newest else []
    values = [c for c in changes.columns if c not in (*keys, *first)]
    row = F.max(F.struct(*first, *values)).alias("_row")
    if not first and not values:
        return changes.select(*keys).distinct()
    return changes.groupBy(*keys).agg(row).select(*[c if c in keys else F.col(f"_row.{c}") for c in changes.columns])


def insert_absent(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows plus the new rows whose key is not there yet."""
    absent = new.join(current.select(*keys), keys, "left_anti")
    return current.unionByName(absent)


def replace_present(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows, each replaced by its change if there is one; new keys are left out."""
    untouched = current.join(changes.select(*keys), keys, "left_anti")
    changed = changes.join(current.select(*keys), keys, "left_semi")
    return untouched.unionByName(changed.select(*current.columns))


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows without the changed keys, plus all changes."""
    untouched = current.join(changes.select(*keys), keys, "left_anti")
    return untouched.unionByName(changes.select(*current.columns))


def fill_missing(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changes with their NULLs filled from the current row of the same key."""
    values = [c for c in changes.columns if c not in keys]
    old = current.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in values])
    joined = changes.join(old, keys, "left")
    return joined.select(*keys, *[F.coalesce(c, f"_old_{c}").alias(c) for c in values])
