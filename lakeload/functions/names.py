"""Column and table name cleaning, as column expressions and for plain strings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# What a lake name may hold, and the prefixes for names that start badly.
NOT_ALLOWED = "[^A-Za-z0-9_]"
DIGIT_PREFIX = "i_"
UNDERSCORE_PREFIX = "i"
TABLE_NOT_ALLOWED = "[^A-Za-z0-9]"
# Names the landing files cannot hold as they are.
RESERVED_IN_LANDING = ("public",)


def lake_name(col: Column) -> Column:
    """Name in the lake: odd characters dropped, ``i_`` before a leading digit."""
    kept = F.regexp_replace(col, NOT_ALLOWED, "")
    return F.when(kept.rlike("^[0-9]"), F.concat(F.lit(DIGIT_PREFIX), kept)).otherwise(kept)


def landing_name(col: Column) -> Column:
    """Name in the landing files: the lake name, with ``i`` before a leading underscore."""
    name = lake_name(col)
    return (
        F.when(name.startswith("_"), F.concat(F.lit(UNDERSCORE_PREFIX), name))
        .when(name.isin(*RESERVED_IN_LANDING), F.concat(F.lit("_"), name))
        .otherwise(name)
    )


def extract_name(col: Column) -> Column:
    """Alias used in the extract query: cleaned, prefixed for a leading digit or underscore."""
    kept = F.regexp_replace(col, NOT_ALLOWED, "")
    return (
        F.when(kept.rlike("^[0-9]"), F.concat(F.lit(DIGIT_PREFIX), kept))
        .when(kept.startswith("_"), F.concat(F.lit(UNDERSCORE_PREFIX), kept))
        .otherwise(kept)
    )


def table_name(col: Column) -> Column:
    return F.regexp_replace(col, TABLE_NOT_ALLOWED, "")


def clean(name: str) -> str:
    kept = re.sub(NOT_ALLOWED, "", name)
    return DIGIT_PREFIX + kept if kept[:1].isdigit() else kept


def clean_for_extract(name: str) -> str:
    kept = clean(name)
    return UNDERSCORE_PREFIX + kept if kept.startswith("_") else kept


def clean_for_landing(name: str) -> str:
    kept = clean(name)
    if kept.startswith("_"):
        return UNDERSCORE_PREFIX + kept
    return "_" + kept if kept in RESERVED_IN_LANDING else kept


def with_clean_names(df: DataFrame) -> DataFrame:
    """Rename every column to its lake name; two columns may not end up with one name."""
    renamed = [clean(c) for c in df.columns]
    twice = sorted({c for c in renamed if renamed.count(c) > 1})
    if twice:
        raise ValueError(f"columns share a cleaned name: {', '.join(twice)}")
    return df.toDF(*renamed)
