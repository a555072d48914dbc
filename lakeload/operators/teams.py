"""Team spaces: who gets a copy of which table, from where, and when it is due."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import codes
from .merge import fill_missing, upsert
from .registry import view_list

RULE_KEYS = ["view_name", "full_table_name"]


def members(registry: DataFrame, team: str) -> DataFrame:
    """Registry rows whose view list holds the team's name as a whole element."""
    return registry.where(F.array_contains(view_list(F.col("views")), team))


def memberships(registry: DataFrame) -> DataFrame:
    return registry.select(F.explode(view_list(F.col("views"))).alias("view_name"), "full_table_name")


def copy_sources(registry: DataFrame, domains: tuple[str, ...]) -> DataFrame:
    """Per table and view, the domain its copy is filled from, NULL for the live table itself.

    A table that is in a domain and in further spaces fills those from the domain; the domain
    view itself is then not copied.
    """
    views = view_list(F.col("views"))
    common = F.array_intersect(views, F.array(*[F.lit(d) for d in domains]))
    through = F.when((F.size(common) > 0) & (F.size(views) != F.size(common)), F.get(common, F.lit(0)))
    rows = registry.select("full_table_name", through.alias("source_domain"), F.explode(views).alias("view_name"))
    return rows.where(F.col("source_domain").isNull() | (F.lower("view_name") != F.col("source_domain")))


def refresh_due(rules: DataFrame, last_ingest: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Whether each rule's copy is due: active, with a frequency, and that many days old."""
    joined = rules.join(last_ingest, RULE_KEYS, "left")
    seconds = F.unix_timestamp(F.lit(as_of.isoformat(sep=" ")).cast("timestamp")) - F.unix_timestamp(
        F.col("last_ingest").cast("timestamp")
    )
    age = F.floor(seconds / 86400).cast("int")
    days = codes.frequency_days(F.col("frequency"))
    due = (days != 0) & (age >= days) & (F.lower("activate") == "yes")
    return joined.select(
        *RULE_KEYS, "frequency", age.alias("age_days"), F.coalesce(due, F.lit(False)).alias("due")
    )


def upsert_rules(rules: DataFrame, changes: DataFrame) -> DataFrame:
    """New rules over old ones. ``default`` switches a rule on; other gaps keep the old value."""
    default = F.col("activate") == "default"
    switched = changes.withColumn("activate", F.when(default, F.lit("yes")).otherwise(F.col("activate")))
    filled = fill_missing(rules, switched, RULE_KEYS)
    return upsert(rules, filled, RULE_KEYS)
