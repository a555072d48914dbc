"""The audit table: one current row per domain and table, and its history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .merge import upsert
from .registry import frequency

# Keys and columns of the audit tables of loads and of exports.
KEYS = ["domain", "table"]
EXPORT_KEYS = ["domain", "table_name"]
AUDIT = (
    "directory STRING, pull_time INT, avro_size BIGINT, ingest_timestamp STRING, parquet_time INT, "
    "parquet_size BIGINT, rows BIGINT, lifespan STRING, ack INT, cleaned INT, current_repull INT, "
    "automation_appl_id STRING, domain STRING, `table` STRING"
)
EXPORT_AUDIT = (
    "directory STRING, push_time INT, txt_size BIGINT, export_timestamp STRING, parquet_time INT, "
    "parquet_size BIGINT, row_count BIGINT, lifespan STRING, ack INT, cleaned INT, current_repull INT, "
    "automation_appl_id STRING, domain STRING, table_name STRING"
)
# State of the row's load.
DONE, IN_PROGRESS, FAILED = 0, 1, 2


def replace_rows(current: DataFrame, changes: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return upsert(current, changes, keys)


def to_history(
    history: DataFrame, current: DataFrame, changes: DataFrame, archived_at: str, keys: list[str] = KEYS
) -> DataFrame:
    """History plus the current rows that are about to be replaced, with the time they were archived."""
    replaced = current.join(changes.select(*keys), keys, "left_semi")
    return history.unionByName(replaced.withColumn("archived_at", F.lit(archived_at)).select(*history.columns))


def in_progress(tables: DataFrame, started_at: str) -> DataFrame:
    """Marker rows for loads that have started: only the time and the state are known."""
    spark = tables.sparkSession
    shape = spark.createDataFrame([], AUDIT).schema
    known = {
        "domain": F.col("domain"),
        "table": F.col("table"),
        "ingest_timestamp": F.lit(started_at),
        "current_repull": F.lit(IN_PROGRESS),
    }
    return tables.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])


def last_rows(audit_log: DataFrame) -> DataFrame:
    """Row count of each table's newest audit row, 0 where none is known."""
    return audit_log.groupBy(*KEYS).agg(
        F.max("ingest_timestamp").alias("ingest_timestamp"),
        F.coalesce(F.max_by("rows", "ingest_timestamp"), F.lit(0)).alias("rows"),
    )


def with_lifespan(audit: DataFrame, registry: DataFrame) -> DataFrame:
    """Audit rows with the lifespan their registry row's frequency gives; others stay as they are."""
    named = registry.select("domain", F.col("source_table_name").alias("table"), frequency().alias("_lifespan"))
    # Two registry rows may name one table; an audit row stays one row.
    named = named.groupBy(*KEYS).agg(F.max("_lifespan").alias("_lifespan"))
    return (
        audit.join(named, KEYS, "left")
        .withColumn("lifespan", F.coalesce("_lifespan", "lifespan"))
        .select(*audit.columns)
    )
