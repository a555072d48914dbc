"""Small keyed tables kept current on disk: the audit table, the registry, the quality log.

A store has one partition per key. A change replaces the partitions of its own keys and
nothing else, so loads of different tables can keep their rows at the same time.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import escape_log
from ..operators import audit, teams
from ..sinks import publish, views
from . import folding

ARCHIVED_AT, ARCHIVED_ROW = "archived_at", "archived_row"


def read_store(spark: SparkSession, root: str, schema: str, folder: str = "current") -> DataFrame:
    """The stored rows, or none where nothing has been stored yet."""
    if not publish.exists(spark, f"{root}/{folder}"):
        return spark.createDataFrame([], schema)
    columns = spark.createDataFrame([], schema).columns
    # Other tables' files may be replaced while these are read; a reader's own keys are not.
    stored = spark.read.schema(schema).option("ignoreMissingFiles", "true").parquet(f"{root}/{folder}")
    return stored.select(*[f"`{c}`" for c in columns])


# Values that stand in a partition's folder name as they are.
PLAIN = re.compile(r"[A-Za-z0-9_.-]+")
FEW_KEYS = 1_000
COPIES_AT_ONCE = 8


def read_keys(spark: SparkSession, root: str, schema: str, keys: list[str], wanted: DataFrame) -> DataFrame:
    """The stored rows of the keys in ``wanted``. Few keys are read from their own folders, no other is listed."""
    values = wanted.select(*keys).distinct().limit(FEW_KEYS + 1).collect()
    if len(values) > FEW_KEYS or not all(isinstance(v, str) and PLAIN.fullmatch(v) for row in values for v in row):
        return read_store(spark, root, schema)
    folders = ["/".join([f"{root}/current", *[f"{k}={v}" for k, v in zip(keys, row)]]) for row in values]
    there = [f for f in folders if publish.exists(spark, f)]
    if not there:
        return spark.createDataFrame([], schema)
    columns = spark.createDataFrame([], schema).columns
    stored = spark.read.schema(schema).option("basePath", f"{root}/current").parquet(*there)
    return stored.select(*[f"`{c}`" for c in columns])


def put_rows(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the rows of the given keys; one file per key."""
    (
        rows.repartition(*keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def upsert_store(spark: SparkSession, root: str, changes: DataFrame, keys: list[str], schema: str) -> DataFrame:
    put_rows(changes, f"{root}/current", keys)
    return read_store(spark, root, schema)


def replace_audit(
    spark: SparkSession, root: str, changes: DataFrame, archived_at: str,
    schema: str = audit.AUDIT, keys: list[str] = audit.KEYS, time_column: str = "ingest_timestamp",
) -> None:
    """Replace the audit rows of the given tables; the replaced rows go to the history first. Other tables are not looked at.

    An archived row is kept under its own time and state. A run that is repeated after a
    failure so writes the row it archived before again, and never over another one.
    """
    current = read_keys(spark, root, schema, keys, changes)
    history = current.withColumn(ARCHIVED_AT, F.lit(archived_at)).limit(0)
    replaced = audit.to_history(history, current, changes, archived_at, keys)
    named = replaced.withColumn(ARCHIVED_ROW, F.concat_ws(" ", F.lit("row"), time_column, "current_repull"))
    put_rows(named, f"{root}/history", [*keys, ARCHIVED_ROW])
    put_rows(changes, f"{root}/current", keys)


def record_audit(
    spark: SparkSession, root: str, changes: DataFrame, archived_at: str,
    schema: str = audit.AUDIT, keys: list[str] = audit.KEYS, time_column: str = "ingest_timestamp",
) -> DataFrame:
    """``replace_audit``, and the rows of all tables after it."""
    replace_audit(spark, root, changes, archived_at, schema, keys, time_column)
    return read_store(spark, root, schema)


def read_history(spark: SparkSession, root: str, schema: str = audit.AUDIT, keys: list[str] = audit.KEYS) -> DataFrame:
    return folding.read_folded(spark, f"{root}/history", _history_schema(schema), [*keys, ARCHIVED_ROW])


def fold_history(spark: SparkSession, root: str, schema: str = audit.AUDIT, keys: list[str] = audit.KEYS) -> int:
    """Fold the folders of archived rows into few files; to be run now and then."""
    return folding.fold(spark, f"{root}/history", _history_schema(schema), [*keys, ARCHIVED_ROW])


def _history_schema(schema: str) -> str:
    return f"{schema}, {ARCHIVED_AT} STRING, {ARCHIVED_ROW} STRING"


QA_LOG = "log_time TIMESTAMP, table_name STRING, log STRING, status STRING"
QA_LOG_BATCHES = f"{QA_LOG}, batch STRING"


def append_log(rows: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """Append to the quality log: time, table, text, and the stages' verdict as JSON.

    Each batch has a folder of its own, so loads can log at the same time. A batch that is
    named is stored once however often it is repeated.
    """
    folder = f"{path}/batch={batch or uuid.uuid4().hex}"
    rows.select("log_time", "table_name", "log", "status").write.mode("overwrite").parquet(folder)
    return read_log(rows.sparkSession, path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return folding.read_folded(spark, path, QA_LOG_BATCHES, ["batch"]).drop("batch")


def fold_log(spark: SparkSession, path: str) -> int:
    """Fold the log's batches into few files; to be run now and then."""
    return folding.fold(spark, path, QA_LOG_BATCHES, ["batch"])


def latest_log(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """The newest ``n`` rows of the stored quality log."""
    log = read_log(spark, path)
    return log.orderBy(F.col("log_time").desc(), "table_name", "log").limit(n)


def log_lines(rows: DataFrame) -> DataFrame:
    """The log's delimited text form; only here is its text escaped."""
    time = F.date_format("log_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.select(F.concat_ws("|", time, F.trim("table_name"), escape_log(F.col("log")), "status").alias("value"))


def rebuild_team(spark: SparkSession, registry: DataFrame, team: str, live_root: str, team_root: str) -> list[str]:
    """Copy every table of a team space anew and swap it in; gives the names of the tables.

    One job per table, as each is a table of its own; a few run side by side, so that small
    tables do not wait for each other. Tables that are no longer the team's go afterwards.
    """
    names = sorted(r.full_table_name for r in teams.members(registry, team).select("full_table_name").distinct().toLocalIterator())

    def copy(name: str) -> None:
        live = spark.read.parquet(f"{live_root}/{name}")
        views.copy_full(live, f"{team_root}/{name}_next")
        publish.swap(spark, f"{team_root}/{name}_next", f"{team_root}/{name}", f"{team_root}/{name}_backup")

    with ThreadPoolExecutor(COPIES_AT_ONCE) as pool:
        list(pool.map(copy, names))
    kept = {f"{name}{end}" for name in names for end in ("", "_backup")}
    for folder in publish.folders(spark, team_root):
        if folder not in kept:
            publish.delete(spark, f"{team_root}/{folder}")
    return names
