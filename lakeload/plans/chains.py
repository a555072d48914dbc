"""The whole way of one table: in, with its checks, views and audit row; and out again."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import names
from ..operators import audit, catalog, compare, incremental, project
from ..operators.project import Field
from ..session import size_shuffles
from ..sinks import export, marks, publish, views
from ..sources import files
from . import loads, quality, stores
from .loads import Folders


class QualityError(ValueError):
    """A check failed; nothing was published."""


@dataclass(frozen=True)
class Table:
    """What a chain has to know about one table."""

    vendor: str
    domain: str
    name: str
    fields: list[Field]
    folders: Folders
    audit_root: str
    lifespan: str = "none"
    sample_id: str | None = None
    check_column: str | None = None
    live_table: str | None = None
    views: list[str] = field(default_factory=list)
    # Values that may be lost, cut or rounded in the cast before a load is held back; None for any number.
    tolerated: int | None = 0


def source_catalog(spark: SparkSession, table: Table) -> DataFrame:
    """The table's columns as catalog rows, with the names they have in the lake."""
    rows = [
        (table.vendor, table.name, i, names.clean(f.name).lower(), f.data_type, f.char_length, f.precision, f.scale, None, False)
        for i, f in enumerate(table.fields, start=1)
    ]
    return spark.createDataFrame(rows, catalog.CATALOG)


def check_schema(spark: SparkSession, table: Table, staged: DataFrame) -> DataFrame:
    """Stages of the schema check: declared types against the vendor's, stored types against the declared."""
    source = source_catalog(spark, table)
    matched = quality.full_load(source, catalog.lake_catalog(source))
    stored = [t for c, t in staged.dtypes if c not in project.SYSTEM_COLUMNS]
    wanted = [stored_type(lake) for lake in project.lake_types(table.fields, table.vendor)]
    return matched.unionByName(
        matched.select("vendor", "table_name", F.lit("stored_types").alias("stage"), F.lit(stored == wanted).alias("passed"))
    )


def stored_type(lake: str) -> str:
    """Spark's own name of the type a lake type is stored as."""
    if lake.startswith(("VARCHAR", "CHAR", "STRING")):
        return "string"
    return "timestamp_ntz" if lake.startswith("TIMESTAMP") else lake.lower()


def _misfits(seen) -> dict[str, int]:
    return {c: n for c, n in seen.get.items() if c != "_rows" and n}


def _require_whole(table: Table, seen) -> None:
    """Hold the load back if more values than tolerated did not reach their lake type whole."""
    bad = _misfits(seen)
    if table.tolerated is not None and sum(bad.values()) > table.tolerated:
        raise QualityError(f"values of {table.name} do not fit the lake: " + ", ".join(f"{c} {n}" for c, n in sorted(bad.items())))


def _passed(stages: DataFrame) -> bool:
    return stages.agg(F.bool_and("passed")).first()[0]


def _mark(spark: SparkSession, table: Table, at: dt.datetime) -> None:
    tables = spark.createDataFrame([(table.domain, table.name)], "domain string, `table` string")
    stores.replace_audit(spark, f"{table.audit_root}/ingest", audit.in_progress(tables, _text(at)), _text(at))


def _text(at: dt.datetime) -> str:
    return at.strftime("%Y-%m-%d %H:%M:%S")


def _record(spark: SparkSession, table: Table, at: dt.datetime, state: int, **known) -> None:
    shape = spark.createDataFrame([], audit.AUDIT).schema
    row = {
        "directory": table.folders.root, "ingest_timestamp": _text(at), "lifespan": table.lifespan, "ack": 0, "cleaned": 0,
        "current_repull": state, "domain": table.domain, "table": table.name, **known,
    }
    changes = spark.createDataFrame([[row.get(f.name) for f in shape.fields]], shape)
    stores.replace_audit(spark, f"{table.audit_root}/ingest", changes, _text(at))


def ingest_full(source: DataFrame, table: Table, at: dt.datetime) -> DataFrame:
    """Extract, check the count, cast, stage, check, publish, make views, write the audit row.

    Gives the stages and whether they passed. The row check of a sample is reported but does
    not hold a load back; a failed schema does, and leaves the live table as it was.
    """
    spark, to = source.sparkSession, table.folders
    size_shuffles(source)
    _mark(spark, table, at)
    began = time.monotonic()
    try:
        landed, extracted = files.land_counted(source, to.landing)
        compare.require_equal_counts(extracted, landed.count())
        pulled = time.monotonic()
        typed, seen = loads.observed(landed, table.fields, table.vendor, at, full=True)
        staged = publish.write_stage(typed, to.stage)
        _require_whole(table, seen)
        stages = check_schema(spark, table, staged)
        if not _passed(stages):
            raise QualityError(f"the schema of {table.name} does not match its source")
        if table.sample_id:
            lake = dict(zip([names.clean(f.name) for f in table.fields], project.lake_types(table.fields, table.vendor)))
            lake = {c: t.replace("TIMESTAMP_DATE", "TIMESTAMP") for c, t in lake.items()}
            plain = landed.toDF(*[names.clean(f.name) for f in table.fields])
            sampled = quality.sampling(plain, staged, table.sample_id, lake, misfits=sum(_misfits(seen).values()))
            stages = stages.unionByName(
                sampled.select(F.lit(table.vendor).alias("vendor"), F.lit(table.name).alias("table_name"), "stage", "passed")
            )
        # The checks have to be read before their stage folder moves.
        verdict = spark.createDataFrame(stages.collect(), stages.schema)
        publish.swap(spark, to.stage, to.live, to.backup)
    except Exception:
        _record(spark, table, at, audit.FAILED)
        raise
    _show(spark, table, staged)
    _record(
        spark, table, at, audit.DONE, rows=extracted, pull_time=int(pulled - began), avro_size=publish.folder_bytes(spark, to.landing),
        parquet_time=int(time.monotonic() - pulled), parquet_size=publish.folder_bytes(spark, to.live),
    )
    publish.delete(spark, to.landing)
    return verdict


def ingest_increment(source: DataFrame, table: Table, at: dt.datetime) -> int:
    """Load the rows above the live table's mark as one more partition; gives their number.

    The count read must be the count landed, and the increment's schema the live table's.
    """
    spark, to = source.sparkSession, table.folders
    size_shuffles(source)
    _mark(spark, table, at)
    began = time.monotonic()
    try:
        live = spark.read.parquet(to.live)
        newer = incremental.above(source, table.check_column, _high_watermark(spark, table, live))
        landed, extracted = files.land_counted(newer, to.landing)
        compare.require_equal_counts(extracted, landed.count())
        pulled = time.monotonic()
        if extracted:
            typed, seen = loads.observed(landed, table.fields, table.vendor, at, full=False)
            if not _passed(check_schema(spark, table, typed)) or dict(typed.dtypes) != dict(live.dtypes):
                raise QualityError(f"the increment of {table.name} does not match its live table")
            # Staged first: the live table must not see rows that the gate holds back. What passes moves, and is not written again.
            staged = publish.write_stage(typed, to.stage)
            _require_whole(table, seen)
            stamp = project.load_stamp(at, full=False)
            publish.move_partition(spark, to.stage, to.live, stamp)
            _show(spark, table, staged, stamp)
            publish.delete(spark, to.stage)
    except Exception:
        _record(spark, table, at, audit.FAILED)
        raise
    _record(
        spark, table, at, audit.DONE, rows=extracted, pull_time=int(pulled - began), avro_size=publish.folder_bytes(spark, to.landing),
        parquet_time=int(time.monotonic() - pulled), parquet_size=publish.folder_bytes(spark, to.live),
    )
    publish.delete(spark, to.landing)
    return extracted


def _high_watermark(spark: SparkSession, table: Table, live: DataFrame):
    """From the spans kept of each load partition; a live folder without partitions is read."""
    if publish.PARTITION not in live.columns:
        return incremental.high_watermark(live, table.check_column)
    return marks.high_watermark(spark, table.folders.live, table.check_column, live.drop(publish.PARTITION).schema)


def _show(spark: SparkSession, table: Table, rows: DataFrame, stamp: str | None = None) -> None:
    """Make the load visible: an increment adds its one partition, a full load brings all up to date."""
    if not table.live_table:
        return
    if stamp and spark.catalog.tableExists(table.live_table):
        publish.add_partition(spark, table.live_table, stamp)
        spark.catalog.refreshTable(table.live_table)
    else:
        publish.register_live(spark, table.live_table, table.folders.live, rows.schema)
    for view in table.views:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {view}")
        views.view_over(spark, f"{view}.{table.live_table.split('.')[-1]}", table.live_table)


def export_out(
    lake: DataFrame, target_catalog: DataFrame, target: str, table: Table, at: dt.datetime, columns: list[str] | None = None
) -> DataFrame:
    """Check target and schema, export, check the count, write the export's audit row; gives the check."""
    spark = lake.sparkSession
    size_shuffles(lake)
    rows = project.without_system_columns(lake)
    rows = export.export_columns(rows, columns or rows.columns)
    declared = dict(zip([names.clean(f.name) for f in table.fields], project.lake_types(table.fields, table.vendor)))
    declared = {c: t.replace("TIMESTAMP_DATE", "TIMESTAMP").lower() for c, t in declared.items()}
    described = catalog.describe_frame(rows, table.name, declared).withColumn("vendor", F.lit(table.vendor))
    if not _passed(quality.before_export(described, target_catalog)):
        raise QualityError(f"the target of {table.name} does not match the lake table")
    began = time.monotonic()
    checked = loads.export_load(rows, target)
    outcome = checked.first()
    shape = spark.createDataFrame([], audit.EXPORT_AUDIT).schema
    row = {
        "directory": table.folders.live, "push_time": int(time.monotonic() - began), "txt_size": publish.folder_bytes(spark, target),
        "export_timestamp": _text(at), "row_count": outcome.target_rows, "domain": table.domain, "table_name": table.name,
        "current_repull": audit.DONE if outcome.count_ok else audit.FAILED,
    }
    changes = spark.createDataFrame([[row.get(f.name) for f in shape.fields]], shape)
    stores.replace_audit(
        spark, f"{table.audit_root}/export", changes, _text(at), audit.EXPORT_AUDIT, audit.EXPORT_KEYS, "export_timestamp"
    )
    return checked
