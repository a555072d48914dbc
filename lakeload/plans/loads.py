"""Whole loads: full, incremental, export."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions import names
from ..functions.literals import find
from ..operators import compare, incremental, project
from ..operators.project import Field
from ..sinks import export, publish
from ..sources import files


@dataclass(frozen=True)
class Folders:
    """Where one table's copies live."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def stage(self) -> str:
        return f"{self.root}/stage"

    @property
    def live(self) -> str:
        return f"{self.root}/live"

    @property
    def backup(self) -> str:
        return f"{self.root}/backup"


def stamped(landed: DataFrame, fields: list[Field], vendor: str, at: dt.datetime, full: bool) -> DataFrame:
    """Landing rows typed for the lake, with the two system columns."""
    typed = project.typed(landed, fields, vendor)
    return project.with_system_columns(typed, at.strftime("%Y-%m-%d %H:%M:%S"), project.load_stamp(at, full))


def observed(landed: DataFrame, fields: list[Field], vendor: str, at: dt.datetime, full: bool) -> tuple[DataFrame, Observation]:
    """``stamped`` rows, and what their write will have seen: the rows, and for each column the values that did not arrive whole.

    Such a value's lake type cannot hold it, or holds it only cut or rounded. It is counted
    while the rows are written; nothing is read again.
    """
    rows, flags = [], []
    for i, (f, lake) in enumerate(zip(fields, project.lake_types(fields, vendor))):
        landing = names.clean_for_landing(f.name)
        source, held = F.col(f"`{landing}`"), project.cast_to_lake(F.col(f"`{landing}`"), lake, vendor)
        bad = source.isNotNull() & held.isNull()
        if lake != "TIMESTAMP_DATE":
            bad = bad | ~compare.conforms(landed, landing, lake)
        rows.append(held.alias(names.clean(f.name)))
        flags.append(bad.alias(f"_bad_{i}"))
    seen = Observation()
    counts = [F.count_if(F.col(f"_bad_{i}")).alias(names.clean(f.name)) for i, f in enumerate(fields)]
    typed = landed.select(*rows, *flags).observe(seen, F.count(F.lit(1)).alias("_rows"), *counts)
    typed = typed.drop(*[f"_bad_{i}" for i in range(len(fields))])
    return project.with_system_columns(typed, at.strftime("%Y-%m-%d %H:%M:%S"), project.load_stamp(at, full)), seen


def full_load(source: DataFrame, fields: list[Field], vendor: str, to: Folders, at: dt.datetime) -> DataFrame:
    """Extract, check the count, cast, stage and publish; gives the live rows."""
    spark = source.sparkSession
    landed, extracted = files.land_counted(source, to.landing)
    compare.require_equal_counts(extracted, landed.count())
    staged = publish.write_stage(stamped(landed, fields, vendor, at, full=True), to.stage)
    publish.swap(spark, to.stage, to.live, to.backup)
    return publish.read_partitioned(spark, to.live, staged.schema)


def incremental_load(
    source: DataFrame, fields: list[Field], vendor: str, check_column: str, to: Folders, at: dt.datetime
) -> DataFrame | None:
    """Load the rows above the live table's mark as one more partition; None if there are none.

    ``at`` is fixed before the extract, so a run past midnight keeps one partition.
    """
    spark = source.sparkSession
    live = spark.read.parquet(to.live)
    mark = incremental.high_watermark(live, check_column)
    newer = incremental.above(source, check_column, mark)
    landed = files.land(newer, to.landing)
    if landed.isEmpty():
        return None
    return publish.merge_partition(stamped(landed, fields, vendor, at, full=False), to.live)


def export_load(lake: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """Insert export to an empty lake folder, checked by count; gives the check."""
    spark = lake.sparkSession
    rows = project.without_system_columns(lake)
    rows = export.export_columns(rows, columns or rows.columns)
    if publish.exists(spark, target):
        export.require_empty(spark.read.schema(rows.schema).parquet(target))
    written = export.insert_rows(rows, target)
    return compare.count_check(compare.two_counts(rows, written, []))


def load_report(landing: DataFrame, staged: DataFrame, fields: list[Field], vendor: str) -> DataFrame:
    """Did the load arrive, typed and complete? One row per column, from one scan of each side.

    ``lost`` counts the texts the lake type could not hold at all, ``unfit`` those it can only
    hold cut or rounded, as well.
    """
    shown = dict(zip([names.clean(f.name) for f in fields], project.lake_types(fields, vendor)))
    plain = {n: t.replace("TIMESTAMP_DATE", "TIMESTAMP") for n, t in shown.items()}
    landed = landing.select(
        *[F.col(f"`{names.clean_for_landing(f.name)}`").alias(names.clean(f.name)) for f in fields]
    )
    unfit = {c: F.count_if(~compare.conforms(landed, c, t)) for c, t in plain.items()}
    source = _per_column(landed, plain, "source_rows", lambda c: {"_source": F.count(c), "unfit": unfit[c]})
    target = _per_column(staged, plain, "target_rows", lambda c: {"_target": F.count(c)})
    return compare.count_check(source.join(target, "column_name")).select(
        "column_name",
        find(plain, F.col("column_name")).alias("lake_type"),
        "source_rows",
        "target_rows",
        "count_ok",
        (F.col("_source") - F.col("_target")).alias("lost"),
        "unfit",
    )


def _per_column(df: DataFrame, columns, count: str, measures) -> DataFrame:
    """One aggregate over the table, turned into a row of measures per column."""
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[m.alias(n) for n, m in measures(c).items()], F.count("*").alias(count))
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
