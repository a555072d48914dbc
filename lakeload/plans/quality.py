"""Quality checks in the order a load or an export runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import compare, sample
from ..session import settle

def _stage(df: DataFrame, name: str, ok: str) -> DataFrame:
    return df.select(*compare.table_key(df), F.lit(name).alias("stage"), F.col(ok).alias("passed"))


def full_load(source: DataFrame, lake: DataFrame) -> DataFrame:
    """After a full load: the schema. Its row count was checked when it landed."""
    return _stage(compare.schema_verdict(compare.schema_match(source, lake)), "ddl", "schema_ok")


def incremental(counts: DataFrame, source: DataFrame, increment: DataFrame, live: DataFrame) -> DataFrame:
    """After an increment: counts, then its schema against the increment and against the live table."""
    counted = compare.count_check(counts)
    return (
        _stage(counted, "count", "count_ok")
        .unionByName(_stage(compare.schema_verdict(compare.schema_match(source, increment)), "increment_ddl", "schema_ok"))
        .unionByName(_stage(compare.schema_verdict(compare.schema_match(source, live)), "live_ddl", "schema_ok"))
    )


def sampling(
    source: DataFrame, target: DataFrame, id_column: str, lake: dict[str, str], n: int = sample.SAMPLE_ROWS,
    misfits: int | None = None,
) -> DataFrame:
    """Sampled source rows found once in the lake and equal to it, and the lake's rows within their types.

    The sampled rows are drawn once. Their ids go into the row comparison as literals, so
    that scan of the lake table skips the files and row groups without them. ``misfits`` is the
    number of landed values that did not fit, where their cast has counted it: rows that were cast
    already always conform, so they are not asked.
    """
    sampled = settle(sample.sample_rows(source.select(*lake), [id_column], n), "sample")
    kind = dict(target.dtypes)[id_column]
    ids = [r[0] for r in sampled.select(F.col(id_column).try_cast(kind)).collect() if r[0] is not None]
    near = target.where(F.col(id_column).isin(ids))
    found = compare.find_sample(sampled, target, lake, id_column)
    matched = compare.match_rows(sampled, near, [id_column], lake)
    if misfits is None:
        conforming = compare.conformance(target, lake).agg(F.bool_and("conforms").alias("passed"))
    else:
        conforming = source.sparkSession.range(1).select(F.lit(misfits == 0).alias("passed"))
    return (
        found.agg(F.lit("row_found").alias("stage"), F.bool_and(F.col("n_matches") == 1).alias("passed"))
        .unionByName(matched.agg(F.lit("row_match").alias("stage"), F.bool_and("row_ok").alias("passed")))
        .unionByName(conforming.select(F.lit("conformance").alias("stage"), "passed"))
    )


def before_export(lake: DataFrame, target: DataFrame) -> DataFrame:
    """Before an insert export: schema, every target column nullable, same column names.

    A DB2 target has to pass all three, other targets the schema and the nullable columns.
    """
    matched = compare.schema_match(target, lake, "export")
    return (
        _stage(compare.schema_verdict(matched), "ddl", "schema_ok")
        .unionByName(_stage(compare.nullable_check(target), "ddl_null_check", "all_nullable"))
        .unionByName(_stage(compare.column_set_check(lake, target), "ddl_column", "columns_ok"))
    )


def after_export(counts: DataFrame) -> DataFrame:
    """After an export: lake rows against exported rows."""
    return compare.count_check(counts)


def status_json(stages: DataFrame) -> DataFrame:
    """One row per table with its stages as JSON, as the quality log keeps them."""
    names = F.array_sort(F.collect_list(F.struct("stage", "passed")))
    return stages.groupBy(*compare.table_key(stages)).agg(F.to_json(F.map_from_entries(names)).alias("status"))
