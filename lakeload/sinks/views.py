"""Views over live tables and team copies of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from . import marks
from .publish import PARTITION, merge_partition, read_partitioned

INGESTED_AT = "ingest_timestamp"


def view_over(spark: SparkSession, view: str, table: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    return spark.table(view)


def filtered_view(spark: SparkSession, view: str, table: str, columns: list[str], where: str) -> DataFrame:
    """A view of some columns and rows; both reach the scan below it."""
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {listed} FROM {table} WHERE {where}")
    return spark.table(view)


def copy_full(source: DataFrame, path: str) -> DataFrame:
    """(Re)create a team's copy, in the source's own load partitions."""
    source.write.mode("overwrite").partitionBy(PARTITION).parquet(path)
    return read_partitioned(source.sparkSession, path, source.schema)


def copy_newer(source: DataFrame, path: str) -> DataFrame:
    """Bring a team's copy up to date with the rows ingested after its newest one."""
    spark = source.sparkSession
    newest = read_partitioned(spark, path, source.schema).agg(F.max("ingest_timestamp")).first()[0]
    newer = source if newest is None else source.where(F.col("ingest_timestamp") > F.lit(newest))
    return merge_partition(newer, path)


def copy_new_loads(spark: SparkSession, live: str, path: str, schema: T.StructType) -> DataFrame:
    """``copy_newer`` from the kept spans of both sides: only load partitions that reach behind the copy's newest row are read.

    Such a partition is copied whole, so rows of one load that were ingested at several times stay together.
    """
    newest = marks.spans(spark, path, INGESTED_AT, schema).agg(F.max("high")).first()[0]
    loads = marks.spans(spark, live, INGESTED_AT, schema).where("n_rows > 0")
    if newest is not None:
        loads = loads.where(F.col("high") > F.lit(newest))
    labels = sorted(r[0] for r in loads.select(PARTITION).collect())
    if labels:
        merge_partition(read_partitioned(spark, live, schema).where(F.col(PARTITION).isin(labels)), path)
    return read_partitioned(spark, path, schema)
