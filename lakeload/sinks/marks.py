"""The span of a check column in every load partition, kept beside the live table.

A mark that is read from the rows costs a scan of every load ever made. Here each load partition
keeps its least and largest value, with a fingerprint of its files, and only partitions whose
files are not the ones the kept span was taken from are read. Late loads count like all others,
and a partition that was rerun, dropped or added by hand is noticed by its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators import incremental
from .publish import PARTITION, exists, read_partitioned

SPANS = f"files bigint, n_rows bigint, low string, high string, {PARTITION} string"


def store_of(live: str, check_column: str) -> str:
    return f"{live.rstrip('/')}_spans/{check_column}"


def listed(spark: SparkSession, live: str) -> DataFrame:
    """Each load partition with a fingerprint of its files' names, sizes and times. No file is opened."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(live)
        .select("path", "length", "modificationTime")
    )
    # Folder names escape by percent signs alone; a plus sign is itself.
    label = F.url_decode(F.replace(F.regexp_extract("path", f"/{PARTITION}=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))
    name = F.regexp_extract("path", "([^/]+)$", 1)
    print_ = F.xxhash64(name, "length", "modificationTime").cast("decimal(38,0)")
    return found.groupBy(label.alias(PARTITION)).agg(F.sum(print_).alias("s")).select(PARTITION, F.xxhash64("s").alias("files"))


def _kept(spark: SparkSession, store: str) -> DataFrame:
    if not exists(spark, store):
        return spark.createDataFrame([], SPANS)
    return spark.read.schema(SPANS).parquet(store)


def refresh(spark: SparkSession, live: str, check_column: str, schema: T.StructType) -> list[str]:
    """Read the partitions whose span is unknown or of other files, and keep theirs; gives their labels.

    The labels reach the driver, where Spark holds the listing of the same partitions anyway.
    """
    store = store_of(live, check_column)
    current = listed(spark, live)
    unknown = current.join(_kept(spark, store), [PARTITION, "files"], "left_anti").collect()
    if unknown:
        named = spark.createDataFrame([(r[PARTITION], r.files) for r in unknown], f"{PARTITION} string, files bigint")
        rows = read_partitioned(spark, live, schema).where(F.col(PARTITION).isin([r[PARTITION] for r in unknown]))
        spans = rows.groupBy(PARTITION).agg(
            F.count("*").alias("n_rows"), F.min(check_column).cast("string").alias("low"), F.max(check_column).cast("string").alias("high")
        )
        known = named.join(spans, PARTITION, "left").select("files", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "low", "high", PARTITION)
        known.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(store)
    return sorted(r[PARTITION] for r in unknown)


def spans(spark: SparkSession, live: str, check_column: str, schema: T.StructType) -> DataFrame:
    """Load partitions of the live table that are there now: ``n_rows``, ``low`` and ``high`` in the column's own type.

    Nothing of the live table's columns is read here but in partitions that ``refresh`` has to look at.
    """
    kind = schema[check_column].dataType
    refresh(spark, live, check_column, schema)
    kept = _kept(spark, store_of(live, check_column)).join(listed(spark, live), [PARTITION, "files"])
    return kept.select(PARTITION, "n_rows", F.col("low").cast(kind).alias("low"), F.col("high").cast(kind).alias("high"))


def high_watermark(spark: SparkSession, live: str, check_column: str, schema: T.StructType):
    """The live table's largest value, as ``incremental.high_watermark`` finds it, from the kept spans."""
    incremental.mode_of(spark.createDataFrame([], schema), check_column)
    return spans(spark, live, check_column, schema).agg(F.max("high")).first()[0]


def overlapping(spark: SparkSession, live: str, check_column: str, schema: T.StructType, low, high) -> list[str]:
    """Labels of the partitions that can hold a value from ``low`` to ``high``; the others need not be read."""
    held = spans(spark, live, check_column, schema)
    inside = held.where((F.col("low") <= incremental.mark_literal(high)) & (F.col("high") >= incremental.mark_literal(low)))
    return sorted(r[PARTITION] for r in inside.select(PARTITION).collect())
