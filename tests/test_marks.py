"""Marks from kept spans: equal to a scan, and only changed partitions are read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeload.operators import incremental
from lakeload.sinks import marks, publish


def _load(spark, live, label, low, high, kind="bigint"):
    df = spark.range(low, high).select(F.col("id").cast(kind).alias("k"), F.lit("v").alias("v"), F.lit(label).alias(publish.PARTITION))
    publish.merge_partition(df, live)
    return df.drop(publish.PARTITION).schema


def test_only_changed_partitions_are_read(spark, folder):
    live = f"{folder}/live"
    schema = _load(spark, live, "full_20240101000000", 0, 100)
    _load(spark, live, "20240102000000", 100, 150)
    assert marks.refresh(spark, live, "k", schema) == ["20240102000000", "full_20240101000000"]
    assert marks.high_watermark(spark, live, "k", schema) == 149
    assert marks.refresh(spark, live, "k", schema) == []
    # A late load with older values, and one partition loaded again with others.
    _load(spark, live, "20240103000000", -50, 0)
    _load(spark, live, "20240102000000", 100, 130)
    assert marks.refresh(spark, live, "k", schema) == ["20240102000000", "20240103000000"]
    rows = publish.read_partitioned(spark, live, schema)
    assert marks.high_watermark(spark, live, "k", schema) == incremental.high_watermark(rows, "k") == 129
    publish.delete(spark, f"{live}/{publish.PARTITION}=20240102000000")
    assert marks.high_watermark(spark, live, "k", schema) == 99


def test_the_mark_reads_no_column_of_known_partitions(spark, folder):
    live = f"{folder}/live"
    schema = _load(spark, live, "a", 0, 100)
    marks.refresh(spark, live, "k", schema)
    plan = marks.spans(spark, live, "k", schema).agg(F.max("high"))._jdf.queryExecution().executedPlan().toString()
    assert "k:bigint" not in plan and "FileScan binaryFile" in plan.replace("Scan binaryFile", "FileScan binaryFile")


def test_overlapping_partitions(spark, folder):
    live = f"{folder}/live"
    for i in range(4):
        schema = _load(spark, live, f"p{i}", i * 10, i * 10 + 10)
    assert marks.overlapping(spark, live, "k", schema, 12, 25) == ["p1", "p2"]
    assert marks.overlapping(spark, live, "k", schema, 90, 95) == []


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(20,0)"])
def test_values_keep_their_type(spark, folder, kind):
    live = f"{folder}/live"
    made = {"date": "date_add(DATE '2024-01-01', CAST(id AS INT))", "decimal(20,0)": "CAST(id AS DECIMAL(20,0))"}
    values = made.get(kind, f"CAST(timestamp_micros(1704067200123456 + id) AS {kind})")
    df = spark.range(9).select(F.expr(values).alias("k"), F.lit("x y%+1").alias(publish.PARTITION))
    publish.merge_partition(df, live)
    rows = publish.read_partitioned(spark, live, df.schema)
    assert marks.high_watermark(spark, live, "k", df.drop(publish.PARTITION).schema) == incremental.high_watermark(rows, "k")


def test_partitions_of_nulls_and_an_empty_one(spark, folder):
    live = f"{folder}/live"
    df = spark.range(3).select(F.lit(None).cast("timestamp").alias("k"), F.lit("n").alias(publish.PARTITION))
    publish.merge_partition(df, live)
    schema = df.drop(publish.PARTITION).schema
    assert marks.high_watermark(spark, live, "k", schema) is None
    newer = df.withColumns({"k": F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"), publish.PARTITION: F.lit("m")})
    publish.merge_partition(newer, live)
    assert marks.high_watermark(spark, live, "k", schema) is not None
    with pytest.raises(ValueError):
        marks.high_watermark(spark, live, publish.PARTITION, schema)
