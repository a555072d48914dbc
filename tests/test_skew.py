"""A third of all rows under one key: adaptive execution has to be able to split that key."""

import pytest
from pyspark.sql import functions as F

from lakeload.operators import compare, merge, registry

SMALL = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture
def hot(spark, folder):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), "id", F.md5(F.col("id").cast("string")).alias("v")
    )
    rows.write.parquet(f"{folder}/hot")
    return spark.read.parquet(f"{folder}/hot")


def _split(df):
    rows = len(df.collect())
    return rows, "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_row_match_splits_a_hot_key(spark, hot, small_thresholds):
    rows, split = _split(compare.match_rows(hot, hot.where("id % 2 = 0"), ["key"], {"key": "BIGINT", "v": "STRING"}))
    assert rows == 60_000 and split


def test_keyed_changes_split_a_hot_key(spark, hot, small_thresholds):
    changes = hot.where("id % 3 = 1").withColumn("v", F.lit("new"))
    rows, split = _split(merge.upsert(hot, changes, ["key"]))
    assert rows == 60_000 and split
    rows, split = _split(merge.replace_present(hot, changes, ["key"]))
    assert rows == 60_000 and split


def test_request_status_splits_a_hot_table(spark, hot, small_thresholds):
    named = lambda df: df.select(F.lit("d").alias(registry.KEYS[0]), F.col("key").cast("string").alias(registry.KEYS[1]), F.lit("dev").alias(registry.KEYS[2]), "v")
    known = named(hot.where("id % 3 = 1")).withColumn("hold", F.lit(0))
    rows, split = _split(registry.request_status(named(hot), known))
    assert rows == 60_000 and split
