"""Sharding by jump consistent hashing: a key and the number of shards decide, no table is kept.

When one shard is appended, a key stays where it was or goes to the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.session import settle

_STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key among ``shards``, after Lamping and Veach."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = np.asarray(keys).astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    open_rows = np.arange(len(state))
    while len(open_rows):
        state[open_rows] = state[open_rows] * _STEP + np.uint64(1)
        draw = (state[open_rows] >> np.uint64(33)).astype(np.float64) + 1.0
        after = ((shard[open_rows] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        stays = after >= shards
        shard[open_rows[~stays]] = after[~stays]
        open_rows = open_rows[~stays]
    return shard


def with_shard(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """Add the shard of an integer key. A null key counts as -1."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards), dtype="int32")

    return df.withColumn(name, place(F.coalesce(F.col(key).cast("long"), F.lit(-1))))


def with_slot(df: DataFrame, shard: str, order: list[str], name: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in the given order.

    A shard may hold a third of all rows, so none is gathered: rows are dealt into sorted
    blocks by the order itself (rows that tie in all of it are dealt on by their place in the
    input), the blocks' counts give each block its first number, and numbers run within
    blocks. What is broadcast has one row for each shard and block.
    """
    spark = df.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = settle(df.withColumn("_at", F.monotonically_increasing_id()), "slots")
    rows = rows.repartitionByRange(blocks, *order, "_at").sortWithinPartitions(*order, "_at")
    rows = settle(rows.withColumn("_block", F.spark_partition_id()), "blocks")
    counts = rows.groupBy("_block", shard).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_block", shard, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("_block", shard).orderBy(*order, "_at")
    return (
        rows.join(F.broadcast(first), ["_block", shard])
        .withColumn(name, F.col("_first") + F.row_number().over(within) - 1)
        .drop("_block", "_at", "_first")
    )


def assign(documents: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Shard, slot and grown shard of every document, without its text.

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` their CRC; a null text counts
    as empty. Slots follow the id, then CRC and size; equal rows get slots next to each
    other. Null ids come first and share one shard. Other columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    narrow = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = with_shard(with_shard(narrow, "doc_id", shards), "doc_id", shards + 1, "grown_shard")
    out = with_slot(placed, "shard", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
