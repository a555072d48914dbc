"""Incremental ingest as a stream: each batch of new landing files becomes one partition, repeated and late rows apart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.incremental import mark_literal
from ..sinks import marks
from ..sinks.publish import PARTITION, exists, merge_partition, read_partitioned

BATCH_LABEL = "batch_"


def run_available(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    live: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int | None = None,
    label: str = BATCH_LABEL,
    ingest_time: str | None = None,
) -> None:
    """Take up every landing file not taken up before, then stop.

    Rows get both system columns: the partition label and ``ingest_timestamp``, which is
    ``ingest_time`` or else the time at which the run starts.

    The checkpoint remembers the files. The partition label ends in the batch number and the
    write replaces that partition, so a batch repeated after a failure is stored once. Take
    another label when the checkpoint is started anew, as its numbers then begin at 0 again.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = transform(reader.parquet(landing))
    started = ingest_time or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")

    def store(batch: DataFrame, batch_id: int) -> None:
        known = {"ingest_timestamp": F.lit(started), PARTITION: F.lit(f"{label}{batch_id}")}
        merge_partition(batch.withColumns(known), live)

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def newest_of_key(df: DataFrame, keys: list[str], event_time: str) -> DataFrame:
    """One row for each key, NULLs in it included: the newest, of equally new ones the least hash. A mergeable aggregate."""
    row = F.struct(*df.columns)
    order = F.struct(F.col(event_time), -F.xxhash64(*df.columns).cast("decimal(20,0)"))
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, order).alias("r")).select("r.*")


def unknown_to(df: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key ``held`` does not have; NULL equals NULL."""
    other = held.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(other, same, "left_anti")


def run_each_once(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    live: str,
    late: str,
    checkpoint: str,
    keys: list[str],
    event_time: str,
    delay: str,
    files_per_batch: int | None = None,
    label: str = BATCH_LABEL,
) -> None:
    """As ``run_available``, for sources that send rows again and rows behind the mark: each key arrives once.

    The mark is the live table's newest ``event_time`` before the batch. Rows at most ``delay``
    behind it are new if no live row within that delay has their key, so an inclusive extract may
    repeat the rows at the mark. Rows further behind, and rows without a time, go to the side
    table ``late``, again once each and only if the live table does not hold them.

    The live table itself is the state. Which partitions can hold a key's earlier arrival is
    read off their kept spans, so a batch reads the recent ones and those its late rows fall
    into. A batch never looks at its own partition: repeated after a failure, or with the
    checkpoint lost and the files taken up again under the same numbers, it stores the same rows.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    when = F.col(event_time)

    def held(path: str, labels: list[str]) -> DataFrame:
        return read_partitioned(spark, path, schema).where(F.col(PARTITION).isin(labels))

    def store(batch: DataFrame, batch_id: int) -> None:
        own = f"{label}{batch_id}"
        known = {PARTITION: F.lit(own)}
        mark = None
        if exists(spark, live):
            # One row for each earlier load, fixed here: the files it is read off may be replaced below.
            spans = marks.spans(spark, live, event_time, schema).where(F.col(PARTITION) != own)
            spans = spark.createDataFrame(spans.collect(), spans.schema)
            mark = spans.agg(F.max("high")).first()[0]
        if mark is None:
            merge_partition(newest_of_key(batch.where(when.isNotNull()), keys, event_time).withColumns(known), live)
            behind = when.isNull()
        else:
            kind = schema[event_time].dataType
            cutoff = mark_literal(mark).cast(kind) - F.expr(f"INTERVAL {delay}")
            recent = [r[0] for r in spans.where(F.col("high") >= cutoff).select(PARTITION).collect()]
            fresh = newest_of_key(batch.where(when >= cutoff), keys, event_time)
            merge_partition(unknown_to(fresh, held(live, recent).where(when >= cutoff), keys).withColumns(known), live)
            behind = when.isNull() | (when < cutoff)
        oldest = batch.where(behind).agg(F.count("*").alias("n"), F.min(event_time).alias("low")).first()
        if not oldest.n:
            return
        rows = newest_of_key(batch.where(behind), keys, event_time)
        if oldest.low is not None:
            touched = [r[0] for r in spans.where((F.col("high") >= mark_literal(oldest.low).cast(kind)) & (F.col("low") < cutoff)).select(PARTITION).collect()]
            rows = unknown_to(rows, held(live, touched).where(when < cutoff), keys)
        if exists(spark, late):
            rows = unknown_to(rows, read_partitioned(spark, late, schema).where(F.col(PARTITION) != own), keys)
        merge_partition(rows.withColumns(known), late)

    query = (
        reader.parquet(landing).writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
