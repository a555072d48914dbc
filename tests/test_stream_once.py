"""Rows that arrive again or behind the mark: each key once, late ones apart, and a restart changes nothing."""

import datetime as dt

from pyspark.sql import functions as F

from lakeload.sinks import publish
from lakeload.streaming import ingest

SCHEMA = "k bigint, at timestamp_ntz, v string"
DAY = dt.datetime(2024, 1, 1)


def _rows(*pairs):
    return [(k, None if h is None else DAY + dt.timedelta(hours=h), f"v{k}") for k, h in pairs]


DROPS = [
    _rows((1, 0), (2, 10), (2, 10), (3, 48), (None, 48)),
    # 3 and the row without a key again, 4 within the delay, 5 far behind, 1 far behind but known, 6 without a time.
    _rows((3, 48), (None, 48), (4, 40), (5, 1), (5, 1), (1, 0), (6, None), (7, 60)),
    _rows((5, 1), (6, None), (7, 60), (8, 70), (2, 10), (9, 2)),
]


def _run(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    ingest.run_each_once(spark, f"{folder}/in", schema, f"{folder}/live", f"{folder}/late", f"{folder}/cp", ["k"], "at", "12 HOURS", files_per_batch=1)
    read = lambda name: sorted(publish.read_partitioned(spark, f"{folder}/{name}", schema).select("k", publish.PARTITION).collect(), key=str)
    return [tuple(r) for r in read("live")], [tuple(r) for r in read("late")] if publish.exists(spark, f"{folder}/late") else []


def test_each_key_once_and_late_rows_apart(spark, folder):
    for drop in DROPS:
        spark.createDataFrame(drop, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        live, late = _run(spark, folder)
    assert set(live) == {
        (1, "batch_0"), (2, "batch_0"), (3, "batch_0"), (None, "batch_0"), (4, "batch_1"), (7, "batch_1"), (8, "batch_2")
    }
    assert set(late) == {(5, "batch_1"), (6, "batch_1"), (9, "batch_2")} and len(late) == 3 and len(live) == 7
    # Nothing new to take up, then the last batch forgotten by the checkpoint and taken up again.
    assert _run(spark, folder) == (live, late)
    for log in ("commits", "offsets"):
        publish.delete(spark, f"{folder}/cp/{log}/2")
        publish.delete(spark, f"{folder}/cp/{log}/.2.crc")
    publish.delete(spark, f"{folder}/cp/sources/0/2")
    publish.delete(spark, f"{folder}/cp/sources/0/.2.crc")
    assert _run(spark, folder) == (live, late)


def test_an_empty_drop_and_one_of_late_rows_alone(spark, folder):
    for drop in ([], DROPS[0], _rows((11, 1), (1, 0))):
        spark.createDataFrame(drop, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        live, late = _run(spark, folder)
    assert len(live) == 4 and [k for k, _ in late] == [11]


def test_newest_row_of_a_key(spark):
    df = spark.createDataFrame(_rows((1, 0), (1, 5), (None, 1), (None, 2)), SCHEMA)
    assert {(r.k, r.at.hour) for r in ingest.newest_of_key(df, ["k"], "at").collect()} == {(1, 5), (None, 2)}
