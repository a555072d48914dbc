"""Team copies brought up to date by load partitions."""

from pathlib import Path

from pyspark.sql import functions as F

from lakeload.sinks import marks, publish, views


def _load(spark, path, stamp, rows):
    df = spark.createDataFrame([(k, t, stamp) for k, t in rows], f"k long, {views.INGESTED_AT} string, {publish.PARTITION} string")
    return publish.merge_partition(df, path).schema


def _rows(df):
    return sorted((r.k, r[publish.PARTITION]) for r in df.collect())


def test_only_loads_behind_the_copy_are_read(spark, folder, monkeypatch):
    live, copy = f"{folder}/live", f"{folder}/copy"
    schema = _load(spark, live, "full_20160101000000", [(1, "2016-01-01"), (2, "2016-01-01")])
    views.copy_full(publish.read_partitioned(spark, live, schema), copy)
    assert _rows(views.copy_new_loads(spark, live, copy, schema)) == [(1, "full_20160101000000"), (2, "full_20160101000000")]

    # One load whose rows were ingested at two times, one of them before the copy's newest.
    _load(spark, live, "20160102000000", [(3, "2016-01-02"), (4, "2015-12-31")])
    before = {p.name for p in Path(copy).rglob("*.parquet")}
    read, real = [], marks.refresh
    monkeypatch.setattr(marks, "refresh", lambda *a: read.append(real(*a)) or read[-1])
    got = views.copy_new_loads(spark, live, copy, schema)
    old = "full_20160101000000"
    assert _rows(got) == [(1, old), (2, old), (3, "20160102000000"), (4, "20160102000000")]
    # No partition of the copy and only the new one of the live table was looked into; the old files stay.
    assert read == [[], ["20160102000000"]] and before <= {p.name for p in Path(copy).rglob("*.parquet")}


def test_a_copy_that_is_up_to_date_is_not_written(spark, folder, monkeypatch):
    live, copy = f"{folder}/live", f"{folder}/copy"
    schema = _load(spark, live, "1", [(1, "2016-01-01")])
    views.copy_full(publish.read_partitioned(spark, live, schema), copy)
    monkeypatch.setattr(views, "merge_partition", None)
    assert views.copy_new_loads(spark, live, copy, schema).count() == 1


def test_an_empty_copy_takes_every_load(spark, folder):
    live, copy = f"{folder}/live", f"{folder}/copy"
    schema = _load(spark, live, "1", [(1, "2016-01-01")])
    _load(spark, live, "2", [(2, "2016-01-02")])
    views.copy_full(publish.read_partitioned(spark, live, schema).where(F.lit(False)), copy)
    assert [k for k, _ in _rows(views.copy_new_loads(spark, live, copy, schema))] == [1, 2]
