import pytest
from pyspark.sql import functions as F

from lakeload.operators import compare, reconcile
from test_compare import LAKE, _lake_rows, _text_rows

TYPES = {"id": "BIGINT", "v": "VARCHAR(20)", "n": "DOUBLE"}


def _pair(spark, rows, changed):
    source = spark.range(rows).select("id", F.concat(F.lit("v"), F.col("id") % 97).alias("v"), (F.col("id") / 7).alias("n"))
    target = source.withColumn("v", F.when(F.col("id") % changed == 5, F.concat("v", F.lit("!"))).otherwise(F.col("v")))
    return source, target


def _same(source, target, keys, lake, **more):
    want = compare.match_rows(source, target, keys, lake).collect()
    got = reconcile.reconcile(source, target, keys, lake, **more).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    return got


def test_few_faulty_rows_move_few_rows(spark):
    source, target = _pair(spark, 200_000, 1000)
    some_source, some_target, alike = reconcile.suspects(source, target, ["id"], TYPES)
    moved = some_source.count()
    assert 200 <= moved < 0.02 * 200_000 and moved == some_target.count() and alike.count() == 200_000 - moved
    got = reconcile.reconcile(source, target, ["id"], TYPES)
    assert got.where("NOT row_ok").count() == 200 and got.count() == 200_000


@pytest.mark.parametrize("leaf_rows", [1, 64, 10_000])
def test_verdicts_are_those_of_the_whole_join(spark, leaf_rows):
    source, target = _pair(spark, 3000, 50)
    target = target.where("id % 71 <> 3").unionByName(target.where("id % 83 = 1"))
    target = target.unionByName(target.limit(1).withColumn("id", F.lit(-9).cast("long")))
    _same(source, target, ["id"], TYPES, leaf_rows=leaf_rows)
    _same(source, source, ["id"], TYPES, leaf_rows=leaf_rows)
    _same(source, target.limit(0), ["id"], TYPES, leaf_rows=leaf_rows)
    _same(source.limit(0), target, ["id"], TYPES, leaf_rows=leaf_rows)


def test_text_and_typed_rows_meet_in_their_buckets(spark):
    import datetime as dt
    import decimal

    noon = dt.datetime(2016, 1, 2, 12, 0, 0)
    target = _lake_rows(spark, *[(i, decimal.Decimal(i) / 4, "ab   ", None if i % 5 == 0 else "x", noon, i / 8) for i in range(40)])
    source = _text_rows(spark, *[(i, f" {i / 4} ", "ab", "(null)" if i % 5 == 0 else " x", "2016-01-02 12:00:00", "oops" if i == 9 else str(i / 8)) for i in range(40)])
    got = _same(source, target, ["id"], LAKE)
    assert sum(not r.row_ok for r in got) == 1
    assert reconcile.suspects(source, target, ["id"], LAKE)[0].count() == 1


def test_keys_that_are_null_or_swapped(spark):
    source = spark.createDataFrame([(None, "a", 1.0), (1, "a", 1.0), (2, "b", 2.0), (3, None, None)], "id long, v string, n double")
    target = spark.createDataFrame([(None, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (3, None, None)], "id long, v string, n double")
    got = {r.id: r.row_ok for r in _same(source, target, ["id"], TYPES)}
    assert got == {None: False, 1: False, 2: False, 3: True}


def test_equal_rows_cross_no_join(spark):
    source, _ = _pair(spark, 5000, 50)
    some_source, some_target, alike = reconcile.suspects(source, source, ["id"], TYPES)
    assert some_source.isEmpty() and some_target.isEmpty() and alike.count() == 5000
