import os

import pytest
from pyspark.sql import functions as F

from lakeload.sinks import export, publish, touched


def _folder(spark, folder, rows=5000, files=50):
    path = f"{folder}/a b%20c"
    spark.range(rows).select("id", F.concat(F.lit("v"), "id").alias("v"), (F.col("id") % 3).alias("p")).repartitionByRange(files, "id").write.parquet(path)
    return path


def _names(path):
    return {f for f in os.listdir(path) if f.endswith(".parquet")}


def _rows(spark, path):
    return {r.id: r.v for r in spark.read.parquet(path).collect()}


def test_one_file_of_fifty_is_rewritten(spark, folder):
    path = _folder(spark, folder)
    before = {f: os.stat(f"{path}/{f}").st_mtime_ns for f in _names(path)}
    changes = spark.createDataFrame([(7, "new", 0), (9, "new", 0)], "id long, v string, p long")
    out = touched.rewrite_touched(spark, path, changes, ["id"])
    assert (out.replaced, out.kept) == (1, 49) and out.rows < 300
    same = {f for f in _names(path) if before.get(f) == os.stat(f"{path}/{f}").st_mtime_ns}
    assert len(same) == 49
    assert _rows(spark, path) == {i: "new" if i in (7, 9) else f"v{i}" for i in range(5000)}
    assert not [f for f in os.listdir(path) if f.startswith("_") and f != "_SUCCESS"]


def test_only_row_groups_of_the_changes_range_are_opened(spark, folder):
    path = _folder(spark, folder)
    changes = spark.createDataFrame([(7,), (9,)], "id long")
    plan = touched.files_with(spark.read.parquet(path), changes, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,7), LessThanOrEqual(id,9)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_a_key_repeated_in_the_changes_is_one_row(spark, folder):
    path = _folder(spark, folder, 100, 4)
    changes = spark.createDataFrame([(5, "b", 1), (5, "a", 2), (200, "x", 0), (200, "y", 0), (None, "n", 0)], "id long, v string, p long")
    touched.rewrite_touched(spark, path, changes, ["id"])
    rows = spark.read.parquet(path).where("id IN (5, 200) OR id IS NULL").collect()
    assert sorted(map(tuple, rows), key=str) == [(200, "y", 0), (5, "b", 1), (None, "n", 0)]
    touched.rewrite_touched(spark, path, changes.where("id = 5"), ["id"], newest="p")
    assert _rows(spark, path)[5] == "a"
    whole = export.upsert_rows(spark.read.parquet(path), changes.where("id IS NOT NULL"), ["id"], f"{folder}/whole")
    assert whole.where("id IN (5, 200)").count() == 2


def test_an_update_adds_nothing_and_may_touch_nothing(spark, folder):
    path = _folder(spark, folder, 100, 4)
    changes = spark.createDataFrame([(1000, "x", 0)], "id long, v string, p long")
    assert touched.rewrite_touched(spark, path, changes, ["id"], insert=False) == touched.Rewrite(0, 4, 0)
    assert len(_rows(spark, path)) == 100
    assert touched.rewrite_touched(spark, path, changes.limit(0), ["id"]).rows == 0
    none = spark.createDataFrame([(None, "n", 0)], "id long, v string, p long")
    assert touched.rewrite_touched(spark, path, none, ["id"]) .replaced == 0
    assert spark.read.parquet(path).count() == 101


def test_rows_of_a_partitioned_folder_move_to_their_partition(spark, folder):
    path = f"{folder}/parts"
    spark.range(90).select("id", F.concat(F.lit("v"), "id").alias("v"), (F.col("id") % 3).alias("p")).write.partitionBy("p").parquet(path)
    changes = spark.createDataFrame([(4, "moved", 2), (500, "new", 7)], "id long, v string, p int")
    touched.rewrite_touched(spark, path, changes, ["id"], partition_by=("p",))
    rows = spark.read.parquet(path)
    assert rows.where("id = 4").select("v", "p").collect() == [("moved", "2")] and rows.where("p = 7").count() == 1
    assert rows.count() == 91 and rows.select("id").distinct().count() == 91


@pytest.mark.parametrize("at", ["before the note", "while files move", "while files go"])
def test_a_broken_rewrite_is_finished_or_taken_back(spark, folder, monkeypatch, at):
    path = _folder(spark, folder, 100, 4)
    changes = spark.createDataFrame([(1, "x", 0), (99, "x", 0)], "id long, v string, p long")
    name = {"before the note": "_note", "while files move": "rename", "while files go": "delete"}[at]
    where = touched if name == "_note" else publish
    real, calls = getattr(where, name), []

    def failing(*args):
        calls.append(args)
        if name == "_note" or len(calls) == (3 if name == "rename" else 2):
            raise OSError("gone")
        return real(*args)

    monkeypatch.setattr(where, name, failing)
    with pytest.raises(OSError):
        touched.rewrite_touched(spark, path, changes, ["id"])
    monkeypatch.undo()
    assert touched.finish(spark, path) == (at != "before the note")
    want = {i: "x" if i in (1, 99) and at != "before the note" else f"v{i}" for i in range(100)}
    assert _rows(spark, path) == want and spark.read.parquet(path).count() == 100
    assert not touched.finish(spark, path)
