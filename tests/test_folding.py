"""Folded stores: the same rows in few files, whatever is appended or broken off meanwhile."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeload.operators import audit
from lakeload.plans import folding, stores

SCHEMA, UNIT = "v long, batch string", ["batch"]


def _append(spark, path, batch, low, high):
    spark.range(low, high).select(F.col("id").alias("v")).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _values(spark, path):
    return sorted((r.batch, r.v) for r in folding.read_folded(spark, path, SCHEMA, UNIT).collect())


def _files(path):
    return len(list(Path(path).rglob("*.parquet"))) + len(list(Path(f"{path}_folded").rglob("*.parquet")))


def test_many_appends_leave_few_files(spark, folder):
    path = f"{folder}/log"
    for turn in range(4):
        for i in range(10):
            _append(spark, path, f"t{turn}-{i}", i, i + 3)
        dropped = folding.fold(spark, path, SCHEMA, UNIT)
        assert dropped == (0 if turn == 0 else 10)
        assert _files(path) <= 10 + 2
        assert len(_values(spark, path)) == 30 * (turn + 1)
    assert folding.fold(spark, path, SCHEMA, UNIT) == 10
    assert folding.fold(spark, path, SCHEMA, UNIT) == 0
    assert len(_values(spark, path)) == 120 and len(list(Path(path).rglob("*.parquet"))) == 0


def test_a_unit_appended_again_counts_as_it_is_now(spark, folder):
    path = f"{folder}/log"
    _append(spark, path, "a", 0, 3)
    _append(spark, path, "b", 5, 6)
    folding.fold(spark, path, SCHEMA, UNIT)
    _append(spark, path, "a", 10, 12)
    assert _values(spark, path) == [("a", 10), ("a", 11), ("b", 5)]
    # The folder of a stays: the first generation holds other rows of it.
    assert folding.fold(spark, path, SCHEMA, UNIT) == 1
    assert _values(spark, path) == [("a", 10), ("a", 11), ("b", 5)]
    assert folding.fold(spark, path, SCHEMA, UNIT) == 1
    assert _values(spark, path) == [("a", 10), ("a", 11), ("b", 5)]


def test_a_fold_broken_off_is_no_generation(spark, folder):
    path = f"{folder}/log"
    _append(spark, path, "a", 0, 3)
    folding.fold(spark, path, SCHEMA, UNIT)
    _append(spark, path, "b", 3, 4)
    half = Path(f"{path}_folded/generation=0000000002")
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half a file")
    assert [v for _, v in _values(spark, path)] == [0, 1, 2, 3]
    folding.fold(spark, path, SCHEMA, UNIT)
    assert [v for _, v in _values(spark, path)] == [0, 1, 2, 3]


def test_an_append_during_a_fold_stays(spark, folder, monkeypatch):
    path = f"{folder}/log"
    _append(spark, path, "a", 0, 3)
    folding.fold(spark, path, SCHEMA, UNIT)
    found = folding._folders_in

    def meanwhile(*args):
        needless = found(*args)
        _append(spark, path, "late", 7, 8)
        return needless

    monkeypatch.setattr(folding, "_folders_in", meanwhile)
    assert folding.fold(spark, path, SCHEMA, UNIT) == 1
    assert [v for _, v in _values(spark, path)] == [0, 1, 2, 7]


def test_empty_and_missing_stores(spark, folder):
    assert folding.read_folded(spark, f"{folder}/none", SCHEMA, UNIT).count() == 0
    assert folding.fold(spark, f"{folder}/none", SCHEMA, UNIT) == 0
    assert folding.read_folded(spark, f"{folder}/none", SCHEMA, UNIT).count() == 0


@pytest.mark.parametrize("folds", [0, 1, 2])
def test_history_is_the_same_folded(spark, folder, folds):
    shape = spark.createDataFrame([], audit.AUDIT).schema
    at = lambda day: dt.datetime(2016, 1, day).strftime("%Y-%m-%d %H:%M:%S")
    for day in range(1, 5):
        row = {"domain": "crm", "table": "customer", "ingest_timestamp": at(day), "rows": day, "current_repull": 0}
        changes = spark.createDataFrame([[row.get(f.name) for f in shape.fields]], shape)
        stores.replace_audit(spark, folder, changes, at(day))
        if day > 4 - folds:
            stores.fold_history(spark, folder)
    history = sorted((r.archived_at, r.rows) for r in stores.read_history(spark, folder).collect())
    assert history == [(at(2), 1), (at(3), 2), (at(4), 3)]
