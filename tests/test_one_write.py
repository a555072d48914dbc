"""An increment is written once: its staged folder becomes the live partition."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeload.operators.project import Field
from lakeload.plans import chains
from lakeload.plans.chains import QualityError, Table
from lakeload.plans.loads import Folders
from lakeload.plans.steps import unique_name
from lakeload.sinks import publish

AT = dt.datetime(2016, 1, 1, 10)
FIELDS = [Field("ID", "NUMBER", None, 10, 0), Field("NAME", "VARCHAR2", 5)]


def _source(spark, ids, name="n"):
    return spark.createDataFrame([(i, f"{name}{i}") for i in ids], "ID long, NAME string").withColumn("ID", F.col("ID").cast("decimal(10,0)"))


def _stage(spark, path, stamp, low, high):
    rows = spark.range(low, high).withColumn(publish.PARTITION, F.lit(stamp))
    return publish.write_stage(rows, path)


def _held(spark, live):
    rows = publish.read_partitioned(spark, live, spark.createDataFrame([], "id long").schema)
    return sorted((r[publish.PARTITION], r.id) for r in rows.collect())


def test_a_chain_writes_the_increment_once(spark, folder, monkeypatch):
    table = Table("oracle", "crm", "customer", FIELDS, Folders(f"{folder}/customer"), f"{folder}/audit", check_column="ID")
    chains.ingest_full(_source(spark, range(3)), table, AT)
    monkeypatch.setattr(publish, "merge_partition", lambda *_: pytest.fail("written again"))
    files = []
    move = publish.move_partition

    def seen(spark, stage, live, stamp):
        files.extend(p.name for p in Path(stage).rglob("*.parquet"))
        move(spark, stage, live, stamp)

    monkeypatch.setattr(publish, "move_partition", seen)
    assert chains.ingest_increment(_source(spark, range(6)), table, AT + dt.timedelta(days=1)) == 3
    live = {p.name for p in Path(table.folders.live).rglob("*.parquet")}
    assert files and set(files) <= live
    assert not Path(table.folders.stage).exists()
    assert spark.read.parquet(table.folders.live).count() == 6


def test_a_failed_gate_leaves_live_as_it_was(spark, folder):
    table = Table("oracle", "crm", "customer", FIELDS, Folders(f"{folder}/customer"), f"{folder}/audit", check_column="ID")
    chains.ingest_full(_source(spark, range(3)), table, AT)
    before = sorted(p.name for p in Path(table.folders.live).rglob("*"))
    with pytest.raises(QualityError):
        chains.ingest_increment(_source(spark, range(6), "far too long "), table, AT + dt.timedelta(days=1))
    assert sorted(p.name for p in Path(table.folders.live).rglob("*")) == before


def test_a_repeated_move_replaces_its_partition_alone(spark, folder):
    stage, live = f"{folder}/stage", f"{folder}/live"
    for stamp, low, high in (("1", 0, 2), ("2", 5, 7), ("2", 8, 9)):
        _stage(spark, stage, stamp, low, high)
        publish.move_partition(spark, stage, live, stamp)
    assert _held(spark, live) == [("1", 0), ("1", 1), ("2", 8)]
    with pytest.raises(FileNotFoundError):
        publish.move_partition(spark, stage, live, "2")
    assert _held(spark, live) == [("1", 0), ("1", 1), ("2", 8)]


@pytest.mark.parametrize("broken_at", [1, 2])
def test_a_move_broken_off_can_be_repeated(spark, folder, monkeypatch, broken_at):
    stage, live = f"{folder}/stage", f"{folder}/live"
    _stage(spark, stage, "1", 0, 2)
    publish.move_partition(spark, stage, live, "1")
    _stage(spark, stage, "1", 5, 6)
    real, calls = publish.rename, []

    def failing(spark, old, new):
        calls.append(new)
        if len(calls) == broken_at:
            raise OSError("gone")
        real(spark, old, new)

    monkeypatch.setattr(publish, "rename", failing)
    with pytest.raises(OSError):
        publish.move_partition(spark, stage, live, "1")
    assert _held(spark, live) == [("1", 0), ("1", 1)]
    monkeypatch.setattr(publish, "rename", real)
    publish.move_partition(spark, stage, live, "1")
    assert _held(spark, live) == [("1", 5)]


def test_an_attached_partition_is_seen_whole_and_can_be_repeated(spark, folder):
    live, stage, again = f"{folder}/live", f"{folder}/stage", f"{folder}/again"
    first = _stage(spark, live, "1", 0, 2)
    table = unique_name("attached")
    publish.register_live(spark, table, live, first.schema)
    for place, low, high in ((stage, 5, 7), (again, 5, 9)):
        _stage(spark, place, "2", low, high)
        publish.attach_partition(spark, table, "2", f"{place}/{publish.partition_folder('2')}")
        assert sorted(r.id for r in spark.table(table).collect()) == [0, 1, *range(low, high)]
    assert [p.name for p in Path(live).glob("incr*")] == ["incr_ingest_timestamp=1"]
