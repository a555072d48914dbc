import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeload.operators import project
from lakeload.plans import loads
from lakeload.plans.steps import run_steps, unique_name
from lakeload.sinks import export, publish, views
from lakeload.sources import files
from lakeload.streaming import ingest

AT = dt.datetime(2016, 1, 1, 16, 47, 56)
FIELDS = [project.Field("id", "BIGINT"), project.Field("v", "VARCHAR", 10)]


def _rows(spark, ids, value="a"):
    return spark.createDataFrame([(i, f"{value}{i}") for i in ids], "id long, v string")


def _stamped(df, stamp, time="2016-01-01 00:00:00"):
    return project.with_system_columns(df, time, stamp)


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_labels_are_read_back_as_text(spark, folder):
    staged = publish.write_stage(_stamped(_rows(spark, [1]), "20160101164756"), f"{folder}/s")
    assert staged.first().incr_ingest_timestamp == "20160101164756"
    assert project.load_stamp(AT, True) == "full_20160101164756" and project.load_stamp(AT, False) == "20160101164756"


def test_swap_keeps_one_backup_and_restore_is_its_inverse(spark, folder):
    stage, live, backup = (f"{folder}/{n}" for n in ("stage", "live", "backup"))
    schema = None
    for ids in ([1], [2], [3]):
        schema = publish.write_stage(_stamped(_rows(spark, ids), "full_1"), stage).schema
        publish.swap(spark, stage, live, backup)
    read = lambda path: _ids(publish.read_partitioned(spark, path, schema))
    assert read(live) == [3] and read(backup) == [2]
    assert sorted(os.listdir(folder)) == ["backup", "live"]
    publish.restore(spark, live, backup)
    assert read(live) == [2] and read(backup) == [3]
    publish.restore(spark, live, backup)
    assert read(live) == [3] and read(backup) == [2]


def test_a_failed_swap_leaves_live_and_backup_as_they_were(spark, folder, monkeypatch):
    stage, live, backup = (f"{folder}/{n}" for n in ("stage", "live", "backup"))
    for ids in ([1], [2]):
        schema = publish.write_stage(_stamped(_rows(spark, ids), "full_1"), stage).schema
        publish.swap(spark, stage, live, backup)
    publish.write_stage(_stamped(_rows(spark, [3]), "full_1"), stage)
    real = publish.rename

    def failing(session, old, new):
        if old == stage:
            raise OSError("disk")
        real(session, old, new)

    monkeypatch.setattr(publish, "rename", failing)
    with pytest.raises(OSError):
        publish.swap(spark, stage, live, backup)
    assert _ids(publish.read_partitioned(spark, live, schema)) == [2]
    assert _ids(publish.read_partitioned(spark, backup, schema)) == [1]
    with pytest.raises(FileNotFoundError):
        publish.swap(spark, f"{folder}/nothing", live, backup)


@pytest.mark.parametrize("fails_at", [1, 2, 3])
def test_a_swap_broken_off_anywhere_can_be_repeated(spark, folder, monkeypatch, fails_at):
    """The process dies at the n-th rename, with no chance to put anything back."""
    stage, live, backup = (f"{folder}/{n}" for n in ("stage", "live", "backup"))
    for ids in ([1], [2]):
        schema = publish.write_stage(_stamped(_rows(spark, ids), "full_1"), stage).schema
        publish.swap(spark, stage, live, backup)
    publish.write_stage(_stamped(_rows(spark, [3]), "full_1"), stage)
    real, calls = publish.rename, []

    class Killed(BaseException):
        pass

    def dying(session, old, new):
        calls.append(new)
        if len(calls) == fails_at:
            raise Killed
        real(session, old, new)

    monkeypatch.setattr(publish, "rename", dying)
    with pytest.raises(Killed):
        publish.swap(spark, stage, live, backup)
    monkeypatch.setattr(publish, "rename", real)
    publish.swap(spark, stage, live, backup)
    assert _ids(publish.read_partitioned(spark, live, schema)) == [3]
    assert _ids(publish.read_partitioned(spark, backup, schema)) == [2]
    assert sorted(os.listdir(folder)) == ["backup", "live"]


def test_publishing_by_pointing_moves_nothing(spark, folder):
    view, seen = unique_name("live"), []
    for n in (1, 2):
        path = f"{folder}/v{n}"
        schema = publish.write_stage(_stamped(_rows(spark, [n]), "full_1"), path).schema
        seen.append(_ids(publish.point_live(spark, view, f"{view}_v{n}", path, schema)))
    assert seen == [[1], [2]]
    assert _ids(views.view_over(spark, view, f"{view}_v1")) == [1]


def test_merging_a_partition_leaves_the_others_and_can_be_repeated(spark, folder):
    live = f"{folder}/live"
    publish.write_stage(_stamped(_rows(spark, [1, 2]), "full_1"), live)
    for _ in range(2):
        merged = publish.merge_partition(_stamped(_rows(spark, [3]), "2"), live)
        assert _ids(merged) == [1, 2, 3]
    assert _ids(publish.merge_partition(_stamped(_rows(spark, [4]), "2"), live)) == [1, 2, 4]


def test_live_table_partitions_can_be_dropped(spark, folder):
    live, table = f"{folder}/live", unique_name("t")
    publish.write_stage(_stamped(_rows(spark, [1]), "full_1"), live)
    schema = publish.merge_partition(_stamped(_rows(spark, [2]), "20160101000000"), live).schema
    assert _ids(publish.register_live(spark, table, live, schema)) == [1, 2]
    publish.drop_partition(spark, table, "20160101000000")
    publish.drop_partition(spark, table, "no such load")
    assert _ids(spark.table(table)) == [1]
    view = views.view_over(spark, unique_name("v"), table)
    assert _ids(view) == [1]
    assert publish.analyze(spark, table)[1] == 1


def test_partition_sizes_and_the_newest(spark, folder):
    live = f"{folder}/live"
    publish.write_stage(_stamped(_rows(spark, range(100)), "full_20160101000000"), live)
    publish.merge_partition(_stamped(_rows(spark, [1]), "20150101000000"), live)
    sizes = {r.incr_ingest_timestamp: r for r in publish.partition_sizes(spark, live).collect()}
    assert set(sizes) == {"full_20160101000000", "20150101000000"}
    on_disk = sum(
        os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{live}/incr_ingest_timestamp=20150101000000") for f in fs if f.endswith(".parquet")
    )
    assert sizes["20150101000000"].n_bytes == on_disk
    assert publish.newest_partition_size(publish.partition_sizes(spark, live)).first().incr_ingest_timestamp == "full_20160101000000"


def test_full_then_incremental_then_nothing_new(spark, folder):
    to = loads.Folders(folder)
    loads.full_load(_rows(spark, [1, 2]), FIELDS, "db2", to, AT)
    later = AT + dt.timedelta(days=1)
    merged = loads.incremental_load(_rows(spark, [1, 2, 3, 4]), FIELDS, "db2", "id", to, later)
    assert _ids(merged) == [1, 2, 3, 4]
    assert loads.incremental_load(_rows(spark, [1, 2, 3, 4]), FIELDS, "db2", "id", to, later + dt.timedelta(days=1)) is None
    assert {r[0] for r in merged.select("incr_ingest_timestamp").distinct().collect()} == {"full_20160101164756", "20160102164756"}


def test_export_needs_an_empty_target_and_is_counted(spark, folder):
    lake = _stamped(_rows(spark, [1, 2]), "full_1")
    check = loads.export_load(lake, f"{folder}/out").first()
    assert (check.source_rows, check.target_rows, check.count_ok) == (2, 2, True)
    assert spark.read.parquet(f"{folder}/out").columns == ["id", "v"]
    with pytest.raises(ValueError, match="already has rows"):
        loads.export_load(lake, f"{folder}/out")
    with pytest.raises(ValueError, match="nope"):
        export.export_columns(lake, ["nope"])


def test_upsert_and_update_need_a_key(spark, folder):
    target, changes = _rows(spark, [1, 2]), _rows(spark, [2, 3], "b")
    merged = export.upsert_rows(target, changes, ["id"], f"{folder}/u")
    assert sorted(r.v for r in merged.collect()) == ["a1", "b2", "b3"]
    updated = export.update_rows(target, changes, ["id"], f"{folder}/w")
    assert sorted(r.v for r in updated.collect()) == ["a1", "b2"]
    for change in (export.upsert_rows, export.update_rows):
        with pytest.raises(ValueError):
            change(target, changes, [], f"{folder}/x")


def _parse(line, separator):
    """Read an export line by its rules: an escaped character stands for itself, n and r for line breaks."""
    fields, text, i = [], "", 0
    if line == "":
        return [""]
    raw = ""
    while i <= len(line):
        if i == len(line) or line[i] == separator:
            fields.append(None if raw == "\\N" else text)
            text, raw = "", ""
        elif line[i] == "\\":
            c = line[i + 1]
            text += {"n": "\n", "r": "\r"}.get(c, c)
            raw += line[i : i + 2]
            i += 1
        else:
            text += line[i]
            raw += line[i]
        i += 1
    return fields


@pytest.mark.parametrize("separator", ["\x01", "|"])
def test_text_export_can_be_read_back(spark, folder, separator):
    values = [None, "", "\\N", "\\", "a|b", "x\x01y", "two\nlines", "cr\r\nlf", "\\n", "é|\\|", "end\\"]
    rows = [(i, a, b) for i, a in enumerate(values) for b in values[:6]]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    lines = [r.value for r in export.write_text(df, f"{folder}/t", separator).collect()]
    assert sorted(map(str, (_parse(line, separator) for line in lines))) == sorted(str([str(i), a, b]) for i, a, b in rows)


def test_team_copy_takes_only_newer_rows(spark, folder):
    old = _stamped(_rows(spark, [1]), "full_1", "2016-01-01 00:00:00")
    new = _stamped(_rows(spark, [2]), "2", "2016-01-02 00:00:00")
    views.copy_full(old, f"{folder}/c")
    changed = _stamped(_rows(spark, [9]), "full_1", "2016-01-01 00:00:00")
    assert _ids(views.copy_newer(changed.unionByName(new), f"{folder}/c")) == [1, 2]


def test_stream_takes_each_file_once(spark, folder):
    landing, live, checkpoint = (f"{folder}/{n}" for n in ("landing", "live", "cp"))
    schema = _rows(spark, [1]).schema
    for ids in ([1, 2], [3], []):
        if ids:
            _rows(spark, ids).coalesce(1).write.mode("append").parquet(landing)
        ingest.run_available(spark, landing, schema, live, checkpoint, lambda df: project.typed(df, FIELDS, "db2"))
    rows = publish.read_partitioned(spark, live, schema)
    assert _ids(rows) == [1, 2, 3]
    assert {r[0] for r in rows.select("incr_ingest_timestamp").distinct().collect()} == {"batch_0", "batch_1"}


def test_a_repeated_batch_is_stored_once(spark, folder):
    batch = _rows(spark, [1, 2]).withColumn("incr_ingest_timestamp", F.lit("batch_0"))
    for _ in range(2):
        live = publish.merge_partition(batch, f"{folder}/live")
    assert _ids(live) == [1, 2]


def test_steps_run_in_order_and_need_their_own_names(spark):
    start = {"t": spark.range(5)}
    steps = [("a", "SELECT id + 1 AS id FROM {t}"), ("b", lambda known: known["a"].where("id > 2")), ("c", "SELECT sum(id) AS s FROM {b}")]
    assert run_steps(spark, start, steps).first().s == 12
    with pytest.raises(ValueError, match="taken"):
        run_steps(spark, start, [("t", "SELECT 1")])
    with pytest.raises(ValueError):
        run_steps(spark, start, [])


def test_load_report_counts_what_was_lost(spark, folder):
    landing = files.land(spark.createDataFrame([("1", "a"), ("x", "b"), (None, "far too long a text")], "id string, v string"), f"{folder}/l")
    staged = publish.write_stage(_stamped(project.typed(landing, FIELDS, "db2"), "full_1"), f"{folder}/s")
    got = {r.column_name: (r.lake_type, r.source_rows, r.count_ok, r.lost, r.unfit) for r in loads.load_report(landing, staged, FIELDS, "db2").collect()}
    assert got == {"id": ("BIGINT", 3, True, 1, 1), "v": ("VARCHAR(10)", 3, True, 0, 1)}
