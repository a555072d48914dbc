"""Nothing is lost without a word: the gate of the loads, whole decimals, NULLs in orders and keys."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from lakeload.functions import compat, types
from lakeload.operators import audit, catalog, compare, ordered, project, runlog
from lakeload.operators.project import Field
from lakeload.plans import chains, stores
from lakeload.plans.chains import QualityError, Table
from lakeload.plans.loads import Folders
from lakeload.plans.steps import unique_name
from lakeload.sinks import publish

AT = dt.datetime(2016, 1, 1, 10)


def test_unbounded_text_and_fractions_stay_whole(spark):
    fields = [Field("t", "varchar", -1), Field("n", "NUMBER"), Field("z", "NUMBER", None, 10, -2)]
    landing = spark.createDataFrame([("x" * 5_000, "12.34", "123456789000")], "t string, n string, z string")
    row = project.typed(landing, fields, "sqlserver").first()
    assert len(row.t) == 5_000 and float(row.n) == 12.34 and int(row.z) == 123456789000


def _table(folder, fields, **more):
    return Table("oracle", "crm", "customer", fields, Folders(f"{folder}/customer"), f"{folder}/audit", **more)


def test_a_load_with_values_that_do_not_fit_is_held_back(spark, folder):
    fields = [Field("ID", "NUMBER", None, 5, 0), Field("NAME", "VARCHAR2", 3)]
    good = spark.createDataFrame([("1", "abc"), ("2", None)], "ID string, NAME string")
    bad = spark.createDataFrame([("x", "abc"), ("4", "ten letters")], "ID string, NAME string")
    chains.ingest_full(good, _table(folder, fields), AT)
    with pytest.raises(QualityError, match="ID 1, NAME 1"):
        chains.ingest_full(bad, _table(folder, fields), AT + dt.timedelta(days=1))
    assert spark.read.parquet(f"{folder}/customer/live").count() == 2
    assert stores.read_store(spark, f"{folder}/audit/ingest", audit.AUDIT).first().current_repull == audit.FAILED
    chains.ingest_full(bad, _table(folder, fields, tolerated=2), AT + dt.timedelta(days=2))
    assert spark.read.parquet(f"{folder}/customer/live").count() == 2


def test_an_increment_with_values_that_do_not_fit_leaves_live_as_it_was(spark, folder):
    fields = [Field("ID", "NUMBER", None, 5, 0), Field("NAME", "VARCHAR2", 3)]
    table = _table(folder, fields, check_column="ID")
    rows = lambda *r: spark.createDataFrame(r, "ID int, NAME string")
    chains.ingest_full(rows((1, "a"), (2, "b")), table, AT)
    with pytest.raises(QualityError):
        chains.ingest_increment(rows((1, "a"), (3, "too long")), table, AT + dt.timedelta(days=1))
    assert spark.read.parquet(table.folders.live).count() == 2
    assert chains.ingest_increment(rows((1, "a"), (3, "c")), table, AT + dt.timedelta(days=2)) == 1


def test_decimals_are_compared_in_their_own_type(spark):
    whole, other = "12345678901234567890123456789012345678", "99999999999999999999999999999999999999"
    cases = [
        ("DECIMAL(38,0)", whole, other, False), ("DECIMAL(38,0)", whole, whole, True), ("DECIMAL(38,0)", "x", "y", False),
        ("DECIMAL(38,0)", "x", None, False), ("DECIMAL(20,12)", "1.123456789012", "1.123456789013", False), ("DECIMAL(20,12)", "1.5", "1.500", True),
    ]
    for lake, one, two, same in cases:
        source = spark.createDataFrame([(1, one)], "k int, v string")
        for target in (source.sparkSession.createDataFrame([(1, two)], "k int, v string"),):
            kinds = {"k": "INT", "v": lake}
            assert compare.match_rows(source, target, ["k"], kinds).first().row_ok == same, (lake, one, two)
            typed = target.withColumn("v", F.col("v").try_cast(lake.lower()))
            if two not in ("y", None):
                assert compare.match_rows(source, typed, ["k"], kinds).first().row_ok == same, (lake, one, two)
    long_key = spark.createDataFrame([(whole, 1)], "k string, v int")
    typed_key = long_key.withColumn("k", F.col("k").cast("decimal(38,0)"))
    assert compare.match_rows(long_key, typed_key, ["k"], {"k": "DECIMAL(38,0)", "v": "INT"}).first().row_ok


def test_a_text_table_is_looked_up_by_its_id(spark):
    rows = spark.createDataFrame([("1", "a", ""), ("2", "b", "x"), (None, "c", "y")], "id string, v string, w string")
    found = compare.find_sample(rows, rows, {"id": "STRING", "v": "STRING", "w": "VARCHAR(3)"}, "id")
    assert {r.id: r.n_matches for r in found.collect()} == {"1": 1, "2": 1, None: 0}
    assert "BroadcastNestedLoopJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_an_empty_table_passes_its_count(spark):
    empty = spark.createDataFrame([], "k int")
    row = compare.count_check(compare.two_counts(empty, empty, [])).first()
    assert (row.source_rows, row.target_rows, row.count_ok) == (0, 0, True)


def test_looking_ahead_keeps_rows_with_nulls(spark):
    rows = [("a", 1, "p"), ("a", None, "q"), ("a", 3, "r"), (None, 2, "s"), (None, 1, "t"), ("b", None, "u")]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    got = {r.v: r.next_v for r in ordered.next_value(df, ["k"], ["o", "v"], "v").collect()}
    # In order: p, r, then q without an order value; t, s under the NULL key.
    assert got == {"p": "r", "r": "q", "q": None, "t": "s", "s": None, "u": None}


def test_a_malformed_time_is_no_time(spark):
    df = spark.createDataFrame([("Wed, 30 Sep 2015 19:01:00 GMT",), ("soon",), (None,)], "t string")
    assert [r[0] for r in df.select(runlog.seconds_of(F.col("t"))).collect()] == [1443639660, None, None]


def test_two_registry_rows_leave_an_audit_row_single(spark):
    shape = audit.AUDIT
    row = {"domain": "d", "table": "t", "lifespan": "x"}
    current = spark.createDataFrame([tuple(row.get(f.name) for f in spark.createDataFrame([], shape).schema)], shape)
    registry = spark.createDataFrame([("d", "t", "010001"), ("d", "t", "010001")], "domain string, source_table_name string, load string")
    assert audit.with_lifespan(current, registry).count() == 1


def test_every_type_the_map_knows_may_be_loaded(spark):
    vendors = ("oracle", "db2", "teradata", "sqlserver", "postgresql", "mysql")
    rows = [(v, t) for v, t in itertools.product(vendors, types.pairs())]
    df = spark.createDataFrame(rows, "vendor string, t string").withColumn("lake", types.lake_type(F.col("t")))
    lake = F.when(F.col("lake") == "TIMESTAMP_DATE", "TIMESTAMP").otherwise(F.col("lake"))
    refused = df.where(~compat.is_allowed(F.col("vendor"), lake, F.col("t"))).collect()
    assert not refused


def test_lake_tables_are_described_in_lake_types(spark):
    df = spark.createDataFrame([], "id bigint, at timestamp_ntz, flag string, v string")
    got = {r.column_name: (r.data_type, r.char_length) for r in catalog.describe_frame(df, "t", {"flag": "char(1)"}).collect()}
    assert got == {"id": ("BIGINT", None), "at": ("TIMESTAMP", None), "flag": ("CHAR", 1), "v": ("STRING", None)}


def test_a_table_with_times_and_fixed_text_can_be_exported(spark, folder):
    lake = spark.sql("SELECT 1L AS id, TIMESTAMP_NTZ '2016-01-01 00:00:00' AS at, 'x' AS flag")
    columns = "vendor string, table_name string, ordinal int, column_name string, data_type string, char_length int, num_precision int, num_scale int, nullable string, is_identity boolean"
    target = [("db2", "customer", 1, "ID", "BIGINT", None, None, None, "Y", False), ("db2", "customer", 2, "AT", "TIMESTAMP", None, None, None, "Y", False), ("db2", "customer", 3, "FLAG", "CHAR", 1, None, None, "Y", False)]
    fields = [Field("ID", "BIGINT"), Field("AT", "TIMESTAMP"), Field("FLAG", "CHAR", 1)]
    table = Table("db2", "crm", "customer", [Field(f.name.lower(), f.data_type, f.char_length) for f in fields], Folders(f"{folder}/customer"), f"{folder}/audit")
    check = chains.export_out(lake, spark.createDataFrame(target, columns), f"{folder}/out", table, AT).first()
    assert check.count_ok


def test_a_change_reads_its_own_tables_folder_alone(spark, folder, monkeypatch):
    shape = spark.createDataFrame([], audit.AUDIT).schema
    row = lambda name, n: spark.createDataFrame([[{"domain": "d", "table": name, "rows": n}.get(f.name) for f in shape.fields]], shape)
    for name in ("t", "u", "name with space"):
        stores.replace_audit(spark, folder, row(name, 1), "2016-01-01")
    monkeypatch.setattr(stores, "read_store", lambda *a, **k: pytest.fail("the whole store was listed"))
    stores.replace_audit(spark, folder, row("t", 2), "2016-01-02")
    kept = stores.read_keys(spark, folder, audit.AUDIT, audit.KEYS, row("t", 0)).collect()
    assert [(r.table, r.rows) for r in kept] == [("t", 2)]
    monkeypatch.undo()
    assert {r.table: r.rows for r in stores.read_store(spark, folder, audit.AUDIT).collect()} == {"t": 2, "u": 1, "name with space": 1}
    assert [r.rows for r in stores.read_history(spark, folder).collect()] == [1]


def test_the_landing_goes_once_it_is_published(spark, folder):
    table = _table(folder, [Field("ID", "NUMBER", None, 5, 0)], check_column="ID")
    chains.ingest_full(spark.createDataFrame([("1",)], "ID string"), table, AT)
    assert not publish.exists(spark, table.folders.landing)
    assert chains.ingest_increment(spark.createDataFrame([(1,), (2,)], "ID int"), table, AT + dt.timedelta(days=1)) == 1
    assert not publish.exists(spark, table.folders.landing)


def test_a_full_ceiling_of_shuffle_partitions_is_told(spark, caplog):
    from lakeload.session import size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(spark.range(10_000), per_partition=1, most=int(before))
    assert "shuffle partitions wanted" in caplog.text and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_table_that_left_a_team_goes_from_its_space(spark, folder):
    for name in ("d_t", "d_u"):
        publish.write_stage(spark.range(2).selectExpr("id", "'x' ingest_timestamp", "'full_1' incr_ingest_timestamp"), f"{folder}/live/{name}")
    rows = lambda *names: spark.createDataFrame([(n, "team_a") for n in names], "full_table_name string, views string")
    assert stores.rebuild_team(spark, rows("d_t", "d_u"), "team_a", f"{folder}/live", f"{folder}/team") == ["d_t", "d_u"]
    assert stores.rebuild_team(spark, rows("d_t"), "team_a", f"{folder}/live", f"{folder}/team") == ["d_t"]
    assert publish.folders(spark, f"{folder}/team") == ["d_t", "d_t_backup"]


def test_a_live_table_stays_registered_through_loads(spark, folder):
    name = unique_name("live")
    rows = lambda n, stamp: spark.range(n).selectExpr("id", f"'{stamp}' incr_ingest_timestamp")
    publish.write_stage(rows(2, "full_1"), f"{folder}/t")
    publish.register_live(spark, name, f"{folder}/t", rows(1, "x").schema)
    publish.merge_partition(rows(3, "20160102100000"), f"{folder}/t")
    publish.add_partition(spark, name, "20160102100000")
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 5
    publish.write_stage(rows(4, "full_2"), f"{folder}/t")
    assert publish.register_live(spark, name, f"{folder}/t", rows(1, "x").schema).count() == 4
    assert publish.register_live(spark, name, f"{folder}/t", spark.range(1).selectExpr("id AS other", "'x' incr_ingest_timestamp").schema).columns[0] == "other"


def test_scratch_folders_can_be_released(spark):
    from lakeload import session

    spark.range(3).write.parquet(session.scratch(spark, "released"))
    path = session._scratched[spark.sparkContext.applicationId][-1]
    session._scratched[spark.sparkContext.applicationId] = [path]
    assert publish.exists(spark, path) and session.release(spark) == 1 and not publish.exists(spark, path)
