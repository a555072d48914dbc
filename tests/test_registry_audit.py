import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakeload.operators import audit, registry, runlog, teams
from lakeload.plans import quality, stores
from lakeload.sinks import publish


def _registry(spark, *rows):
    shape = spark.createDataFrame([], registry.REGISTRY).schema
    return spark.createDataFrame([[r.get(f.name) for f in shape.fields] for r in rows], shape)


def _key(db="d", table="t", env="dev", **more):
    return {"source_database_name": db, "source_table_name": table, "db_env": env, "full_table_name": f"{db}_{table}", **more}


def test_views_merge_in_order_and_an_empty_request_clears(spark):
    cases = [("a|b", "c", "a|b|c"), ("a|b", "b|d|b", "a|b|d"), (None, "x", "x"), ("a", "", ""), ("a", None, "")]
    df = spark.createDataFrame(cases, "old string, new string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", registry.merged_views(F.col("old"), F.col("new"))).collect())


def test_env_prefix_is_added_once(spark):
    df = spark.createDataFrame(
        [("db", "", "dev", "db_i"), ("db", None, "int", "int_db_i"), ("db", "int_x", "int", "int_x"), ("db", "x", "int", "int_x")],
        "source_database_name string, domain string, db_env string, want string",
    ).selectExpr("*", "'daily' refresh_frequency", "'heavy' weight", "'' views", "'a' new_views", "CAST(NULL AS INT) mappers", "CAST(NULL AS INT) fetch_size")
    rows = registry.normalise(df).collect()
    assert [r.domain for r in rows] == [r.want for r in rows]
    assert {(r.load, r.mappers, r.fetch_size) for r in rows} == {("101001", 10, 50000)}


def test_diff_ignores_empty_and_clears_on_null(spark):
    current = _registry(spark, _key(domain="x", mappers=5, views="a"))
    asked = spark.createDataFrame([("d", "t", "dev", "null", "6", "")], "source_database_name string, source_table_name string, db_env string, domain string, mappers string, views string")
    got = {r.column_name: (r.old_value, r.new_value) for r in registry.diff(current, asked, ["domain", "mappers", "views"]).collect()}
    assert got == {"domain": ("x", ""), "mappers": ("5", "6")}


def test_lookup_frequency_and_removal(spark):
    rows = _registry(spark, _key(load="100100", hold=0), _key(table="u", load="", automation_group="g"), _key(table="w", load=None))
    assert [r.source_table_name for r in registry.lookup(rows, automation_group="g").collect()] == ["u"]
    assert registry.lookup(rows, automation_group=None).count() == 2
    assert {r.source_table_name for r in registry.by_schedule(rows, "none").collect()} == {"u", "w"}
    gone = spark.createDataFrame([("d", "t", "dev")], registry.KEYS)
    assert registry.remove(rows, gone).count() == 2
    held = registry.placeholders(gone).first()
    assert (held.hold, held.load, held.mappers, held.domain) == (1, "000001", 10, None)


def test_request_status(spark):
    rows = _registry(spark, _key(hold=0), _key(table="u", hold=1))
    asked = spark.createDataFrame([("d", "t", ""), ("d", "u", None), ("d", "t", "prod")], "source_database_name string, source_table_name string, db_env string")
    assert sorted(r.status for r in registry.request_status(asked, rows).collect()) == ["available", "hold", "missing"]


def test_members_match_whole_names(spark):
    rows = _registry(spark, _key(views="team_a|x"), _key(table="u", views="team_ab"), _key(table="w", views=None))
    assert [r.source_table_name for r in teams.members(rows, "team_a").collect()] == ["t"]


def test_copies_come_from_the_domain_where_there_is_one(spark):
    rows = _registry(spark, _key(views="a|sales|b"), _key(table="u", views="sales"), _key(table="w", views="a"))
    got = {(r.full_table_name, r.view_name, r.source_domain) for r in teams.copy_sources(rows, ("sales",)).collect()}
    assert got == {("d_t", "a", "sales"), ("d_t", "b", "sales"), ("d_u", "sales", None), ("d_w", "a", None)}


def test_refresh_is_due_on_the_day(spark):
    rules = spark.createDataFrame([("weekly", "YES", "v", "a"), ("weekly", "yes", "v", "b"), ("none", "yes", "v", "c"), ("daily", "no", "v", "d"), ("daily", "yes", "v", "never")], "frequency string, activate string, view_name string, full_table_name string")
    last = spark.createDataFrame([("v", t, dt.datetime(2016, 1, d, 12)) for t, d in (("a", 1), ("b", 2), ("c", 1), ("d", 1))], "view_name string, full_table_name string, last_ingest timestamp_ntz")
    got = {r.full_table_name: (r.age_days, r.due) for r in teams.refresh_due(rules, last, dt.datetime(2016, 1, 8, 12)).collect()}
    assert got == {"a": (7, True), "b": (6, False), "c": (7, False), "d": (7, False), "never": (None, False)}


def test_team_space_is_rebuilt_from_live(spark, folder):
    rows = _registry(spark, _key(views="team_a"), _key(table="u", views="team_b"))
    schema = None
    for name, n in (("d_t", 2), ("d_u", 1)):
        df = spark.range(n).selectExpr("id", "'x' ingest_timestamp", "'full_1' incr_ingest_timestamp")
        schema = publish.write_stage(df, f"{folder}/live/{name}").schema
    for _ in range(2):
        assert stores.rebuild_team(spark, rows, "team_a", f"{folder}/live", f"{folder}/team") == ["d_t"]
    assert publish.read_partitioned(spark, f"{folder}/team/d_t", schema).count() == 2


def _audit(spark, *rows):
    shape = spark.createDataFrame([], audit.AUDIT).schema
    return spark.createDataFrame([[r.get(f.name) for f in shape.fields] for r in rows], shape)


def test_audit_store_keeps_what_it_replaces(spark, folder):
    first = _audit(spark, {"domain": "d", "table": "t", "rows": 1}, {"domain": "d", "table": "u", "rows": 2})
    stores.record_audit(spark, folder, first, "2016-01-01")
    marker = audit.in_progress(spark.createDataFrame([("d", "t")], ["domain", "table"]), "2016-01-02 00:00:00")
    stores.record_audit(spark, folder, marker, "2016-01-02")
    done = _audit(spark, {"domain": "d", "table": "t", "rows": 5, "current_repull": 0})
    current = {r.table: (r.rows, r.current_repull) for r in stores.record_audit(spark, folder, done, "2016-01-03").collect()}
    assert current == {"t": (5, 0), "u": (2, None)}
    history = sorted((r.archived_at, r.rows, r.current_repull) for r in stores.read_history(spark, folder).collect())
    assert history == [("2016-01-02", 1, None), ("2016-01-03", None, 1)]
    # The same change again archives the row it finds, beside the others.
    stores.record_audit(spark, folder, done, "2016-01-03")
    assert stores.read_history(spark, folder).count() == 3
    assert stores.read_store(spark, folder, audit.AUDIT).count() == 2


def test_tables_keep_their_audit_rows_at_the_same_time(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    def load(name):
        for n in (1, 2):
            stores.record_audit(spark, folder, _audit(spark, {"domain": "d", "table": name, "rows": n, "ingest_timestamp": str(n)}), "now")

    names = [f"t{i}" for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(load, names))
    assert {(r.table, r.rows) for r in stores.read_store(spark, folder, audit.AUDIT).collect()} == {(n, 2) for n in names}
    assert {(r.table, r.rows) for r in stores.read_history(spark, folder).collect()} == {(n, 1) for n in names}


def test_registry_store(spark, folder):
    for n in (1, 2):
        out = stores.upsert_store(spark, folder, _registry(spark, _key(mappers=n)), registry.KEYS, registry.REGISTRY)
    assert [r.mappers for r in out.collect()] == [2]


def test_quality_log(spark, folder):
    stages = spark.createDataFrame([("db2", "t", "ddl", True), ("db2", "t", "count", False)], "vendor string, table_name string, stage string, passed boolean")
    status = quality.status_json(stages)
    assert json.loads(status.first().status) == {"ddl": True, "count": False}
    rows = status.select(F.lit("2016-01-01 10:00:00").cast("timestamp").alias("log_time"), "table_name", F.lit(" it's\r\n\"x\", y ").alias("log"), "status")
    for n in (1, 2):
        assert stores.append_log(rows, f"{folder}/log").count() == n
    for _ in (1, 2):
        assert stores.append_log(rows, f"{folder}/log", "b1").count() == 3
    assert stores.append_log(rows, f"{folder}/log", "b1").columns == ["log_time", "table_name", "log", "status"]
    assert stores.log_lines(rows).first().value == "2016-01-01 10:00:00.000000|t|it\\'s \\\"x\\\"\\, y|" + '{"count":false,"ddl":true}'


def _action(i, name, kind, status="OK", start="Wed, 30 Sep 2015 19:00:00 GMT", end="Wed, 30 Sep 2015 19:01:15 GMT", conf="", stats=None, external=None):
    return {"id": str(i), "name": name, "type": kind, "status": status, "startTime": start, "endTime": end, "conf": conf, "stats": stats, "externalId": external, "ignored": {"x": 1}}


PREP = "<env-var>source_table_name=risk-fact</env-var>\n<env-var>domain=risk</env-var><env-var>target_dir=mdm/risk</env-var>"
STATS = '{"a.b.TaskCounter":{"MAP_INPUT_RECORDS":376248,"MAP_OUTPUT_RECORDS":%d},"a.FileSystemCounter":{"HDFS_BYTES_WRITTEN":197519591}}'


def _write_runs(folder, *runs):
    with open(f"{folder}/runs.json", "w") as f:
        for i, actions in enumerate(runs):
            f.write(json.dumps({"id": f"run{i}", "appName": "app", "status": "SUCCEEDED", "run": 0, "actions": actions, "acl": None}) + "\n")
    return f"{folder}/runs.json"


def test_table_statistics_from_a_run_log(spark, folder):
    good = [
        _action(1, "riskfact_import_prep", "shell", conf=PREP), _action(2, "riskfact_import", "sqoop", stats=STATS % 376248),
        _action(3, "riskfact_avro_parquet", "shell", start="Wed, 30 Sep 2015 19:02:00 GMT"),
        _action(4, "riskfact_parquet_live", "hive", end="Wed, 30 Sep 2015 19:06:57 GMT"), _action(5, "elsewhere_import", "sqoop", status="KILLED"),
    ]
    bad = [_action(1, "riskfact_import_prep", "shell", conf=PREP), _action(2, "riskfact_import", "sqoop", stats=STATS % 5), _action(3, "riskfact_avro_parquet", "shell", status="ERROR")]
    runs = runlog.read_runs(spark, _write_runs(folder, good, bad))
    actions = runlog.actions_by_table(runs)
    got = {r.run_id: r for r in runlog.table_records(actions).collect()}
    one = got["run0"]
    assert (one.table_name, one.directory, one.domain, one.rows, one.pull_time, one.avro_size, one.parquet_time, one.success) == ("risk-fact", "mdm/risk", "risk", 376248, 75, 197519591, 297, "0")
    assert one.ingest_timestamp == "Wed, 30 Sep 2015 19:00:00 GMT"
    assert (got["run1"].rows, got["run1"].parquet_time, got["run1"].success) == (None, 0, "2")
    assert {r.run_id: r.in_out_ok for r in runlog.in_out(actions).collect()} == {"run0": True, "run1": False}


def test_merge_step_stands_for_the_conversion(spark, folder):
    run = [_action(1, "riskfact_import_prep", "shell", conf=PREP), _action(2, "riskfact_merge_partition", "hive")]
    actions = runlog.actions_by_table(runlog.read_runs(spark, _write_runs(folder, run)))
    assert runlog.table_records(actions).first().parquet_time == 75


def test_newest_sub_run_is_the_highest_name(spark, folder):
    run = [_action(i, f"job_{i}", "sub-workflow", external=f"ext{i}") for i in (0, 2, 1)] + [_action(9, "job_9", "shell", external="no")]
    assert tuple(runlog.newest_sub_run(runlog.read_runs(spark, _write_runs(folder, run))).first()) == ("run0", "job_2", "ext2")


@pytest.mark.parametrize("missing", ["", None])
def test_last_rows_are_zero_where_unknown(spark, missing):
    log = _audit(spark, {"domain": "d", "table": "t", "ingest_timestamp": "2016-01-01", "rows": 4}, {"domain": "d", "table": "t", "ingest_timestamp": "2016-01-02", "rows": None})
    assert audit.last_rows(log).first().rows == 0


def test_parquet_size_of_every_table_from_one_listing(spark, folder):
    for name, n in (("a", 1), ("b", 1000)):
        for stamp in ("full_20160101000000", "20160102000000"):
            df = spark.range(n if stamp[0] == "2" else 5).coalesce(1).withColumn(publish.PARTITION, F.lit(stamp))
            publish.merge_partition(df, f"{folder}/mdm/{name}/live")
    newest = publish.newest_partition_size(publish.partition_sizes(spark, folder))
    records = spark.createDataFrame([("a", "mdm/a"), ("b", "mdm/b"), ("c", "mdm/c")], "table_name string, directory string")
    got = {r.table_name: r.parquet_size for r in runlog.with_parquet_size(records, newest).collect()}
    assert got["b"] > got["a"] > 0 and got["c"] is None
    assert {r.incr_ingest_timestamp for r in newest.collect()} == {"20160102000000"}


def test_export_audit_and_export_requests(spark, folder):
    row = spark.createDataFrame([("d", "t", 4)], "domain string, table_name string, row_count long")
    shape = spark.createDataFrame([], audit.EXPORT_AUDIT).schema
    full = row.select(*[(F.col(f.name) if f.name in row.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])
    for at in ("1", "2"):
        out = stores.record_audit(spark, folder, full, at, audit.EXPORT_AUDIT, audit.EXPORT_KEYS, "export_timestamp")
    assert out.count() == 1 and stores.read_history(spark, folder, audit.EXPORT_AUDIT).count() == 1
    exports = spark.createDataFrame([("d", "t", "dev")], registry.KEYS)
    asked = spark.createDataFrame([("d", "t", ""), ("d", "u", "")], registry.KEYS)
    assert sorted(r.status for r in registry.request_status(asked, exports).collect()) == ["available", "missing"]


def test_a_cluster_session_must_name_its_shared_folder():
    from types import SimpleNamespace

    from lakeload.session import shared_dir

    def session(master, named=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(master=master, applicationId="x"))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
