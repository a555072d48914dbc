import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeload.operators import audit
from lakeload.operators.project import Field
from lakeload.plans import chains, stores
from lakeload.plans.chains import QualityError, Table
from lakeload.plans.loads import Folders
from lakeload.plans.steps import unique_name
from lakeload.sinks import publish

AT = dt.datetime(2016, 1, 1, 10)
FIELDS = [Field("ID", "NUMBER", None, 10, 0), Field("NAME$", "VARCHAR2", 20), Field("DAY", "DATE")]


def _source(spark, ids):
    return spark.createDataFrame([(str(i), f"n{i}", f"2016-01-{i % 28 + 1:02d} 00:00:00") for i in ids], "ID string, `NAME` string, DAY string")


def _table(folder, **more):
    return Table("oracle", "crm", "customer", FIELDS, Folders(f"{folder}/customer"), f"{folder}/audit", **more)


def _audit(spark, table):
    return stores.read_store(spark, f"{table.audit_root}/ingest", audit.AUDIT).first()


def test_full_load_with_checks_views_and_audit(spark, folder):
    live, view = unique_name("crm_customer"), unique_name("team")
    table = _table(folder, sample_id="ID", live_table=live, views=[view], lifespan="daily")
    stages = {r.stage: r.passed for r in chains.ingest_full(_source(spark, range(40)), table, AT).collect()}
    assert stages == {"ddl": True, "stored_types": True, "row_found": True, "row_match": True, "conformance": True}
    assert spark.table(live).count() == spark.table(f"{view}.{live}").count() == 40
    row = _audit(spark, table)
    assert (row.rows, row.current_repull, row.lifespan, row.ingest_timestamp) == (40, 0, "daily", "2016-01-01 10:00:00")
    assert row.avro_size > 0 and row.parquet_size > 0
    history = stores.read_history(spark, f"{table.audit_root}/ingest").collect()
    assert [r.current_repull for r in history] == [1]


def test_values_that_do_not_fit_are_told_where_they_are_tolerated(spark, folder):
    table = _table(folder, sample_id="ID", tolerated=None)
    source = _source(spark, range(5)).withColumn("NAME", F.when(F.col("ID") == "3", F.repeat(F.lit("x"), 30)).otherwise(F.col("NAME")))
    stages = {r.stage: r.passed for r in chains.ingest_full(source, table, AT).collect()}
    assert stages["conformance"] is False and stages["ddl"] is True
    assert spark.read.parquet(table.folders.live).count() == 5


def test_a_failed_check_publishes_nothing_and_is_recorded(spark, folder):
    table = _table(folder)
    chains.ingest_full(_source(spark, range(3)), table, AT)
    bad = Table("oracle", "crm", "customer", [*FIELDS[:2], Field("DAY", "geopoint")], table.folders, table.audit_root)
    with pytest.raises(QualityError):
        chains.ingest_full(_source(spark, range(9)), bad, AT + dt.timedelta(days=1))
    assert spark.read.parquet(table.folders.live).count() == 3
    assert _audit(spark, table).current_repull == audit.FAILED


def test_increments_follow_the_mark(spark, folder):
    table = _table(folder, check_column="ID")
    chains.ingest_full(_source(spark, range(3)), table, AT)
    typed = lambda ids: _source(spark, ids).withColumn("ID", F.col("ID").cast("decimal(10,0)"))
    assert chains.ingest_increment(typed(range(5)), table, AT + dt.timedelta(days=1)) == 2
    assert chains.ingest_increment(typed(range(5)), table, AT + dt.timedelta(days=2)) == 0
    rows = publish.read_partitioned(spark, table.folders.live, spark.read.parquet(table.folders.live).schema)
    assert sorted(int(r.ID) for r in rows.collect()) == [0, 1, 2, 3, 4]
    assert {r[0] for r in rows.select(publish.PARTITION).distinct().collect()} == {"full_20160101100000", "20160102100000"}
    assert _audit(spark, table).rows == 0


def test_export_chain(spark, folder):
    lake = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string").withColumn("ingest_timestamp", F.lit("x"))
    columns = "vendor string, table_name string, ordinal int, column_name string, data_type string, char_length int, num_precision int, num_scale int, nullable string, is_identity boolean"
    good = [("db2", "customer", 1, "ID", "BIGINT", None, None, None, "Y", False), ("db2", "customer", 2, "NAME", "VARCHAR", 30, None, None, "Y", False)]
    table = Table("db2", "crm", "customer", [], Folders(f"{folder}/customer"), f"{folder}/audit")
    check = chains.export_out(lake, spark.createDataFrame(good, columns), f"{folder}/out", table, AT).first()
    assert (check.source_rows, check.target_rows, check.count_ok) == (2, 2, True)
    row = stores.read_store(spark, f"{table.audit_root}/export", audit.EXPORT_AUDIT).first()
    assert (row.row_count, row.current_repull, row.table_name) == (2, 0, "customer")
    strict = [good[0], (*good[1][:8], "N", False)]
    with pytest.raises(QualityError):
        chains.export_out(lake, spark.createDataFrame(strict, columns), f"{folder}/other", table, AT)
    with pytest.raises(ValueError, match="already has rows"):
        chains.export_out(lake, spark.createDataFrame(good, columns), f"{folder}/out", table, AT)
