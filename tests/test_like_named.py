import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from lakeload.operators import catalog, compare, incremental
from lakeload.plans import quality
from lakeload.sinks import export

COLUMNS = "vendor string, owner string, table_name string, ordinal int, column_name string, data_type string, char_length int, num_precision int, num_scale int, nullable string, is_identity boolean"


def _catalog(spark, *rows):
    return spark.createDataFrame([(v, o, t, i, n, k, size, None, None, "Y", False) for v, o, t, i, n, k, size in rows], COLUMNS)


def test_tables_of_one_name_are_kept_apart_by_vendor_and_owner(spark):
    source = _catalog(
        spark, ("oracle", "a", "t", 1, "x", "VARCHAR2", 5), ("db2", "a", "t", 1, "y", "INTEGER", 4), ("oracle", "b", "t", 1, "z", "VARCHAR2", 9)
    )
    lake = catalog.lake_catalog(source)
    matched = compare.schema_match(source, lake).collect()
    assert len(matched) == 3 and all(r.name_ok and r.type_ok and r.length_ok for r in matched)
    stages = quality.full_load(source, lake)
    assert stages.columns == ["vendor", "owner", "table_name", "stage", "passed"] and stages.where("NOT passed").isEmpty()
    assert quality.status_json(stages).count() == 3
    wrong = lake.withColumn("char_length", F.when(F.col("owner") == "b", 1).otherwise(F.col("char_length")))
    assert [(r.vendor, r.owner) for r in quality.full_load(source, wrong).where("NOT passed").collect()] == [("oracle", "b")]
    assert compare.column_set_check(source, lake).where("NOT columns_ok").isEmpty()
    assert compare.nullable_check(source).count() == 3


def test_a_lake_without_vendors_is_matched_by_name(spark):
    source = _catalog(spark, ("oracle", "a", "t", 1, "x", "VARCHAR2", 5)).drop("owner")
    lake = catalog.lake_catalog(source).drop("vendor")
    assert compare.schema_verdict(compare.schema_match(source, lake)).first().schema_ok


def test_dictionaries_name_the_owner_if_asked(spark):
    for vendor, d in catalog.DICTIONARIES.items():
        query = catalog.dictionary_query(vendor, "me", with_owner=True)
        assert query.startswith(f"SELECT {d.owner}, ") and f"WHERE {d.owner} = 'me'" in query
    d = catalog.DICTIONARIES["oracle"]
    rows = spark.createDataFrame([(" me ", "T", 1, "C", "DATE", 7, None, None, "Y", "NO")], f"{d.owner} string, {d.table} string, {d.ordinal} int, {d.name} string, {d.data_type} string, {d.length} int, {d.precision} int, {d.scale} int, {d.nullable} string, {d.identity} string")
    assert catalog.from_dictionary("oracle", rows).first().owner == "me"


def test_increments_of_many_tables_in_one_pass(spark):
    source = spark.createDataFrame([("new", 1), ("same", 3), ("more", 3), ("more", 5), ("back", 1), ("null", None)], "t string, n int")
    live = spark.createDataFrame([("same", 3), ("more", 3), ("back", 2), ("gone", 9)], "t string, n int")
    got = {r.t: (r.mark, r.has_rows) for r in incremental.increments(source, live, ["t"], "n").collect()}
    assert got == {"new": (None, True), "same": (3, False), "more": (3, True), "back": (2, False)}


def test_empty_targets_in_one_pass(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "t string")
    target = spark.createDataFrame([("b",), ("c",)], "t string")
    assert {r.t: r.target_empty for r in export.empty_targets(rows, target, ["t"]).collect()} == {"a": True, "b": False, None: True}


def test_other_queries_stay_if_the_numbered_ones_cannot_be_imported():
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), [k for k in q if k.startswith('op') or k == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().endswith("[]") and int(out.stdout.split()[0]) > 100, out.stderr
