"""Every query against its SQL in DuckDB, and the driver's three functions."""

import pytest

import __spark_entry__ as entry
from check import run
from conftest import SF
from lakeload.suite import KEYS


@pytest.mark.parametrize("key", sorted(KEYS))
def test_query_agrees_with_its_sql(spark, key):
    df, verdict, _ = run(spark, SF, key)
    assert verdict.startswith(("ok", "rows only")), verdict
    assert "types" not in verdict, verdict
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in UNWANTED:
        assert node not in plan, node


# Joins without a key, and rows that leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def test_filters_and_columns_reach_the_scan(spark):
    q = entry.queries()
    for key, wanted in {
        "filtered_view": ["IsNotNull(l_returnflag), IsNotNull(l_quantity), EqualTo(l_returnflag,R)", "struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>"],
        "incr_append": ["GreaterThan(o_orderkey,"],
        "incr_lastmodified": ["GreaterThan(ts,"],
        "export_columns": ["struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>"],
        "qa_count_match": ["struct<l_suppkey:bigint>"],
    }.items():
        plan = q[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        for text in wanted:
            assert text in plan, (key, plan)


def test_only_file_sizes_have_no_sql():
    assert {key for key in KEYS if key not in entry.oracle_sql()} == {"partition_sizes"}


def test_entry_reports_every_column(spark):
    report = {r.column_name: r for r in entry.entry(spark).collect()}
    assert len(report) == 11
    assert report["l_linestatus"].lost == 0 and report["l_orderkey"].lost > 0
    assert all(r.count_ok for r in report.values())


def test_checked_queries_see_both_outcomes(spark):
    """A check that only ever passes, or only ever fails, would prove nothing."""
    q, larger = entry.queries(), SF.replace("0.001", "0.01")
    for key, column in [
        ("qa_count_match", "count_ok"), ("qa_full_ingest", "passed"), ("qa_incremental", "passed"),
        ("qa_export_pre", "passed"), ("qa_nullable", "all_nullable"), ("qa_column_set", "columns_ok"),
        ("qa_row_match", "row_ok"), ("qa_conformance", "conforms"), ("qa_sampling", "passed"),
        ("team_refresh_due", "due"), ("runlog_inout", "in_out_ok"), ("qa_target_empty", "target_empty"),
    ]:
        seen = {r[0] for r in q[key](spark, larger).select(column).distinct().collect()}
        assert seen == {True, False}, key
