"""Profiles that may not take longer than they are given."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from lakeload.plans import limited

AT, LATER = dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 2)


def _slow(spark, rows=400):
    """Each row takes a tenth of a second in the JVM."""
    slow = F.expr("java_method('java.lang.Thread', 'sleep', CAST(100 AS BIGINT))")
    return spark.range(0, rows, 1, 4).select(F.when(slow.isNotNull(), 0).otherwise(F.col("id")).alias("a"))


def _running(spark):
    return spark.sparkContext.statusTracker().getActiveJobsIds()


def test_late_work_is_cancelled(spark):
    began = time.monotonic()
    with pytest.raises(limited.OverTime):
        limited.within(spark, 0.5, lambda: _slow(spark).agg(F.sum("a")).collect())
    assert time.monotonic() - began < 6
    for _ in range(50):
        if not _running(spark):
            break
        time.sleep(0.1)
    assert not _running(spark)
    # The session and the thread go on without the tag.
    assert spark.range(5).count() == 5 and not any(t.startswith("limited-") for t in spark.sparkContext.getJobTags())


def test_later_jobs_of_late_work_are_cancelled_too(spark):
    def two_jobs():
        time.sleep(0.6)
        return _slow(spark).agg(F.sum("a")).collect()

    with pytest.raises(limited.OverTime):
        limited.within(spark, 0.2, two_jobs)


def test_work_in_time_and_its_own_errors(spark):
    assert limited.within(spark, 60, lambda: spark.range(7).count()) == 7
    with pytest.raises(ZeroDivisionError):
        limited.within(spark, 60, lambda: 1 // 0)


def test_a_late_profile_gives_the_stored_one(spark, folder):
    quick = spark.range(10).select("id", (F.col("id") % 3).alias("k"))
    first = limited.profiled(quick, "t", folder, AT)
    assert {(r.column_name, r.n_groups, r.profiled_at, r.fresh) for r in first.collect()} == {
        ("id", 10, "2016-01-01 00:00:00", True), ("k", 3, "2016-01-01 00:00:00", True)
    }
    late = limited.profiled(_slow(spark), "t", folder, LATER, seconds=0.5)
    assert {(r.column_name, r.n_groups, r.profiled_at, r.fresh) for r in late.collect()} == {
        ("id", 10, "2016-01-01 00:00:00", False), ("k", 3, "2016-01-01 00:00:00", False)
    }
    other = limited.profiled(_slow(spark), "u", folder, LATER, seconds=0.5)
    assert other.count() == 0
    again = limited.profiled(quick.drop("k"), "t", folder, LATER)
    assert [(r.column_name, r.profiled_at, r.fresh) for r in again.collect()] == [("id", "2016-01-02 00:00:00", True)]


def test_the_choice_without_any_profile_is_the_given_column(spark, folder):
    none = limited.profiled(_slow(spark), "t", folder, AT, seconds=0.3)
    tables = [(2, None, "db2"), (2, "pk", "db2"), (2, None, "oracle")]
    assert [r.split_column for r in limited.chosen(none, tables, "given").collect()] == ["given", "pk", None]
    some = limited.profiled(spark.range(10), "t", folder, AT)
    assert [r.split_column for r in limited.chosen(some, tables, "given").collect()] == ["id", "pk", None]
