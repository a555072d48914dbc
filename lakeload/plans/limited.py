"""Profiles with a time limit, which fall back to the last profile that was stored.

A profile reads a whole table and may take longer than its user will wait. Its jobs carry a tag
of their own; when the limit is reached they are cancelled by it, other jobs of the session are not.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import profile
from . import stores

# Fixed value: how long a request file's profiles may take if nothing else is said.
SECONDS = 1_800
# Jobs that start after the limit are cancelled within this time.
EVERY_SECONDS = 0.2
PROFILES = "ordinal INT, column_name STRING, n_groups BIGINT, group_stddev DOUBLE, profiled_at STRING, table_name STRING"
KEY = ["table_name"]
# A column that was given without a profile is taken for any number of readers.
MANY_GROUPS = (1 << 63) - 1

Result = TypeVar("Result")


class OverTime(RuntimeError):
    """The work took longer than it may; its jobs were cancelled."""


def within(spark: SparkSession, seconds: float, work: Callable[[], Result]) -> Result:
    """What ``work`` gives, or ``OverTime`` once it has run ``seconds``. ``work`` runs its jobs in this thread.

    Work that ended before it was noticed to be late counts; an error of its own is its own.
    With no time at all the work is not begun.
    """
    if seconds <= 0:
        raise OverTime("no time was given")
    sc, tag = spark.sparkContext, f"limited-{uuid.uuid4().hex[:12]}"
    ended, late = threading.Event(), threading.Event()

    def watch() -> None:
        pause = seconds
        while not ended.wait(pause):
            late.set()
            sc.cancelJobsWithTag(tag)
            pause = EVERY_SECONDS

    watcher = threading.Thread(target=watch, daemon=True)
    sc.addJobTag(tag)
    watcher.start()
    try:
        return work()
    except Exception as error:
        if late.is_set() and "cancel" in str(error).lower():
            raise OverTime(f"stopped after {seconds} seconds") from error
        raise
    finally:
        ended.set()
        watcher.join()
        sc.removeJobTag(tag)


def stored_profile(spark: SparkSession, root: str, table: str) -> DataFrame:
    wanted = spark.createDataFrame([(table,)], "table_name string")
    return stores.read_keys(spark, root, PROFILES, KEY, wanted).where(F.col("table_name") == table)


def profiled(df: DataFrame, table: str, root: str, at: dt.datetime, seconds: float = SECONDS, columns: list[str] | None = None) -> DataFrame:
    """The table's split profile and whether it is ``fresh``.

    A profile in time is stored under the table's name and replaces the one before. One that
    is late leaves the stored one as it is and gives it instead; no row if there is none.
    """
    spark = df.sparkSession
    found = profile.split_quality(df, columns or profile.splittable(df))
    found = found.withColumns({"profiled_at": F.lit(at.strftime("%Y-%m-%d %H:%M:%S")), "table_name": F.lit(table)})
    try:
        # The store's own write is the profile's job: a cancelled one replaces nothing.
        within(spark, seconds, lambda: stores.put_rows(found, f"{root}/current", KEY))
        fresh = True
    except OverTime:
        fresh = False
    return stored_profile(spark, root, table).withColumn("fresh", F.lit(fresh))


def chosen(profiles: DataFrame, tables: list[tuple[int, str | None, str]], split_column: str | None = None) -> DataFrame:
    """``profile.split_choice`` from a stored or fresh profile; ``split_column`` where there is no profile at all."""
    if split_column and profiles.isEmpty():
        given = [(1, split_column, MANY_GROUPS, 0.0)]
        profiles = profiles.sparkSession.createDataFrame(given, "ordinal INT, column_name STRING, n_groups BIGINT, group_stddev DOUBLE")
    return profile.split_choice(profiles, tables)
