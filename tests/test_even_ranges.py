"""Ranges of about equal rows: every row once, no part much over a share."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeload.operators import ranges
from lakeload.sources import jdbc


def _check(df, column, n, second=None, most=1.5):
    parts = ranges.filters(df, column, n, second)
    row = ranges.measured(df, parts).first()
    assert row.n_rows == row.n_once == df.count()
    assert row.largest <= most * row.n_rows / n + 1, (row, parts)
    assert len(parts) <= 3 * n + 2
    return parts


def test_zipf_key_is_cut_evenly(spark):
    df = spark.range(40_000).select((20_000 / (1 + F.col("id") % 20_000)).cast("bigint").alias("k"), "id")
    parts = _check(df, "k", 10, "id")
    # Half of all rows have key 1, which is read by several readers.
    assert sum("`k` = 1 AND" in p for p in parts) >= 4


def test_gapped_key(spark):
    df = spark.range(10_000).select(F.when(F.col("id") < 9_000, F.col("id")).otherwise(F.col("id") * 1_000_000_000).alias("k"))
    _check(df, "k", 8)


def test_many_nulls_and_few(spark):
    many = spark.range(9_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    _check(many, "k", 8, "id")
    few = spark.range(9_000).select(F.when(F.col("id") % 1000 > 0, F.col("id")).alias("k"))
    parts = _check(few, "k", 8)
    assert sum("IS NULL" in p for p in parts) == 1


def test_second_column_with_nulls_and_a_hot_value(spark):
    df = spark.range(12_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 500).alias("s")
    )
    row = ranges.measured(df, ranges.filters(df, "k", 6, "s")).first()
    assert row.n_rows == row.n_once == 12_000


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(12,2)", "decimal(38,0)", "decimal(30,10)", "int"])
def test_kinds(spark, kind):
    n = F.col("id") * F.col("id") % 30_011
    made = {
        "date": F.date_add(F.lit(dt.date(1950, 1, 1)), n.cast("int")),
        "timestamp": F.timestamp_micros(n * 1_234_567_891 - 10**15),
        "timestamp_ntz": F.timestamp_micros(n * 1_234_567_891 - 10**15).cast("timestamp_ntz"),
        "decimal(12,2)": (n - 15_000).cast("decimal(12,2)") / 4,
        "decimal(38,0)": n.cast("decimal(38,0)") * F.lit(Decimal(10**20)),
    }.get(kind, n)
    df = spark.range(8_000).select(made.cast(kind).alias("k"))
    _check(df, "k", 7)


def test_empty_null_and_single_valued(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    for none in (df.where("k < 0"), df.select(F.lit(None).cast("bigint").alias("k"))):
        row = ranges.measured(none, ranges.filters(none, "k", 4)).first()
        assert row.n_rows == row.n_once
    one = df.select(F.lit(5).cast("bigint").alias("k"), F.col("k").alias("s"))
    assert len(ranges.filters(one, "k", 4)) == 2
    _check(one, "k", 4, "s")


def test_rows_that_come_later_fall_in_one_part(spark):
    df = spark.range(1_000).select(F.when(F.col("id") % 2 == 0, F.lit(3)).otherwise(F.col("id")).alias("k"), "id")
    parts = ranges.filters(df, "k", 4, "id")
    later = spark.sql("SELECT k, id FROM VALUES (-9L, 1L), (9999L, 2L), (NULL, 3L), (3L, -5L), (3L, 99999L), (3L, NULL) t(k, id)")
    row = ranges.measured(later, parts).first()
    assert row.n_rows == row.n_once == 6


def test_vendor_words_and_refusals(spark):
    df = spark.range(100).select(F.timestamp_micros(F.col("id") * 10**12).alias("t"), F.lit("x").alias("s"))
    assert any("DATETIME2" in f for f in ranges.filters(df, "t", 3, vendor="sqlserver", names=("[t]", "[s]")))
    assert all('"T"' in f for f in ranges.filters(df, "t", 3, vendor="oracle", names=('"T"', '"S"')))
    for column in ("s", "none"):
        with pytest.raises(ValueError):
            ranges.filters(df, column, 3)


def test_jdbc_filters_by_the_lakes_copy(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 2 == 0, F.lit(3)).otherwise(F.col("id")).alias("id"), F.col("id").alias("line"))
    source = jdbc.Source("oracle", "u", "S", "T", readers=5, split_by="ID")
    parts = jdbc.even_filters(source, df, "LINE")
    assert sum(p.startswith('"ID" = 3 AND') for p in parts) >= 2 and any('"LINE"' in p for p in parts)
    row = ranges.measured(df, [p.replace('"ID"', "id").replace('"LINE"', "line") for p in parts]).first()
    assert row.n_rows == row.n_once == 3_000 and row.largest <= 900
    assert jdbc.even_filters(jdbc.Source("oracle", "u", "S", "T", readers=5), df) == []
