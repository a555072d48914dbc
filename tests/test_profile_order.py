import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lakeload.operators import ordered, profile, runlog


def test_ranges_cover_without_overlap():
    for low, high, n in [(0, 99, 10), (0, 100, 10), (5, 7, 10), (-3, 40, 7)]:
        parts = profile.ranges(low, high, n)
        assert parts[0][0] == low and parts[-1][1] >= high
        assert all(a[1] + 1 == b[0] for a, b in zip(parts, parts[1:]))


def test_split_bounds_of_empty_and_unknown(spark):
    assert profile.split_bounds(spark.range(0), "id", 4).count() == 0
    with pytest.raises(ValueError, match="nope"):
        profile.split_bounds(spark.range(3), "nope", 4)
    got = profile.split_bounds(spark.range(10).select((F.col("id") - 5).alias("id")), "id", 3).orderBy("range_no").collect()
    assert [tuple(r) for r in got] == [(0, -5, -2, 4), (1, -1, 2, 4), (2, 3, 6, 2)]


def test_group_spread_is_the_population_deviation(spark):
    rows = [("a", 1), ("a", 2), ("a", 3), ("b", 4), (None, 5), (None, 6)]
    got = {r.column_name: r for r in profile.split_quality(spark.createDataFrame(rows, "s string, n int")).collect()}
    assert got["s"].n_groups == 3 and abs(got["s"].group_stddev - statistics.pstdev([3, 1, 0])) < 1e-12
    assert got["n"].n_groups == 6 and got["n"].group_stddev == 0.0
    one = profile.split_quality(spark.createDataFrame([("x",)] * 3, "s string")).first()
    assert (one.n_groups, one.group_stddev) == (1, 0.0)


def test_split_choice_needs_more_groups_than_readers(spark):
    quality = spark.createDataFrame([(1, "a", 10, 0.5), (2, "b", 11, 0.5), (3, "c", 5, 0.0)], "ordinal int, column_name string, n_groups long, group_stddev double")
    got = profile.split_choice(quality, [(4, None, "db2"), (5, None, "db2"), (10, None, "db2"), (99, None, "db2"), (4, "pk", "db2"), (4, None, "oracle")])
    assert [r.split_column for r in got.collect()] == ["c", "a", "b", None, "pk", None]


def test_unique_integer_before_first_integer(spark):
    ints = spark.createDataFrame([("t", 1, "a"), ("t", 2, "b"), ("u", 3, "c"), ("u", 5, "d")], "table_name string, ordinal int, column_name string")
    unique = spark.createDataFrame([("t", "b"), ("t", "b"), ("u", "z")], "table_name string, column_name string")
    assert {r.table_name: r.split_column for r in profile.unique_or_first_integer(ints, unique).collect()} == {"t": "b", "u": "c"}


def test_length_of_an_empty_column_is_38(spark):
    df = spark.createDataFrame([("abc", None), ("é", None)], "a string, b string")
    assert {r.column_name: r.max_length for r in profile.max_lengths({"t": df}).collect()} == {"a": 3, "b": 38}


def _stream(n, hot_share, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot_share else f"k{rng.randrange(5)}"
        at = rng.choice([rng.randrange(100), rng.randrange(10**6), 7])
        rows.append((key, at, i, None if rng.random() < 0.4 else i))
    return rows


@pytest.mark.parametrize("seed, hot", [(1, 0.5), (2, 0.95), (3, 0.0)])
def test_next_value_against_brute_force(spark, seed, hot):
    rows = _stream(600, hot, seed)
    df = spark.createDataFrame(rows, "key string, at long, tie long, v long")
    got = {r.tie: r.next_v for r in ordered.next_value(df, ["key"], ["at", "tie"], "v").collect()}
    assert len(got) == len(rows)
    for key, at, tie, _ in rows:
        later = [(a, t, v) for k, a, t, v in rows if k == key and (a, t) > (at, tie) and v is not None]
        assert got[tie] == (min(later)[2] if later else None)


@pytest.mark.parametrize("most_tied", [3, 40])
def test_next_value_cuts_ties(spark, most_tied):
    rng = random.Random(most_tied)
    rows = [
        (rng.choice(["hot", "hot", None, "k"]), rng.choice([7, 7, 7, 8, None, rng.randrange(50)]), rng.randrange(2), i, None if rng.random() < 0.5 else i)
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "key string, at long, kind int, tie long, v long")
    out = ordered.next_value(df, ["key"], ["at", "kind", "tie"], "v", most_tied)
    got = {r.tie: r.next_v for r in out.collect()}
    assert out.columns == [*df.columns, "next_v"] and len(got) == len(rows)
    place = lambda at, kind, tie: (at is None, at or 0, kind, tie)
    for key, at, kind, tie, _ in rows:
        later = [(place(a, k, t), v) for o, a, k, t, v in rows if o == key and place(a, k, t) > place(at, kind, tie) and v is not None]
        assert got[tie] == (min(later)[1] if later else None)


def test_tied_rows_of_a_hot_key_are_cut(spark):
    """A third of all rows share key and time: no window holds more than a small part of them."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("long").alias("at"), F.lit("hot").alias("key"), "id")
    out = ordered.next_value(df, ["key"], ["at", "id"], "id", most_tied=1_000)
    assert out.count() == 30_000
    crowd = df.where("at = 5")
    sizes = [r["count"] for r in ordered.with_slice(crowd, "id").groupBy("key", "at", "_slice").count().collect()]
    assert max(sizes) < 1_000


def test_a_hot_key_is_spread_over_many_slices(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("key"), "id")
    sizes = [r["count"] for r in ordered.with_slice(df, "id").groupBy("key", "_slice").count().collect()]
    assert len(sizes) >= 48 and max(sizes) < 2_000
    assert ordered.with_slice(df.limit(0), "id").count() == 0


def test_slices_never_fall_as_the_order_rises(spark):
    values = sorted({random.Random(4).randrange(-10**15, 10**15) for _ in range(500)} | {0, 1, 2, 10**15})
    df = spark.createDataFrame([(v,) for v in values], "v long")
    slices = [r._slice for r in ordered.with_slice(df, "v").orderBy("v").collect()]
    assert slices == sorted(slices)


def test_closest_run_is_the_first_at_or_after(spark):
    at = lambda m: dt.datetime(2016, 1, 1, 0, m)
    runs = spark.createDataFrame([("a", 1, at(5)), ("a", 2, at(10)), ("a", 3, at(10)), ("b", 4, at(1))], "app string, run_id long, at timestamp_ntz")
    asked = spark.createDataFrame([("a", 10, at(0)), ("a", 11, at(5)), ("a", 12, at(6)), ("a", 13, at(11)), ("b", 14, at(1)), ("c", 15, at(0))], "app string, request_id long, at timestamp_ntz")
    got = {r.request_id: (r.run_id, r.gap_seconds) for r in runlog.closest_runs(asked, runs).collect()}
    assert got == {10: (1, 300), 11: (1, 0), 12: (2, 240), 13: (None, None), 14: (4, 0), 15: (None, None)}


def test_shuffles_grow_with_the_table_and_never_shrink(spark, folder):
    from lakeload.session import MOST_SHUFFLE_PARTITIONS, size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(50_000).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    try:
        assert size_shuffles(df) == int(before)
        grown = size_shuffles(df, 10_000)
        assert grown > int(before) and spark.conf.get("spark.sql.shuffle.partitions") == str(grown)
        assert size_shuffles(df) == grown
        assert size_shuffles(df, 1) == MOST_SHUFFLE_PARTITIONS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


KINDS = "a long, b long, c long, d string, e long, f timestamp, g decimal(12,2)"


def _columns(spark, rows=20_000):
    """Unique, even, skewed, two-valued, NULL, time and decimal columns."""
    return spark.range(rows).select(
        F.col("id").alias("a"), (F.col("id") % 700).alias("b"), F.floor(F.log2(F.col("id") + 1)).cast("long").alias("c"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("d"), F.lit(None).cast("long").alias("e"),
        F.timestamp_seconds(F.col("id") % 1000).alias("f"), F.when(F.col("id") % 3 > 0, (F.col("id") % 5000).cast("decimal(12,2)")).alias("g"),
    )


@pytest.mark.parametrize("counters", [256, 2048])
def test_sketched_bands_hold_the_exact_profile(spark, counters):
    df = _columns(spark)
    exact = {r.column_name: r for c in df.columns for r in profile.split_quality(df, [c]).collect()}
    bands = {r.column_name: r for r in profile.sketched_quality(df, counters=counters).collect()}
    assert set(bands) == set(exact)
    for name, b in bands.items():
        assert b.groups_low <= exact[name].n_groups <= b.groups_high, (name, b, exact[name])
        assert b.stddev_low - 1e-9 <= exact[name].group_stddev <= b.stddev_high + 1e-9, (name, b, exact[name])
        assert b.groups_high <= 1.2 * b.groups_low + 1
    assert profile.sketched_quality(df.limit(0)).where("groups_high > 0 OR stddev_high > 0").count() == 0


def test_sketches_shuffle_counters_and_not_values(spark):
    df = spark.range(0, 400_000, 1, 8).select("id", F.hash("id").alias("h"))
    bands = profile.sketched_quality(df, counters=64)
    bands.collect()
    plan = bands._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(column" in plan and "value" not in plan
    partial = df.select(F.xxhash64("id").alias("h")).groupBy(F.pmod("h", F.lit(64)).alias("counter")).count()
    assert partial.count() == 64


def test_only_columns_the_sketches_cannot_tell_apart_are_profiled(spark, monkeypatch):
    df, asked = _columns(spark), []
    real = profile.split_quality
    monkeypatch.setattr(profile, "split_quality", lambda df, columns=None: (asked.append(columns), real(df, columns))[1])
    tables = [(4, None, "db2"), (800, None, "mysql"), (4, "pk", "db2"), (4, None, "oracle")]
    got = [r.split_column for r in profile.sketched_choice(df.drop("a"), tables).collect()]
    assert asked == [["f"]] or "c" not in asked[0] and "e" not in asked[0]
    want = profile.split_choice(real(df.drop("a"), ["b", "c", "e", "f", "g"]), tables)
    assert got == [r.split_column for r in want.collect()]
    assert [r.split_column for r in profile.sketched_choice(df, [(100_000, None, "db2")]).collect()] == [None]


def test_sketched_choice_is_the_exact_one_on_every_table(spark):
    for name in ("lineitem", "orders", "events", "customer", "part", "supplier", "documents", "pages"):
        df = spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
        columns, tables = profile.splittable(df), [(n, None, "db2") for n in (2, 10, 60, 1000)]
        want = profile.split_choice(profile.split_quality(df, columns), tables).collect()
        assert profile.sketched_choice(df, tables).collect() == want, name
