import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from lakeload.operators import compare


@pytest.mark.parametrize(
    "source, target, ok",
    [(0, 0, True), (100, 96, True), (100, 98, True), (100, 100, True), (100, 95, False), (100, 92, False), (100, 103, False), (100, 106, False)],
)
def test_count_rule(spark, source, target, ok):
    df = spark.createDataFrame([(source, target)], "source_rows long, target_rows long")
    assert compare.count_check(df).first().count_ok is ok


def test_rows_under_an_empty_source_are_flagged(spark):
    df = spark.createDataFrame([(0, 5), (0, 0), (3, 3)], "source_rows long, target_rows long")
    assert [r.target_when_source_empty for r in compare.count_check(df).collect()] == [True, False, False]


def test_unequal_landing_count_is_an_error():
    compare.require_equal_counts(3, 3)
    with pytest.raises(ValueError):
        compare.require_equal_counts(3, 2)


LAKE = {"id": "BIGINT", "n": "DECIMAL(10,2)", "c": "CHAR(5)", "v": "VARCHAR(9)", "t": "TIMESTAMP", "f": "DOUBLE"}


def _lake_rows(spark, *rows):
    return spark.createDataFrame(rows, "id long, n decimal(10,2), c string, v string, t timestamp_ntz, f double")


def _text_rows(spark, *rows):
    return spark.createDataFrame(rows, "id long, n string, c string, v string, t string, f string")


def test_console_text_equals_typed_rows(spark):
    day, noon = dt.datetime(2016, 1, 2), dt.datetime(2016, 1, 2, 12, 0, 0)
    target = _lake_rows(
        spark,
        (1, decimal.Decimal("1.50"), "ab   ", "x", day, 1.0), (2, None, None, None, None, None),
        (3, decimal.Decimal("-7"), "a", "b", noon.replace(microsecond=637000), 0.5), (4, decimal.Decimal("0"), "a", "b", dt.datetime(1900, 1, 1, 10, 20, 30), 2.0),
        (5, decimal.Decimal("1"), "a", "b", None, 2.0), (6, decimal.Decimal("1"), "a", "b", noon, 2.0),
        (8, decimal.Decimal("1"), "a", "b", noon, 2.0), (8, decimal.Decimal("1"), "a", "b", noon, 2.0),
    )
    source = _text_rows(
        spark,
        (1, " 1.5 ", "ab", " x ", "2016-01-02", "1"), (2, "(null)", "(null)", "(null)", "(null)", "(null)"),
        (3, "-7.00", "a ", "b", "2016-01-02 12:00:00.637", "0.50"), (4, "0", "a", "b", "10:20:30", "2"),
        (5, "1", "a", "b", "0001-01-01", "2"), (6, "2", "a", "other", "2016-01-02 12:00:00.0", "2"),
        (7, "1", "a", "b", "2016-01-02", "2"), (8, "1", "a", "b", "2016-01-02 12:00:00", "2"),
    )
    got = {r.id: (r.n_matches, r.mismatched, r.row_ok) for r in compare.match_rows(source, target, ["id"], LAKE).collect()}
    assert all(got[i] == (1, "", True) for i in range(1, 6)), got
    assert got[6] == (1, "n,v", False)
    assert got[7] == (0, "", False) and got[8] == (2, "", False)


@pytest.mark.parametrize("lake, text, typed", [("BIGINT", "7", "CAST(7 AS BIGINT)"), ("DECIMAL(10,0)", " 7 ", "CAST(7 AS DECIMAL(10,0))"), ("DOUBLE", "7", "7.0D"), ("CHAR(3)", "7", "'7  '"), ("TIMESTAMP", "2016-01-02", "TIMESTAMP_NTZ '2016-01-02 00:00:00'")])
def test_keys_of_two_types_meet(spark, lake, text, typed):
    source, target = spark.sql(f"SELECT '{text}' AS k, 'a' AS v"), spark.sql(f"SELECT {typed} AS k, 'a' AS v")
    row = compare.match_rows(source, target, ["k"], {"k": lake, "v": "STRING"}).first()
    assert (row.k, row.n_matches, row.row_ok) == (text, 1, True)


def test_sampled_rows_are_looked_up_without_their_dates(spark):
    noon = dt.datetime(2016, 1, 2, 12)
    target = _lake_rows(
        spark, (1, decimal.Decimal("1.50"), "ab   ", "x", noon, 1.0), (2, None, "a", "b", noon, 1.0), (2, None, "a", "b", None, 1.0),
        (3, decimal.Decimal("2"), "a", "b", noon, 1.0), (4, None, "a", "anything", noon, 1.0),
    )
    sample = _text_rows(
        spark, (1, "1.5", "ab", "x", "1999-01-01", "1"), (2, "(null)", "a", "b", None, "1"), (3, "3", "a", "b", None, "1"),
        (4, "(null)", "a", " ", None, "1"),
    )
    got = {r.id: r.n_matches for r in compare.find_sample(sample, target, LAKE, "id").collect()}
    assert got == {1: 1, 2: 2, 3: 0, 4: 1}


def test_conformance_of_text_values(spark):
    cases = [
        ("VARCHAR(3)", "abc", True), ("VARCHAR(3)", "abcd", False), ("DECIMAL(4,2)", "-12.34", True), ("DECIMAL(4,2)", "123.4", False),
        ("DECIMAL(4,2)", "123.45", False), ("DECIMAL(4,2)", "1.234", False), ("DECIMAL(4,2)", "0.00", True), ("DECIMAL(4,2)", "0012.340", True),
        ("DECIMAL(4,2)", "x", False), ("DECIMAL(4,2)", "", False), ("DECIMAL(4,2)", ".", False), ("DECIMAL(4,2)", ".5", True),
        ("DECIMAL(4,2)", "5.", True), ("DECIMAL(4,2)", " 007.10 ", True), ("DECIMAL(4,2)", "1-2", False), ("DECIMAL(2,2)", "0.99", True), ("DECIMAL(2,2)", "1.00", False), ("INT", "12", True), ("INT", "1.5", False), ("INT", "99999999999", False), ("TINYINT", "-128", True),
        ("DOUBLE", "1e5", True), ("DOUBLE", "one", False), ("TIMESTAMP", "2016-02-30", False), ("TIMESTAMP", "2016-02-29 10:00:00.5", True),
        ("BOOLEAN", "true", True), ("BOOLEAN", "2", False), ("STRING", "anything", True), ("INT", None, True), ("INT", " 7 ", True), ("BIGINT", "1e3", False),
    ]
    for lake, value, ok in cases:
        df = spark.createDataFrame([(value,)], "v string")
        row = compare.conformance(df, {"v": lake}).first()
        assert row.conforms is ok, (lake, value)


def test_conformance_means_the_cast_loses_nothing(spark):
    """Against Python's own decimals, for many values and sizes."""
    import random

    rng = random.Random(7)
    texts = [f"{rng.choice(['', '-', '+'])}{rng.choice(['', '0', '00'])}{rng.randrange(10 ** rng.randrange(1, 6))}" for _ in range(150)]
    texts = [t + rng.choice(["", ".", f".{rng.randrange(10 ** rng.randrange(1, 6))}", ".500", ".0"]) for t in texts]
    for precision, scale in [(3, 0), (4, 2), (5, 5), (6, 1)]:
        lake = f"DECIMAL({precision},{scale})"
        df = spark.createDataFrame([(t,) for t in texts], "v string")
        for text, got in df.select("v", compare.conforms(df, "v", lake)).collect():
            value = decimal.Decimal(text)
            held = value == round(value, scale) and abs(value) < decimal.Decimal(10) ** (precision - scale)
            assert got is held, (lake, text)


def test_a_column_held_in_its_own_type_is_not_read(spark, folder):
    spark.range(5).select("id", F.lit("abc").alias("s"), F.lit(1.5).alias("d")).write.parquet(f"{folder}/t")
    df = compare.conformance(spark.read.parquet(f"{folder}/t"), {"id": "BIGINT", "s": "VARCHAR(2)", "d": "DOUBLE"})
    assert {r.column_name: r.n_bad for r in df.collect()} == {"id": 0, "s": 5, "d": 0}
    assert "ReadSchema: struct<s:string>" in df._jdf.queryExecution().executedPlan().toString()


def _catalog(spark, *rows):
    return spark.createDataFrame(
        rows,
        "vendor string, table_name string, ordinal int, column_name string, data_type string, char_length int, "
        "num_precision int, num_scale int, nullable string, is_identity boolean",
    )


def test_schema_match_both_ways(spark):
    source = _catalog(
        spark, ("oracle", "t", 1, "id", "NUMBER", 22, 10, 2, "Y", True), ("oracle", "t", 2, "name", "VARCHAR2", 30, None, None, "N", False),
        ("oracle", "t", 3, "gone", "DATE", None, None, None, "Y", False),
    )
    lake = _catalog(
        spark, ("oracle", "t", 1, "id", "DECIMAL", None, 10, 2, None, False), ("oracle", "t", 2, "name", "VARCHAR", 20, None, None, None, False),
        ("oracle", "t", 4, "extra", "INT", None, None, None, None, False),
    ).drop("nullable", "is_identity")
    into = {r.ordinal: (r.name_ok, r.type_ok, r.length_ok) for r in compare.schema_match(source, lake).collect()}
    assert into == {1: (True, True, True), 2: (True, True, False), 3: (False, False, False)}
    out = {r.ordinal: (r.name_ok, r.type_ok, r.length_ok) for r in compare.schema_match(source, lake, "export").collect()}
    assert out == {2: (True, True, True), 3: (False, False, False)}
    verdict = compare.schema_verdict(compare.schema_match(source, lake)).first()
    assert (verdict.matched, verdict.mismatched, verdict.schema_ok) == (1, 2, False)


def test_nullable_and_column_sets(spark):
    rows = [(v, "t", 1, "a", "INT", None, None, None, "YES", False) for v in ("db2", "mysql")]
    more = [(v, "t", 2, "b", "INT", None, None, None, None, False) for v in ("db2", "mysql")]
    full, short = _catalog(spark, *rows, *more), _catalog(spark, *rows)
    assert {r.vendor: r.all_nullable for r in compare.nullable_check(full).collect()} == {"db2": False, "mysql": False}
    assert all(r.all_nullable for r in compare.nullable_check(short).collect())
    got = {r.vendor: (r.only_source, r.only_target, r.columns_ok) for r in compare.column_set_check(full, short).collect()}
    assert got == {"db2": (1, 0, False), "mysql": (1, 0, True)}


def test_sampling_of_ids_the_lake_type_cannot_hold(spark):
    from lakeload.plans import quality

    source = spark.sql("SELECT explode(array('1', '2', 'x')) AS k, 'a' AS v")
    target = source.where("k <> 'x'").select(F.col("k").cast("bigint").alias("k"), "v")
    got = {r.stage: r.passed for r in quality.sampling(source, target, "k", {"k": "BIGINT", "v": "STRING"}).collect()}
    assert got == {"row_found": False, "row_match": False, "conformance": True}
