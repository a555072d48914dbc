import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from lakeload.operators import incremental, sample
from lakeload.operators.project import Field, lands_as_text
from lakeload.sinks import export
from lakeload.sources import files, jdbc
from lakeload.sources.jdbc import Source

ORDERS = Source("oracle", "jdbc:oracle:thin:@h", "SALES", "ORDERS", split_by="ID", readers=8)


def test_split_column_must_exist():
    with pytest.raises(ValueError, match="ID is not one of: A, B"):
        jdbc.check_split(ORDERS, ["A", "B"])


@pytest.mark.parametrize("role", ["split_by", "check_column"])
def test_custom_filter_may_not_use_split_or_check_column(role):
    source = Source("db2", "u", "d", "t", where="C > 3", **{role: "C"})
    with pytest.raises(ValueError, match="may not use"):
        jdbc.check_split(source, ["C"])


def test_ranges_are_read_in_parallel_except_where_they_cannot_be():
    plain = jdbc.options(ORDERS, "SELECT 1", (1, 100))
    assert (plain["partitionColumn"], plain["lowerBound"], plain["upperBound"], plain["numPartitions"]) == ("ID", "1", "100", "8")
    assert plain["fetchsize"] == "50000" and "_serial_direct_read" in plain["sessionInitStatement"]
    for source in (
        Source("oracle", "u", "d", "v", split_by="ID", is_view=True), Source("oracle", "u", "d", "t", split_by="ID", where="X = 1"),
        Source("mysql", "u", "d", "t"),
    ):
        assert jdbc.reader_count(source) == 1
        assert "numPartitions" not in jdbc.options(source, "q", (1, 2))
    assert "numPartitions" not in jdbc.options(ORDERS, "q", (None, None))


def test_extract_query_renames_casts_and_filters():
    fields = [Field("ID", "NUMBER"), Field("1 a$b", "VARCHAR2"), Field("DOC", "XMLTYPE"), Field("_u", "DATE")]
    source = Source("oracle", "u", "SALES", "ORDERS", where="REGION = 'EU'")
    query = jdbc.extract_query(source, fields, "TS > 5")
    assert query == (
        'SELECT "ID", "1 a$b" AS "i_1ab", t."DOC".getclobval() AS "DOC", "_u" AS "i_u" '
        'FROM "SALES"."ORDERS" t WHERE 1=1 AND (REGION = \'EU\') AND (TS > 5)'
    )
    teradata = Source("teradata", "u", "d", "t")
    assert jdbc.extract_query(teradata, fields[:1]).startswith("SELECT")
    assert jdbc.options(teradata, "q")["prepareQuery"] == "LOCKING ROW FOR ACCESS"
    assert "[d].[dbo].[t]" in jdbc.extract_query(Source("sqlserver", "u", "d", "t", schema="dbo"), fields[:1])
    assert 'CAST("k" AS VARCHAR) AS "k"' in jdbc.extract_query(Source("postgresql", "u", "d", "t"), [Field("k", "oid")])


def test_types_that_land_as_text():
    fields = [Field("a", "CLOB"), Field("b", "timestamp(6)"), Field("c", "INTEGER"), Field("d", "json")]
    assert lands_as_text(fields) == ["a", "b", "d"]


def test_increment_filter_per_vendor():
    at = dt.datetime(2016, 1, 2, 3, 4, 5, 600)
    text = "2016-01-02 03:04:05.000600"
    assert incremental.where_clause("oracle", "ts", at) == f"TS > to_timestamp('{text}', 'YYYY-MM-DD HH24:MI:SS.FF9')"
    assert incremental.where_clause("sqlserver", "ts", at) == f"ts > convert(datetime2, '{text}')"
    assert incremental.where_clause("db2", "ts", at) == f"timestamp(TS) > timestamp('{text}')"
    assert incremental.where_clause("mysql", "ts", at) == f"ts > '{text}'"
    assert incremental.where_clause("mysql", "id", 7) == "id > 7"


def test_mode_and_mark(spark):
    df = spark.createDataFrame([(1, dt.datetime(2016, 1, 1), "x")], "id long, ts timestamp_ntz, s string")
    assert incremental.mode_of(df, "ts") == "lastmodified" and incremental.mode_of(df, "id") == "append"
    for bad in ("s", "nope"):
        with pytest.raises(ValueError):
            incremental.mode_of(df, bad)
    assert incremental.high_watermark(df.limit(0), "id") is None
    assert incremental.above(df, "id", None).count() == 1
    assert incremental.above(df, "id", 1).count() == 0
    assert incremental.above(df, "ts", dt.datetime(2016, 1, 1), inclusive=True).count() == 1


def test_increment_filter_reaches_the_scan(spark, folder):
    spark.range(100).write.parquet(f"{folder}/t")
    plan = incremental.above(spark.read.parquet(f"{folder}/t"), "id", 90)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,90)" in plan


def test_csv_drop_takes_plain_and_gzip(spark, folder):
    drop = f"{folder}/drop"
    import os

    os.makedirs(drop)
    with open(f"{drop}/a.csv", "w") as f:
        f.write("id,name\n1,x\n")
    with gzip.open(f"{drop}/b.csv.gz", "wt") as f:
        f.write('id,name\n2,"y,z"\n')
    rows = files.ingest_csv(spark, drop, "id INT, name STRING", f"{folder}/table").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, "y,z")]


def test_delimited_rows(spark, folder):
    with open(f"{folder}/r.txt", "w") as f:
        f.write("dom|7|\\N\n")
    assert tuple(files.read_delimited(spark, f"{folder}/r.txt", "d STRING, n INT, v STRING").first()) == ("dom", 7, None)


def test_land_counted_counts_in_the_same_pass(spark, folder):
    landed, extracted = files.land_counted(spark.range(25), f"{folder}/l")
    assert extracted == landed.count() == 25


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    first = sample.sample_rows(df, ["id"]).collect()
    assert first == sample.sample_rows(df.repartition(7), ["id"]).collect() and len(first) == 5
    assert first != sample.sample_rows(df, ["id"], seed="2").collect()
    with pytest.raises(ValueError):
        sample.sample_rows(df, ["id"], 10_000)
    assert sample.row_from(df.where("id % 10 = 3"), "id", 994).count() == 0


def test_merge_statements():
    columns, keys = ["id", "v"], ["id"]
    assert export.merge_statement("oracle", "T", "S", columns, keys) == (
        'MERGE INTO T t USING S s ON (t."id" = s."id") WHEN MATCHED THEN UPDATE SET t."v" = s."v" '
        'WHEN NOT MATCHED THEN INSERT ("id", "v") VALUES (s."id", s."v")'
    )
    assert "NOT MATCHED" not in export.merge_statement("db2", "T", "S", columns, keys, insert=False)
    assert export.merge_statement("sqlserver", "T", "S", columns, keys).endswith(";")
    assert "ON CONFLICT" in export.merge_statement("postgresql", "T", "S", columns, keys)
    assert "ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)" in export.merge_statement("mysql", "T", "S", columns, keys)
    assert export.merge_statement("mysql", "T", "S", columns, keys, insert=False).startswith("UPDATE T t JOIN S s")
    with pytest.raises(ValueError):
        export.merge_statement("oracle", "T", "S", columns, [])


def test_read_asks_for_the_bounds_and_then_reads_in_ranges():
    """The reader's calls, recorded; no database is behind them."""
    from unittest.mock import MagicMock

    spark, asked = MagicMock(), []
    reader = spark.read.format.return_value

    def remember(**options):
        asked.append(options)
        return MagicMock(**{"load.return_value.first.return_value": (5, 905)})

    reader.options.side_effect = remember
    jdbc.read(spark, ORDERS, [Field("ID", "NUMBER"), Field("V", "CLOB")], "TS > 3")
    bounds, rows = asked
    assert bounds["dbtable"] == '(SELECT MIN("ID") AS low, MAX("ID") AS high FROM "SALES"."ORDERS" t WHERE 1=1 AND (TS > 3)) src'
    assert "numPartitions" not in bounds
    assert (rows["lowerBound"], rows["upperBound"], rows["numPartitions"], rows["partitionColumn"]) == ("5", "905", "8", "ID")
    assert rows["dbtable"].endswith("WHERE 1=1 AND (TS > 3)) src")
    assert rows["customSchema"] == "`V` STRING" and "customSchema" not in bounds


def test_staged_insert_refuses_an_incomplete_staging_table(monkeypatch):
    """The calls of a staged insert, recorded; no database is behind them."""
    from unittest.mock import MagicMock

    statements = []
    monkeypatch.setattr(export, "run_statement", lambda spark, statement, *login: statements.append(statement) or 3)
    monkeypatch.setattr(export, "Observation", lambda: MagicMock(get={"n": 3}))
    for staged, ok in ((3, True), (4, False)):
        df = MagicMock(columns=["ID", "V"])
        df.sparkSession.read.format.return_value.options.return_value.load.return_value.first.return_value = (staged,)
        if ok:
            assert export.staged_insert_jdbc(df, "oracle", "u", "T", "S", 4) == 3
        else:
            with pytest.raises(ValueError):
                export.staged_insert_jdbc(df, "oracle", "u", "T", "S", 4)
    assert statements == ['INSERT INTO T ("ID", "V") SELECT "ID", "V" FROM S']


def test_text_keys_are_dealt_into_buckets():
    fields = [Field("NAME", "VARCHAR2", 20), Field("DAY", "DATE")]
    source = Source("oracle", "u", "SALES", "ORDERS", readers=3, split_by="NAME")
    assert jdbc.splits_as_text(source, fields) and not jdbc.splits_as_text(Source("oracle", "u", "S", "O", split_by="DAY"), fields)
    assert jdbc.bucket_filters(source) == [
        '(ORA_HASH("NAME", 2) = 0 OR "NAME" IS NULL)', 'ORA_HASH("NAME", 2) = 1', 'ORA_HASH("NAME", 2) = 2',
    ]
    assert jdbc.bucket_filters(Source("db2", "u", "S", "O", readers=3, split_by="NAME")) == []


def test_a_filter_may_hold_a_column_name_within_another():
    source = Source("oracle", "u", "S", "O", split_by="ID", where="VALID = 1")
    jdbc.check_split(source, ["ID", "VALID"])
    with pytest.raises(ValueError):
        jdbc.check_split(Source("oracle", "u", "S", "O", split_by="ID", where="id > 3"), ["ID"])


def test_merges_of_key_only_tables_and_of_the_targets_names():
    assert export.merge_statement("oracle", "T", "S", ["k"], ["k"]) == (
        'MERGE INTO T t USING S s ON (t."k" = s."k") WHEN NOT MATCHED THEN INSERT ("k") VALUES (s."k")'
    )
    assert export.merge_statement("postgresql", "T", "S", ["k"], ["k"]).endswith("DO NOTHING")
    assert export.merge_statement("mysql", "T", "S", ["k"], ["k"]).endswith("ON DUPLICATE KEY UPDATE `k` = VALUES(`k`)")
    assert 't."ID" = s."ID"' in export.merge_statement("oracle", "T", "S", ["id", "v"], ["id"], target_names={"id": "ID", "v": "V"})
    with pytest.raises(ValueError):
        export.merge_statement("oracle", "T", "S", ["k"], ["k"], insert=False)
    assert "DISTINCT" not in export.once_per_key("oracle", "S", ["k", "doc"], ["k"])


def test_catalog_is_read_from_the_vendor_dictionary(spark):
    """A reader that hands over dictionary rows; no database is behind it."""
    from unittest.mock import MagicMock

    given = spark.createDataFrame(
        [("T", 1, " ID ", "DECIMAL", 9, 2, "N", "Y"), ("T", 2, "V", "VARCHAR", 30, None, "Y", "N")],
        "TBNAME string, COLNO int, NAME string, COLTYPE string, LENGTH int, SCALE int, NULLS string, IDENTITY string",
    )
    session = MagicMock()
    session.read.format.return_value.options.return_value.load.return_value = given
    rows = jdbc.read_catalog(session, Source("db2", "u", "CRM", "T"), "T").orderBy("ordinal").collect()
    assert [(r.column_name, r.num_precision, r.num_scale, r.nullable, r.is_identity) for r in rows] == [("ID", 9, 2, "N", True), ("V", 30, None, "Y", False)]
    query = session.read.format.return_value.options.call_args.kwargs["dbtable"]
    assert "FROM SYSIBM.SYSCOLUMNS WHERE TBCREATOR = 'CRM' AND TBNAME = 'T'" in query
