"""Queries for exports and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sample
from ..session import scratch
from ..sinks import export, touched
from . import inputs as inp
from .inputs import DUCK, SPARK


def _edge_text(dialect):
    """Documents with NULL, the separator, a literal null mark, a backslash and an empty text planted."""
    text = "STRING" if dialect == SPARK else "VARCHAR"
    slash = "'\\\\'" if dialect == SPARK else "'\\'"
    mark = "'\\\\N'" if dialect == SPARK else "'\\N'"
    sep = "char(1)" if dialect == SPARK else "chr(1)"
    return f"""
      SELECT doc_id, CAST(CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN {mark} WHEN 2 THEN 'a' || {sep} || 'b|c'
                          WHEN 3 THEN {slash} || 'x' || {slash} WHEN 4 THEN '' ELSE text END AS {text}) AS text,
             lang, source, n_chars FROM documents"""


def export_text(spark, sf):
    return export.write_text(inp.derive(spark, sf, _edge_text(SPARK)), scratch(spark, "export_text"))


def _field_sql(column: str, separator: str) -> str:
    e = f"CAST({column} AS VARCHAR)"
    for plain, written in (("'\\'", "'\\\\'"), (separator, f"'\\' || {separator}"), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'")):
        e = f"replace({e}, {plain}, {written})"
    return f"coalesce({e}, '\\N')"


def _line_sql(columns: list[str], separator: str) -> str:
    return f" || {separator} || ".join(_field_sql(c, separator) for c in columns)


_DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
EXPORT_TEXT_SQL = inp.with_inputs(f"SELECT {_line_sql(_DOCUMENT_COLUMNS, 'chr(1)')} AS value FROM d", d=_edge_text(DUCK))


def export_text_distinct(spark, sf):
    """Every column of documents, whose rows stand there twice."""
    documents = inp.derive(spark, sf, _edge_text(SPARK))
    return export.write_text(documents.unionByName(documents), scratch(spark, "export_distinct"), separator="|", distinct=True)


EXPORT_DISTINCT_SQL = inp.with_inputs(f"""SELECT DISTINCT {_line_sql(_DOCUMENT_COLUMNS, "'|'")} AS value FROM d""", d=_edge_text(DUCK))


def export_columns(spark, sf):
    return export.export_columns(inp.tables(spark, sf)["orders"], ["o_orderdate", "o_orderkey", "o_totalprice"])


def export_compare_catalog(spark, sf):
    return export.compared_columns(inp.derive(spark, sf, inp.catalog(SPARK))).select(
        "vendor", "table_name", "ordinal", "column_name", "data_type"
    )


def export_insert(spark, sf):
    """Insert by way of a staging folder into an empty target."""
    folder = scratch(spark, "export_insert")
    return export.staged_insert(inp.tables(spark, sf)["orders"], f"{folder}/staging", f"{folder}/target")


def export_upsert(spark, sf):
    orders = inp.tables(spark, sf)["orders"]
    changes = inp.derive(spark, sf, inp.order_changes(SPARK))
    return export.upsert_rows(orders, changes, ["o_orderkey"], scratch(spark, "export_upsert"))


def export_update_only(spark, sf):
    orders = inp.tables(spark, sf)["orders"]
    changes = inp.derive(spark, sf, inp.order_changes(SPARK))
    return export.update_rows(orders, changes, ["o_orderkey"], scratch(spark, "export_update"))


def _many_files(spark, sf, label):
    """A lake folder of the orders in files of neighbouring keys."""
    folder = scratch(spark, label)
    inp.tables(spark, sf)["orders"].repartitionByRange(8, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(folder)
    return folder


def export_upsert_files(spark, sf):
    """The upsert, by rewriting the files that hold a changed order; the changes stand there twice."""
    folder, changes = _many_files(spark, sf, "upsert_files"), inp.derive(spark, sf, inp.order_changes(SPARK))
    touched.rewrite_touched(spark, folder, changes.unionByName(changes), ["o_orderkey"])
    return spark.read.parquet(folder)


def export_update_files(spark, sf):
    folder, changes = _many_files(spark, sf, "update_files"), inp.derive(spark, sf, inp.order_changes(SPARK))
    touched.rewrite_touched(spark, folder, changes, ["o_orderkey"], insert=False)
    return spark.read.parquet(folder)


def upsert_touches(spark, sf):
    """Which slices of a thousand order keys a set of late changes touches, and in how many rows."""
    orders = inp.tables(spark, sf)["orders"]
    folder = scratch(spark, "touches")
    orders.withColumn("slice", F.expr("o_orderkey div 1000")).write.partitionBy("slice").parquet(folder)
    late = orders.where("o_totalprice > 400000").select("o_orderkey")
    found = touched.files_with(spark.read.parquet(folder), late, ["o_orderkey"])
    return found.groupBy(F.regexp_extract("file_path", "slice=([0-9]+)", 1).cast("bigint").alias("slice")).agg(F.sum("n_rows").alias("n_rows"))


def _merged_sql(join: str) -> str:
    columns = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    shown = ", ".join(f"CASE WHEN c.o_orderkey IS NOT NULL THEN c.{x} ELSE o.{x} END AS {x}" for x in columns)
    body = f"SELECT coalesce(o.o_orderkey, c.o_orderkey) AS o_orderkey, {shown} FROM orders o {join} JOIN c ON o.o_orderkey = c.o_orderkey"
    return inp.with_inputs(body, c=inp.order_changes(DUCK))


def sample_rows(spark, sf):
    return sample.sample_rows(inp.tables(spark, sf)["lineitem"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


SAMPLE_SQL = """
SELECT * FROM lineitem
ORDER BY md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|1'),
         l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 5
"""


def sample_from_id(spark, sf):
    events = inp.tables(spark, sf)["events"].where("event_id % 7 = 3")
    return sample.row_from(events, "event_id", 50)


KEYS = {
    "export_columns": (export_columns, "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders"),
    "export_compare_catalog": (
        export_compare_catalog,
        inp.with_inputs("SELECT vendor, table_name, ordinal, column_name, data_type FROM c WHERE NOT is_identity", c=inp.catalog(DUCK)),
    ),
    "export_insert": (export_insert, "SELECT * FROM orders"),
    "export_text": (export_text, EXPORT_TEXT_SQL),
    "export_text_distinct": (export_text_distinct, EXPORT_DISTINCT_SQL),
    "export_update_only": (export_update_only, _merged_sql("LEFT")),
    "export_update_files": (export_update_files, _merged_sql("LEFT")),
    "export_upsert": (export_upsert, _merged_sql("FULL")),
    "export_upsert_files": (export_upsert_files, _merged_sql("FULL")),
    "sample_from_id": (sample_from_id, "SELECT * FROM events WHERE event_id % 7 = 3 AND event_id >= 50 ORDER BY event_id LIMIT 1"),
    "sample_rows": (sample_rows, SAMPLE_SQL),
    "upsert_touches": (
        upsert_touches, "SELECT o_orderkey // 1000 AS slice, count(*) AS n_rows FROM orders WHERE o_totalprice > 400000 GROUP BY 1"
    ),
}
