"""Queries for the quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import compat
from ..functions.text import escape_log
from ..operators import catalog, compare, project, reconcile
from ..plans import quality, stores
from ..sinks import export
from ..session import scratch
from . import inputs as inp
from .inputs import DUCK, SPARK
from .typing import LINEITEM_FIELDS, _TYPE_ROWS, lake_catalog_sql

# counts ---------------------------------------------------------------------------------

def _arrived(dialect):
    """Rows per supplier that arrived, with losses and surpluses of every size."""
    return """
      SELECT l_suppkey, l_orderkey FROM lineitem
      WHERE NOT (l_suppkey % 10 = 1 AND l_orderkey % 25 = 0)
        AND NOT (l_suppkey % 10 = 2 AND l_orderkey % 10 = 0)
        AND NOT (l_suppkey % 10 = 3)
      UNION ALL SELECT l_suppkey, l_orderkey FROM lineitem WHERE l_suppkey % 10 = 4 AND l_orderkey % 30 = 0
      UNION ALL SELECT -1 - l_suppkey % 3, l_orderkey FROM lineitem WHERE l_suppkey % 10 = 5"""


def qa_count_match(spark, sf):
    source = inp.tables(spark, sf)["lineitem"]
    counts = compare.two_counts(source, inp.derive(spark, sf, _arrived(SPARK)), ["l_suppkey"])
    return compare.count_check(counts)


_COUNT_COLUMNS = """coalesce(s, 0) AS source_rows, coalesce(t, 0) AS target_rows,
       CASE WHEN coalesce(s, 0) = 0 THEN 100.0::DOUBLE ELSE coalesce(t, 0) * 100.0::DOUBLE / s END AS percent,
       coalesce(s, 0) = 0 OR (coalesce(t, 0) * 100 > 95 * s AND coalesce(t, 0) <= s) AS count_ok,
       coalesce(s, 0) = 0 AND t > 0 AS target_when_source_empty"""
COUNT_MATCH_SQL = inp.with_inputs(
    f"""SELECT l_suppkey, {_COUNT_COLUMNS}
        FROM (SELECT l_suppkey, count(*) AS s FROM lineitem GROUP BY 1) a
        FULL JOIN (SELECT l_suppkey, count(*) AS t FROM t GROUP BY 1) b USING (l_suppkey)""",
    t=_arrived(DUCK),
)


def qa_export_post(spark, sf):
    """Orders per status against what an upsert export holds of them."""
    orders = inp.tables(spark, sf)["orders"]
    changes = inp.derive(spark, sf, inp.order_changes(SPARK)).where("o_orderkey < 1000000000")
    exported = export.update_rows(orders, changes, ["o_orderkey"], scratch(spark, "export_post"))
    return quality.after_export(compare.two_counts(orders, exported, ["o_orderstatus"]))


EXPORT_POST_SQL = f"""
SELECT o_orderstatus, {_COUNT_COLUMNS}
FROM (SELECT o_orderstatus, count(*) AS s FROM orders GROUP BY 1) a
FULL JOIN (SELECT CASE WHEN o_orderkey % 10 = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, count(*) AS t
           FROM orders GROUP BY 1) b USING (o_orderstatus)
"""

# schemas --------------------------------------------------------------------------------


def _twins(dialect):
    """The catalog, where every tenth table has one of the same name at another vendor, with other types."""
    rows = inp.catalog(dialect)
    columns = "table_name, ordinal, column_name, data_type, char_length, num_precision, num_scale, nullable, is_identity, k"
    return f"""SELECT vendor, {columns} FROM ({rows}) c UNION ALL
      SELECT CASE vendor WHEN 'oracle' THEN 'db2' ELSE 'oracle' END, table_name, ordinal, column_name,
             CASE WHEN ordinal % 2 = 0 THEN 'INTEGER' ELSE data_type END, char_length + 3, num_precision, num_scale, nullable, is_identity, k
      FROM ({rows}) c WHERE CAST(substr(table_name, 5, 20) AS BIGINT) % 10 = 1"""


def _source(spark, sf):
    """A vendor catalog with cleaned names, as the comparison takes it."""
    rows = inp.derive(spark, sf, _twins(SPARK))
    return rows.withColumn("column_name", F.lower(catalog.names.lake_name(F.col("column_name"))))


def _faulty(lake):
    """A lake catalog with planted faults: a wrong name, a wrong type, a short length, a missing column."""
    number = F.substring("table_name", 5, 20).cast("bigint")
    return (
        lake.withColumns(
            {
                "column_name": F.when((number % 11 == 3) & (F.col("ordinal") == 2), F.lit("other")).otherwise(F.col("column_name")),
                "data_type": F.when((number % 13 == 4) & (F.col("ordinal") == 3), F.lit("BOOLEAN")).otherwise(F.col("data_type")),
                "char_length": F.when(number % 7 == 5, F.col("char_length") - 1).otherwise(F.col("char_length")),
                "num_scale": F.when(number % 5 == 2, F.col("num_scale") - 1).otherwise(F.col("num_scale")),
            }
        )
        .where(~((number % 17 == 6) & (F.col("ordinal") == 8)))
        .drop("col_type", "known_type")
    )


def _lake(spark, sf):
    return catalog.lake_catalog(inp.derive(spark, sf, _twins(SPARK)))


_SIZES = r"""SELECT vendor, table_name, ordinal, lake_column AS column_name, regexp_replace(col_type, '\(.*$', '') AS data_type,
       CASE WHEN col_type LIKE '%CHAR(%' THEN CAST(regexp_extract(col_type, '\((\d+)\)', 1) AS INTEGER) END AS char_length,
       CASE WHEN col_type LIKE 'DECIMAL%' THEN CAST(regexp_extract(col_type, '\((\d+),', 1) AS INTEGER) END AS num_precision,
       CASE WHEN col_type LIKE 'DECIMAL%' THEN CAST(regexp_extract(col_type, ',(\d+)\)', 1) AS INTEGER) END AS num_scale FROM l"""
_FAULTY = """SELECT vendor, table_name, ordinal,
       CASE WHEN n % 11 = 3 AND ordinal = 2 THEN 'other' ELSE column_name END AS column_name,
       CASE WHEN n % 13 = 4 AND ordinal = 3 THEN 'BOOLEAN' ELSE data_type END AS data_type,
       CASE WHEN n % 7 = 5 THEN char_length - 1 ELSE char_length END AS char_length, num_precision,
       CASE WHEN n % 5 = 2 THEN num_scale - 1 ELSE num_scale END AS num_scale
FROM (SELECT *, CAST(substr(table_name, 5) AS BIGINT) AS n FROM sz) z WHERE NOT (n % 17 = 6 AND ordinal = 8)"""


def _allowed_rows(direction: str) -> str:
    rows = [(v, lake, t) for (v, lake), listed in compat.allowed(direction).items() for t in dict.fromkeys(listed)]
    return inp.values(rows, "vendor, lake, vendor_type")


def _match_sql(direction: str, lake: str) -> str:
    small, large = ("s", "t") if direction == "ingest" else ("t", "s")
    fits = " AND ".join(f"coalesce({small}_{x} <= {large}_{x}, true)" for x in ("length", "precision", "scale"))
    identity = "WHERE NOT is_identity" if direction == "export" else ""
    mapped = " OR coalesce(mapped = lake_type OR (lake_type = 'STRING' AND mapped IN ('VARCHAR', 'CHAR')), false)" if direction == "ingest" else ""
    return f"""
      SELECT x.vendor, table_name, ordinal, source_column, lake_column,
             coalesce(source_column = lake_column, false) AS name_ok, a.vendor IS NOT NULL{mapped} AS type_ok,
             lake_column IS NOT NULL AND (lake_type NOT IN ('DECIMAL', 'VARCHAR', 'CHAR') OR ({fits})) AS length_ok
      FROM (SELECT s.vendor, s.table_name, s.ordinal, s.lake_column AS source_column, l2.column_name AS lake_column,
                   l2.data_type AS lake_type, CASE WHEN s.known_type THEN replace(s.lake, 'TIMESTAMP_DATE', 'TIMESTAMP') END AS mapped, lower(trim(regexp_replace(s.data_type, '\\(.*$', ''))) AS source_type,
                   CASE WHEN lower(s.data_type) NOT IN ('number', 'decimal', 'numeric', 'd') THEN s.len END AS s_length,
                   s.num_precision AS s_precision, s.num_scale AS s_scale,
                   l2.char_length AS t_length, l2.num_precision AS t_precision, l2.num_scale AS t_scale
            FROM (SELECT * FROM l {identity}) s
            LEFT JOIN {lake} l2 ON l2.vendor = s.vendor AND l2.table_name = s.table_name AND l2.ordinal = s.ordinal) x
      LEFT JOIN {'al' if direction == 'ingest' else 'ex'} a ON a.vendor = x.vendor AND a.lake = lake_type AND a.vendor_type = source_type"""


def _schema_sql(body: str, **extra: str) -> str:
    return inp.with_inputs(
        body, c=_twins(DUCK), ty=_TYPE_ROWS, l=lake_catalog_sql(), sz=_SIZES, fz=_FAULTY,
        al=_allowed_rows("ingest"), ex=_allowed_rows("export"), **extra,
    )


_VERDICT = "SELECT vendor, table_name, bool_and(name_ok AND type_ok AND length_ok) AS ok FROM {0} GROUP BY ALL"


def qa_schema_match(spark, sf):
    return compare.schema_match(_source(spark, sf), _faulty(_lake(spark, sf)))


def qa_export_schema(spark, sf):
    return compare.schema_match(_source(spark, sf), _faulty(_lake(spark, sf)), "export")


def qa_full_ingest(spark, sf):
    return quality.full_load(_source(spark, sf), _faulty(_lake(spark, sf)))


FULL_INGEST_SQL = _schema_sql(
    f"SELECT vendor, table_name, 'ddl' AS stage, ok AS passed FROM ({_VERDICT.format('m')}) v", m=_match_sql("ingest", "fz")
)


def _increment_counts(dialect):
    """Rows read and rows landed per table of the catalog."""
    source = "SELECT vendor, table_name, char_length AS a, char_length - CASE WHEN ordinal % 4 = 1 AND k % 3 = 0 THEN 8 ELSE 0 END AS b"
    return f"""SELECT vendor, table_name, sum(abs(a)) AS source_rows, sum(abs(b)) AS target_rows
               FROM ({source} FROM ({inp.catalog(dialect)}) c) x GROUP BY vendor, table_name"""


def qa_incremental(spark, sf):
    lake = _lake(spark, sf)
    counts = inp.derive(spark, sf, _increment_counts(SPARK))
    return quality.incremental(counts, _source(spark, sf), lake.drop("col_type", "known_type"), _faulty(lake))


INCREMENTAL_SQL = _schema_sql(
    f"""SELECT vendor, table_name, 'count' AS stage,
               source_rows = 0 OR (target_rows * 100 > 95 * source_rows AND target_rows <= source_rows) AS passed FROM n
        UNION ALL SELECT vendor, table_name, 'increment_ddl', ok FROM ({_VERDICT.format('mi')}) a
        UNION ALL SELECT vendor, table_name, 'live_ddl', ok FROM ({_VERDICT.format('ml')}) b""",
    n=_increment_counts(DUCK), mi=_match_sql("ingest", "sz"), ml=_match_sql("ingest", "fz"),
)


def qa_nullable(spark, sf):
    return compare.nullable_check(inp.derive(spark, sf, inp.catalog(SPARK)))


NULLABLE_SQL = inp.with_inputs(
    "SELECT vendor, table_name, bool_and(upper(nullable) IN ('Y', 'YES')) AS all_nullable FROM c GROUP BY ALL", c=inp.catalog(DUCK)
)


def qa_column_set(spark, sf):
    return compare.column_set_check(_faulty(_lake(spark, sf)), _source(spark, sf))


_COLUMN_SET = """SELECT vendor, table_name, count(*) FILTER (WHERE NOT t) AS only_source, count(*) FILTER (WHERE NOT s) AS only_target,
       bool_and(s AND t) OR any_value(vendor) <> 'db2' AS columns_ok
FROM (SELECT vendor, table_name, column_name, bool_or(s) AS s, bool_or(t) AS t FROM (
        SELECT vendor, table_name, lower(column_name) AS column_name, true AS s, false AS t FROM fz
        UNION ALL SELECT vendor, table_name, lower(lake_column), false, true FROM l) u GROUP BY ALL) g
GROUP BY vendor, table_name"""


def qa_export_pre(spark, sf):
    return quality.before_export(_faulty(_lake(spark, sf)), _source(spark, sf))


EXPORT_PRE_SQL = _schema_sql(
    f"""SELECT vendor, table_name, 'ddl' AS stage, ok AS passed FROM ({_VERDICT.format('m')}) v
        UNION ALL SELECT vendor, table_name, 'ddl_null_check', bool_and(upper(nullable) IN ('Y', 'YES')) FROM c GROUP BY ALL
        UNION ALL SELECT vendor, table_name, 'ddl_column', columns_ok FROM ({_COLUMN_SET}) s""",
    m=_match_sql("export", "fz"),
)


def qa_target_empty(spark, sf):
    """Whether each status's target is empty: only the orders of status F were exported before."""
    orders = inp.tables(spark, sf)["orders"]
    exported = export.insert_rows(orders.where("o_orderstatus = 'F'"), scratch(spark, "target"))
    return export.empty_targets(orders, exported, ["o_orderstatus"])


# rows -----------------------------------------------------------------------------------

ORDER_TYPES = {
    "o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "CHAR(1)", "o_totalprice": "DOUBLE",
    "o_orderdate": "TIMESTAMP", "o_orderpriority": "VARCHAR(15)",
}


def qa_row_match(spark, sf):
    orders = inp.tables(spark, sf)["orders"]
    return compare.match_rows(orders, inp.derive(spark, sf, inp.changed_orders(SPARK)), ["o_orderkey"], ORDER_TYPES)


def qa_reconcile(spark, sf):
    """The same verdicts, by joining the rows of differing buckets alone."""
    orders = inp.tables(spark, sf)["orders"]
    return reconcile.reconcile(orders, inp.derive(spark, sf, inp.changed_orders(SPARK)), ["o_orderkey"], ORDER_TYPES)


ROW_MATCH_SQL = inp.with_inputs(
    """SELECT o.o_orderkey, coalesce(n, 0) AS n_matches, coalesce(CASE WHEN n = 1 THEN concat_ws(',',
              CASE WHEN o.o_custkey IS DISTINCT FROM f.o_custkey THEN 'o_custkey' END,
              CASE WHEN trim(o.o_orderstatus) IS DISTINCT FROM trim(f.o_orderstatus) THEN 'o_orderstatus' END,
              CASE WHEN o.o_totalprice IS DISTINCT FROM f.o_totalprice THEN 'o_totalprice' END,
              CASE WHEN o.o_orderdate IS DISTINCT FROM f.o_orderdate THEN 'o_orderdate' END,
              CASE WHEN trim(o.o_orderpriority) IS DISTINCT FROM trim(f.o_orderpriority) THEN 'o_orderpriority' END) END, '') AS mismatched,
              n IS NOT DISTINCT FROM 1 AND o.o_totalprice IS NOT DISTINCT FROM f.o_totalprice
                AND o.o_orderpriority IS NOT DISTINCT FROM f.o_orderpriority AS row_ok
       FROM orders o
       LEFT JOIN (SELECT o_orderkey, count(*) AS n FROM h GROUP BY 1) k ON k.o_orderkey = o.o_orderkey
       LEFT JOIN (SELECT DISTINCT * FROM h) f ON f.o_orderkey = o.o_orderkey""",
    h=inp.changed_orders(DUCK),
)

_LINEITEM_LAKE = dict(zip([f.name for f in LINEITEM_FIELDS], project.lake_types(LINEITEM_FIELDS, "db2")))


def qa_conformance(spark, sf):
    return compare.conformance(inp.derive(spark, sf, inp.lineitem_text(SPARK)), _LINEITEM_LAKE)


def _conforms_sql(column: str, lake: str) -> str:
    kind = lake.split("(")[0]
    if kind in ("VARCHAR", "CHAR"):
        return f"length({column}) <= {lake[len(kind) + 1:-1]}"
    if kind == "DECIMAL":
        p, s = lake[8:-1].split(",")
        whole = f"length(ltrim(split_part(ltrim({column}, '+-'), '.', 1), '0'))"
        digits = f"length(rtrim(split_part({column}, '.', 2), '0'))"
        number = f"TRY_CAST({column} AS DOUBLE) IS NOT NULL"
        return f"{number} AND {whole} <= {int(p) - int(s)} AND {digits} <= {s}"
    spark_types = {"INT": "INTEGER", "TIMESTAMP": "TIMESTAMP"}
    return f"TRY_CAST({column} AS {spark_types.get(kind, kind)}) IS NOT NULL"


CONFORMANCE_SQL = inp.with_inputs(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS lake_type, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({_conforms_sql(c, t)})) AS n_bad, "
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({_conforms_sql(c, t)})) = 0 AS conforms FROM t"
        for c, t in _LINEITEM_LAKE.items()
    ),
    t=inp.lineitem_text(DUCK),
)


def qa_sampling(spark, sf):
    """Five sampled orders looked up in a faithful copy and in one without them."""
    orders = inp.tables(spark, sf)["orders"]
    good = quality.sampling(orders, orders, "o_orderkey", ORDER_TYPES)
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    bad = quality.sampling(orders, changed, "o_orderkey", ORDER_TYPES)
    return good.withColumn("target", F.lit("faithful")).unionByName(bad.withColumn("target", F.lit("changed")))


SAMPLING_SQL = """
WITH s AS (SELECT * FROM orders ORDER BY md5(o_orderkey || '|1'), o_orderkey LIMIT 5),
     t AS (SELECT 'faithful' AS target, * FROM orders
           UNION ALL SELECT 'changed', * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders),
     f AS (SELECT x.target, s.o_orderkey, count(t.o_orderkey) AS n
           FROM s CROSS JOIN (SELECT DISTINCT target FROM t) x
           LEFT JOIN t ON t.target = x.target AND t.o_orderkey = s.o_orderkey AND t.o_totalprice = s.o_totalprice
           GROUP BY ALL)
SELECT target, 'row_found' AS stage, bool_and(n = 1) AS passed FROM f GROUP BY target
UNION ALL SELECT target, 'row_match', bool_and(n = 1) FROM f GROUP BY target
UNION ALL SELECT target, 'conformance', bool_and(length(o_orderstatus) <= 1 AND length(o_orderpriority) <= 15) FROM t GROUP BY target
"""

def qa_status(spark, sf):
    """The verdicts of an incremental check as the quality log keeps them."""
    return quality.status_json(qa_incremental(spark, sf))


STATUS_SQL = f"""
SELECT vendor, table_name, '{{' || string_agg('"' || stage || '":' || passed, ',' ORDER BY stage) || '}}' AS status
FROM ({INCREMENTAL_SQL}) x GROUP BY vendor, table_name
"""


# the log ---------------------------------------------------------------------------------


def qa_log_escape(spark, sf):
    documents = inp.tables(spark, sf)["documents"]
    return documents.select("doc_id", escape_log(F.col("text")).alias("log"))


LOG_ESCAPE_SQL = r"""
SELECT doc_id, replace(replace(replace(replace(replace(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
       '''', '\'''), '"', '\"'), ',', '\,'), chr(10), ' '), chr(13), '') AS log FROM documents"""


def _event_log(spark, sf):
    return inp.tables(spark, sf)["events"].select(
        F.col("ts").cast("timestamp").alias("log_time"), F.concat(F.lit("tab_"), F.col("user_id")).alias("table_name"),
        F.col("event_id").cast("string").alias("log"), F.when(F.col("event_type") == "error", "failed").otherwise("passed").alias("status"),
    )


def qa_log_latest(spark, sf):
    """The newest rows of a quality log kept over events."""
    log, path = _event_log(spark, sf), scratch(spark, "qa_log")
    for part, batch in ((log.where("status = 'passed'"), "one"), (log.where("status = 'failed'"), "two")):
        stores.append_log(part, path, batch)
    return stores.latest_log(spark, path).withColumn("log_time", F.col("log_time").cast("timestamp_ntz"))


def qa_log_folded(spark, sf):
    """A log of seven batches, folded twice between them; one batch is stored again after it was folded."""
    log, path = _event_log(spark, sf), scratch(spark, "qa_log")
    part = lambda i: log.where(F.pmod(F.col("log").cast("bigint"), F.lit(7)) == i)
    for folded, batches in ((True, range(3)), (True, range(3, 6)), (False, [6, 0])):
        for i in batches:
            stores.append_log(part(i), path, f"b{i}")
        if folded:
            stores.fold_log(spark, path)
    return stores.read_log(spark, path).withColumn("log_time", F.col("log_time").cast("timestamp_ntz"))


EVENT_LOG_SQL = (
    "SELECT ts AS log_time, 'tab_' || user_id AS table_name, CAST(event_id AS VARCHAR) AS log, "
    "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'passed' END AS status FROM events"
)

KEYS = {
    "qa_column_set": (qa_column_set, _schema_sql(_COLUMN_SET)),
    "qa_conformance": (qa_conformance, CONFORMANCE_SQL),
    "qa_count_match": (qa_count_match, COUNT_MATCH_SQL),
    "qa_export_post": (qa_export_post, EXPORT_POST_SQL),
    "qa_export_pre": (qa_export_pre, EXPORT_PRE_SQL),
    "qa_export_schema": (qa_export_schema, _schema_sql(_match_sql("export", "fz"))),
    "qa_full_ingest": (qa_full_ingest, FULL_INGEST_SQL),
    "qa_incremental": (qa_incremental, INCREMENTAL_SQL),
    "qa_log_escape": (qa_log_escape, LOG_ESCAPE_SQL),
    "qa_log_folded": (qa_log_folded, EVENT_LOG_SQL),
    "qa_log_latest": (qa_log_latest, f"{EVENT_LOG_SQL} ORDER BY ts DESC, table_name, log LIMIT 20"),
    "qa_nullable": (qa_nullable, NULLABLE_SQL),
    "qa_reconcile": (qa_reconcile, ROW_MATCH_SQL),
    "qa_row_match": (qa_row_match, ROW_MATCH_SQL),
    "qa_sampling": (qa_sampling, SAMPLING_SQL),
    "qa_schema_match": (qa_schema_match, _schema_sql(_match_sql("ingest", "fz"))),
    "qa_status": (qa_status, STATUS_SQL),
    "qa_target_empty": (
        qa_target_empty,
        "SELECT o_orderstatus, count(*) FILTER (WHERE o_orderstatus = 'F') = 0 AS target_empty FROM orders GROUP BY 1",
    ),
}
