"""Inputs derived from the given tables, as one SQL text per input.

The text is the same for both engines but for the few functions whose names differ, so the
check reads the same rows as the query. Each input grows with the table it is derived from.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions import codes
from ..session import table, tune

SPARK, DUCK = "spark", "duck"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def pick(number: str, values: list[str | None]) -> str:
    """The value at ``number`` modulo the list's length, as a CASE."""
    whens = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values)
    )
    return f"CASE ({number}) % {len(values)} {whens} END"


def div(a: str, b: int, dialect: str) -> str:
    return f"(({a}) div {b})" if dialect == SPARK else f"(({a}) // {b})"


def log_time(ts: str, dialect: str) -> str:
    if dialect == SPARK:
        return f"concat(date_format({ts}, 'EEE, dd MMM yyyy HH:mm:ss'), ' GMT')"
    return f"strftime({ts}, '%a, %d %b %Y %H:%M:%S') || ' GMT'"


def plus_seconds(ts: str, seconds: str, dialect: str) -> str:
    if dialect == SPARK:
        return f"timestampadd(SECOND, CAST({seconds} AS INT), {ts})"
    return f"({ts} + to_seconds(CAST({seconds} AS BIGINT)))"


def time_text(ts: str, dialect: str, fraction: bool = False) -> str:
    if dialect == SPARK:
        return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss{'.SSSSSS' if fraction else ''}')"
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S{'.%f' if fraction else ''}')"


# Vendor types the derived catalogs use.
VENDOR_TYPES = {
    "oracle": [
        "NUMBER", "VARCHAR2", "NVARCHAR2", "CHAR", "DATE", "TIMESTAMP(6)", "CLOB", "FLOAT", "LONG RAW",
        "TIMESTAMP(6) WITH TIME ZONE", "XMLTYPE",
    ],
    "db2": ["INTEGER", "SMALLINT", "BIGINT", "DECIMAL", "VARCHAR", "CHAR", "TIMESTMP", "DATE", "TIME", "DOUBLE", "ROWID"],
    "teradata": ["I", "I1", "I2", "I8", "D", "CV", "CF", "DA", "TS", "F", "++"],
    "sqlserver": [
        "int", "bigint", "tinyint", "bit", "decimal", "varchar", "nvarchar", "datetime2", "money",
        "uniqueidentifier", "geopoint",
    ],
    "postgresql": [
        "integer", "bigint", "boolean", "varchar", "json", "uuid", "numeric", "timestamp without time zone",
        "bytea", "date", "char",
    ],
    "mysql": ["int", "mediumint", "varchar", "text", "datetime", "year", "decimal", "enum", "double", "tinyint", "char"],
}
COLUMNS_PER_TABLE = 8


def vendor_of(number: str) -> str:
    return pick(number, list(codes.VENDORS))


def catalog(dialect: str) -> str:
    """A catalog of tables with eight columns each, over ``part``: every type, awkward names, gaps in sizes."""
    t = div("p_partkey", COLUMNS_PER_TABLE, dialect)
    types = " ".join(
        f"WHEN {i} THEN " + pick("p_partkey * 5 + p_size", VENDOR_TYPES[v]) for i, v in enumerate(codes.VENDORS)
    )
    name = f"""CASE p_partkey % 7
        WHEN 0 THEN upper(replace(p_name, ' ', '_')) || '_' || (p_partkey % 8)
        WHEN 1 THEN p_name || ' ' || (p_partkey % 8)
        WHEN 2 THEN '_' || replace(p_name, ' ', '') || (p_partkey % 8)
        WHEN 3 THEN (p_partkey % 8) || 'st ' || p_name
        WHEN 4 THEN replace(p_name, ' ', '$') || '-' || (p_partkey % 8)
        WHEN 5 THEN p_brand || (p_partkey % 8)
        ELSE 'public' END"""
    return f"""
      SELECT {vendor_of(t)} AS vendor,
             'tab_' || {t} AS table_name,
             CAST(p_partkey % 8 + 1 AS INT) AS ordinal,
             {name} AS column_name,
             CASE ({t}) % 6 {types} END AS data_type,
             CAST(CASE WHEN {t} % 6 IN (3, 4) AND p_size % 9 = 0 THEN -1 ELSE p_size * 4 END AS INT) AS char_length,
             CAST(CASE WHEN p_size % 7 = 0 THEN NULL ELSE 10 + p_size % 20 END AS INT) AS num_precision,
             CAST(CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 5 END AS INT) AS num_scale,
             {pick("p_size", ["Y", "YES", "Y", "N", "YES"])} AS nullable,
             p_partkey % 29 = 0 AS is_identity,
             p_partkey AS k
      FROM part"""


def registry(dialect: str) -> str:
    """One registered table per customer, with every frequency, weight, vendor and kind of view list."""
    vendor = vendor_of("c_nationkey")
    return f"""
      SELECT coalesce(nullif({pick("c_custkey", ["", "sales_i", None, "finance", "risk"])}, ''), 'none')
               || '.db' || c_nationkey || '_tbl_' || c_custkey AS full_table_name,
             {pick("c_custkey", ["", "sales_i", None, "finance", "risk"])} AS domain,
             'mdm/' || c_custkey AS target_dir,
             {pick("c_custkey", ["", "id", "c_key"])} AS split_by,
             CAST(c_custkey % 12 AS INT) AS mappers,
             'jdbc:' || {vendor} || '://host' || c_nationkey || '/x' AS jdbcurl,
             'factory' AS connection_factories,
             'user_' || c_nationkey AS db_username,
             '/pw/' || c_nationkey AS password_file,
             {pick("c_custkey", list(codes.FREQUENCY_BITS.values()))}
               || {pick("c_custkey", list(codes.WEIGHT_BITS.values()))} AS load,
             CAST(50000 AS INT) AS fetch_size,
             CAST(CASE WHEN c_custkey % 23 = 0 THEN 1 ELSE 0 END AS INT) AS hold,
             'C1' || CASE WHEN c_custkey % 40 < 10 THEN '00' ELSE '0' END || (c_custkey % 40) || 'x' AS automation_appl_id,
             {pick("c_custkey", ["team_a", "team_a|sales", "team_b|sales|team_c", None, "team_abc|risk", "sales"])} AS views,
             CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'grp' || (c_custkey % 6) END AS automation_group,
             {pick("c_custkey", ["updated_at", "", ""])} AS check_column,
             'dbo' AS source_schema_name,
             CASE WHEN c_custkey % 10 = 0 THEN 'ID > ' || c_custkey ELSE '' END AS sql_query,
             '' AS actions,
             'db' || c_nationkey AS source_database_name,
             'tbl_' || c_custkey AS source_table_name,
             {pick("c_custkey", ["dev", "int", "prod", "dev"])} AS db_env,
             c_custkey AS k
      FROM customer"""


ACTIONS_PER_RUN = 8


def run_actions(dialect: str) -> str:
    """One action per event; eight events are a run, and a run loads two tables."""
    run = div("event_id", ACTIONS_PER_RUN, dialect)
    raw = f"CASE WHEN user_id % 2 = 0 THEN 'tab-' || ({run} % 50) ELSE 'tab-' || ({run} % 50 * 10 + 1) END"
    step = (
        "CASE event_type WHEN 'signup' THEN 'import_prep' WHEN 'view' THEN 'avro_parquet' "
        "WHEN 'click' THEN 'parquet_live' ELSE 'import' END"
    )
    return f"""
      SELECT run_id, app, action_id, raw_table,
             replace(raw_table, '-', '') || '_' || step AS name,
             CASE step WHEN 'import' THEN 'sqoop' WHEN 'parquet_live' THEN 'hive' ELSE 'shell' END AS type,
             CASE WHEN event_type = 'error' THEN 'KILLED' ELSE 'OK' END AS status,
             ts AS started, {plus_seconds("ts", "floor(value)", dialect)} AS ended,
             {log_time("ts", dialect)} AS start_text,
             {log_time(plus_seconds("ts", "floor(value)", dialect), dialect)} AS end_text,
             CASE WHEN step = 'import_prep' THEN '<env-var>source_table_name=' || raw_table
                  || '</env-var><env-var>target_dir=mdm/' || raw_table
                  || '</env-var><env-var>domain=dom' || (action_id % 3) || '</env-var>' ELSE '' END AS conf,
             CASE WHEN step = 'import' THEN '{{"task.Counter":{{"MAP_INPUT_RECORDS":' || n
                  || ',"MAP_OUTPUT_RECORDS":' || (n + CASE WHEN action_id % 13 = 0 THEN 1 ELSE 0 END)
                  || '}},"fs.Counter":{{"HDFS_BYTES_WRITTEN":' || (n * 100) || '}}}}' END AS stats,
             CASE WHEN step = 'import' THEN n END AS records_in,
             CASE WHEN step = 'import' THEN n + CASE WHEN action_id % 13 = 0 THEN 1 ELSE 0 END END AS records_out,
             CASE WHEN step = 'import' THEN n * 100 END AS bytes_written
      FROM (SELECT {run} AS run_id, 'wf_' || ({run} % 20) AS app, event_id AS action_id, {raw} AS raw_table,
                   {step} AS step, event_id * 7 % 1000 AS n, event_type, ts, value FROM events) e"""


AUDIT_COLUMNS = (
    "directory, pull_time, avro_size, ingest_timestamp, parquet_time, parquet_size, rows, lifespan, ack, cleaned, "
    'current_repull, automation_appl_id, domain, "table"'
)


def audit(dialect: str) -> str:
    """The current audit row of each registered table that was loaded, over ``customer``."""
    q = "`" if dialect == SPARK else '"'
    return f"""
      SELECT 'mdm/' || c_custkey AS directory,
             CAST(c_custkey % 600 AS INT) AS pull_time,
             c_custkey * 1000 AS avro_size,
             '2016-01-0' || (c_custkey % 9 + 1) || ' 10:00:00' AS ingest_timestamp,
             CAST(c_custkey % 300 AS INT) AS parquet_time,
             c_custkey * 400 AS parquet_size,
             c_custkey * 3 AS {q}rows{q},
             'unknown' AS lifespan,
             CAST(0 AS INT) AS ack, CAST(0 AS INT) AS cleaned, CAST(0 AS INT) AS current_repull,
             'C1' AS automation_appl_id,
             {pick("c_custkey", ["none", "sales_i", "nowhere", "finance", "risk"])} AS domain,
             'tbl_' || c_custkey AS {q}table{q}
      FROM customer WHERE c_custkey % 5 <> 4"""


def lineitem_text(dialect: str) -> str:
    """Lineitem as text with planted faults: a letter in a number, an over-long flag, a negative price."""
    return """
      SELECT CASE WHEN l_orderkey % 97 = 1 THEN 'x' || l_orderkey ELSE CAST(l_orderkey AS {text}) END AS l_orderkey,
             CAST(l_partkey AS {text}) AS l_partkey,
             CAST(l_suppkey AS {text}) AS l_suppkey,
             CASE WHEN l_orderkey % 97 = 2 THEN 'n/a' ELSE CAST(l_linenumber AS {text}) END AS l_linenumber,
             CAST(CAST(l_quantity AS DECIMAL(12,2)) AS {text}) AS l_quantity,
             CASE WHEN l_orderkey % 97 = 3 THEN '-' ELSE '' END
               || CASE WHEN l_orderkey % 97 = 4 THEN '99999999999' ELSE '' END
               || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS {text}) AS l_extendedprice,
             CAST(CAST(l_discount AS DECIMAL(12,2)) AS {text})
               || CASE WHEN l_orderkey % 97 = 5 THEN '123' ELSE '' END AS l_discount,
             CASE WHEN l_orderkey % 97 = 6 THEN NULL ELSE CAST(CAST(l_tax AS DECIMAL(12,2)) AS {text}) END AS l_tax,
             l_returnflag || CASE WHEN l_orderkey % 97 = 7 THEN 'LONG' ELSE '' END AS l_returnflag,
             l_linestatus,
             CASE WHEN l_orderkey % 97 = 8 THEN 'not a date' ELSE {day} END
               || CASE WHEN l_orderkey % 97 = 9 THEN '.500000' ELSE '' END AS l_shipdate
      FROM lineitem""".format(text="STRING" if dialect == SPARK else "VARCHAR", day=time_text("l_shipdate", dialect))


def changed_orders(dialect: str) -> str:
    """Orders as a faulty copy: changed values, padded text, missing rows, rows there twice."""
    body = """SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderkey % 101 = 2 THEN o_orderstatus || '   ' ELSE o_orderstatus END AS o_orderstatus,
             CASE WHEN o_orderkey % 101 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
             o_orderdate,
             CASE WHEN o_orderkey % 101 = 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority
      FROM orders"""
    return f"{body} WHERE o_orderkey % 101 <> 4 UNION ALL {body} WHERE o_orderkey % 101 = 5"


def order_changes(dialect: str) -> str:
    """Changed and new orders to be merged into ``orders``."""
    return """
      SELECT CASE WHEN o_orderkey % 10 = 3 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey,
             o_custkey, 'X' AS o_orderstatus, o_totalprice + 10 AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderkey % 10 IN (3, 7)"""


class Tables(dict):
    """The given tables by name, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = table(self.spark, self.sf_dir, name)
        return self[name]


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(tune(spark), sf_dir)


TABLE_NAME = re.compile(rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run one input's SQL over the given tables."""
    known = tables(spark, sf_dir)
    used = {name for _, name in TABLE_NAME.findall(text)}
    quoted = text.replace("{", "{{").replace("}", "}}")
    return spark.sql(TABLE_NAME.sub(r"\1 {\2}", quoted), **{name: known[name] for name in used})


def with_inputs(body: str, **inputs: str) -> str:
    """A check's SQL with its inputs in front."""
    listed = ", ".join(f"{name} AS ({text})" for name, text in inputs.items())
    return f"WITH {listed} {body}"


def values(rows: list[tuple], columns: str) -> str:
    """A lookup table in a check's SQL."""

    def shown(v) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(shown(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) t({columns})"
