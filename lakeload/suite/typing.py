"""Queries for names, types, projection and profiling."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import codes, names, types
from ..operators import catalog, profile, project
from ..plans import limited
from ..plans.steps import unique_name
from ..session import scratch
from ..sinks import publish
from . import inputs as inp
from .inputs import DUCK, SPARK

CLEAN = r"regexp_replace({0}, '[^A-Za-z0-9_]', '', 'g')"
LAKE_NAME_SQL = (
    "CASE WHEN regexp_matches({1}, '^[0-9]') THEN 'i_' || {1} ELSE {1} END".replace("{1}", CLEAN)
)


def lake_name_sql(column: str) -> str:
    return LAKE_NAME_SQL.replace("{0}", column)


def clean_names(spark, sf):
    rows = inp.derive(spark, sf, inp.catalog(SPARK))
    raw = F.col("column_name")
    return rows.select(
        "table_name", "ordinal", "column_name", names.lake_name(raw).alias("lake_name"),
        names.landing_name(raw).alias("landing_name"), names.extract_name(raw).alias("extract_name"),
        names.table_name(F.col("table_name")).alias("clean_table"),
    )


CLEAN_NAMES_SQL = inp.with_inputs(
    """SELECT table_name, ordinal, column_name, lake_name,
              CASE WHEN lake_name LIKE '\\_%' ESCAPE '\\' THEN 'i' || lake_name
                   WHEN lake_name = 'public' THEN '_public' ELSE lake_name END AS landing_name,
              CASE WHEN lake_name LIKE '\\_%' ESCAPE '\\' THEN 'i' || lake_name ELSE lake_name END AS extract_name,
              regexp_replace(table_name, '[^A-Za-z0-9]', '', 'g') AS clean_table
       FROM (SELECT *, """ + lake_name_sql("column_name") + " AS lake_name FROM c) n",
    c=inp.catalog(DUCK),
)

_TYPE_ROWS = inp.values(list(types.pairs().items()), "vendor_type, lake")


def lake_catalog_sql() -> str:
    """A catalog's lake side in the check's SQL: needs ``c`` (catalog) and ``ty`` (type pairs)."""
    return f"""
      SELECT *, CASE WHEN lake = 'DECIMAL' THEN 'DECIMAL(' ||
                          CASE WHEN num_precision IS NULL THEN 38 ELSE least(38, num_precision - least(coalesce(num_scale, 0), 0)) END || ',' ||
                          CASE WHEN num_precision IS NULL THEN 18 ELSE greatest(coalesce(num_scale, 0), 0) END || ')'
                     WHEN lake IN ('VARCHAR', 'CHAR') THEN coalesce(lake || '(' || len || ')', 'STRING')
                     WHEN lake = 'TIMESTAMP_DATE' THEN 'TIMESTAMP' ELSE lake END AS col_type
      FROM (SELECT c.*, lower({lake_name_sql("c.column_name")}) AS lake_column,
                   coalesce(f.lake, w.lake, 'STRING') AS lake, coalesce(f.lake, w.lake) IS NOT NULL AS known_type,
                   nullif(char_length, -1) AS len
            FROM c LEFT JOIN ty f ON f.vendor_type = upper(trim(c.data_type))
                   LEFT JOIN ty w ON w.vendor_type = regexp_extract(upper(c.data_type), '([A-Z0-9]+)', 1)) x"""


def lake_schema(spark, sf):
    rows = inp.derive(spark, sf, inp.catalog(SPARK))
    return catalog.lake_catalog(rows).select("vendor", "table_name", "ordinal", "column_name", "col_type", "known_type")


LAKE_SCHEMA_SQL = inp.with_inputs(
    "SELECT vendor, table_name, ordinal, lake_column AS column_name, col_type, known_type FROM l",
    c=inp.catalog(DUCK), ty=_TYPE_ROWS, l=lake_catalog_sql(),
)

def _lengths(dialect):
    """Measured lengths of two thirds of the catalog's columns."""
    return f"SELECT table_name, column_name, max(char_length % 30 + 1) AS max_length FROM ({inp.catalog(dialect)}) c WHERE k % 3 > 0 GROUP BY table_name, column_name"


def measured_precision(spark, sf):
    rows = inp.derive(spark, sf, inp.catalog(SPARK)).where("column_name <> 'public'")
    measured = catalog.with_measured_precision(rows, inp.derive(spark, sf, _lengths(SPARK)))
    return measured.select("vendor", "table_name", "ordinal", "data_type", "num_precision", "num_scale")


MEASURED_SQL = inp.with_inputs(
    """SELECT vendor, table_name, ordinal, data_type,
              CASE WHEN number THEN coalesce(num_precision, max_length) ELSE num_precision END AS num_precision,
              CASE WHEN number THEN coalesce(num_scale, 0) ELSE num_scale END AS num_scale
       FROM (SELECT c.*, n.max_length, upper(c.data_type) IN ('D', 'DECIMAL', 'DEC', 'NUMBER') AS number
             FROM c LEFT JOIN n USING (table_name, column_name) WHERE c.column_name <> 'public') x""",
    c=inp.catalog(DUCK), n=_lengths(DUCK),
)

LINEITEM_FIELDS = [
    project.Field("l_orderkey", "BIGINT"), project.Field("l_partkey", "BIGINT"), project.Field("l_suppkey", "INTEGER"),
    project.Field("l_linenumber", "SMALLINT"), project.Field("l_quantity", "DECIMAL", None, 12, 2),
    project.Field("l_extendedprice", "DECIMAL", None, 12, 2), project.Field("l_discount", "DECIMAL", None, 6, 4),
    project.Field("l_tax", "DOUBLE"), project.Field("l_returnflag", "VARCHAR", 1),
    project.Field("l_linestatus", "CHAR", 2), project.Field("l_shipdate", "TIMESTAMP"),
]


def typed_projection(spark, sf):
    """Decimals are shown as text, so their scale is compared as well."""
    typed = project.typed(inp.derive(spark, sf, inp.lineitem_text(SPARK)), LINEITEM_FIELDS, "db2")
    return typed.withColumns(
        {c: F.col(c).cast("string") for c in ("l_quantity", "l_extendedprice", "l_discount")}
    ).withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


_TYPED_COLUMNS = """TRY_CAST(l_orderkey AS BIGINT) AS l_orderkey, TRY_CAST(l_partkey AS BIGINT) AS l_partkey,
       TRY_CAST(l_suppkey AS INTEGER) AS l_suppkey, TRY_CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST(TRY_CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) AS l_quantity,
       CAST(TRY_CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS l_extendedprice,
       CAST(TRY_CAST(l_discount AS DECIMAL(6,4)) AS VARCHAR) AS l_discount,
       TRY_CAST(l_tax AS DOUBLE) AS l_tax, substr(l_returnflag, 1, 1) AS l_returnflag,
       rpad(substr(l_linestatus, 1, 2), 2, ' ') AS l_linestatus, TRY_CAST(l_shipdate AS TIMESTAMP) AS l_shipdate"""
TYPED_SQL = inp.with_inputs(f"SELECT {_TYPED_COLUMNS} FROM t", t=inp.lineitem_text(DUCK))


def _date_texts(dialect):
    day = inp.time_text("o_orderdate", dialect)
    return f"""
      SELECT o_orderkey, {inp.pick("o_orderkey", ["oracle", "db2", "mysql"])} AS vendor,
             CASE WHEN o_orderkey % 11 = 0 THEN 'bad' WHEN o_orderkey % 13 = 0 THEN NULL
                  WHEN o_orderkey % 17 = 0 THEN replace({day}, '-', '/')
                  WHEN o_orderkey % 7 = 0 THEN {day} || '.123' ELSE {day} END AS text
      FROM orders"""


def parse_vendor_date(spark, sf):
    rows = inp.derive(spark, sf, _date_texts(SPARK))
    oracle = project.parse_date(F.col("text"), types.DATE_PATTERNS["oracle"])
    other = project.parse_date(F.col("text"), types.DEFAULT_DATE_PATTERN)
    return rows.select("o_orderkey", "vendor", F.when(F.col("vendor") == "oracle", oracle).otherwise(other).alias("parsed"))


PARSE_DATE_SQL = inp.with_inputs(
    """SELECT o_orderkey, vendor, CASE WHEN vendor = 'oracle' THEN try_strptime(substr(text, 1, 19), '%Y-%m-%d %H:%M:%S')
              ELSE try_strptime(substr(text, 1, 10), '%Y-%m-%d') END AS parsed FROM d""",
    d=_date_texts(DUCK),
)


def _sized_tables(dialect):
    """Estimated row counts per table, from the orders each customer has."""
    return f"""
      SELECT o_custkey AS k, {inp.vendor_of("o_custkey")} AS vendor, CAST(o_custkey % 4 AS INT) AS asked,
             count(*) * CASE o_custkey % 4 WHEN 0 THEN 10000 WHEN 1 THEN 100000 WHEN 2 THEN 500000 ELSE 9000000 END AS est_rows
      FROM orders GROUP BY o_custkey"""


LOAD_SQL = "CASE WHEN est_rows < 2000000 THEN '100' WHEN est_rows <= 100000000 THEN '010' ELSE '001' END"


def load_class(spark, sf):
    rows = inp.derive(spark, sf, _sized_tables(SPARK))
    return rows.select("k", "est_rows", codes.load_class(F.col("est_rows")).alias("load"))


def reader_parallelism(spark, sf):
    rows = inp.derive(spark, sf, _sized_tables(SPARK))
    n = codes.readers(F.col("est_rows"), F.col("vendor"), F.col("asked"), F.lit(None).cast("string"))
    return rows.select("k", "vendor", "asked", "est_rows", n.alias("readers"))


READERS_SQL = inp.with_inputs(
    f"""SELECT k, s.vendor, asked, est_rows,
               CAST(CASE WHEN est_rows <= 250000 THEN CASE WHEN s.vendor = 'oracle' THEN 2 ELSE 1 END
                    WHEN asked > 1 THEN asked ELSE r.n END AS INTEGER) AS readers
        FROM s LEFT JOIN r ON r.vendor = s.vendor AND r.load = {LOAD_SQL}""",
    s=_sized_tables(DUCK),
    r=inp.values([(v, w, n) for v, sizes in codes.READERS.items() for w, n in sizes.items()], "vendor, load, n"),
)


def row_count(spark, sf):
    t = inp.tables(spark, sf)
    return profile.row_counts({name: t[name] for name in inp.TABLES})


ROW_COUNT_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in inp.TABLES)

# All columns of lineitem that a range reader can take.
_QUALITY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]


def _profiled(spark, sf):
    # One column with gaps, since a NULL group counts as a group of size 0.
    lineitem = inp.tables(spark, sf)["lineitem"]
    return lineitem.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_suppkey")))


def split_quality(spark, sf):
    lineitem = _profiled(spark, sf)
    return profile.split_quality(lineitem, profile.splittable(lineitem))


def _quality_sql() -> str:
    groups = " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, count({c}) AS n FROM p GROUP BY {c}"
        for i, c in enumerate(_QUALITY_COLUMNS, start=1)
    )
    return f"""
      SELECT CAST(ordinal AS INTEGER) AS ordinal, column_name, count(*) AS n_groups,
             sqrt(CAST(count(*) * sum(n * n) - sum(n) * sum(n) AS DOUBLE)) / count(*) AS group_stddev
      FROM ({groups}) g GROUP BY ordinal, column_name"""


_PROFILED_SQL = "SELECT * REPLACE (CASE WHEN l_orderkey % 3 <> 0 THEN l_suppkey END AS l_suppkey) FROM lineitem"
SPLIT_QUALITY_SQL = inp.with_inputs("SELECT * FROM q", p=_PROFILED_SQL, q=_quality_sql())


def split_choice(spark, sf):
    """The choice for several numbers of readers, and the rules that need no profile."""
    quality = split_quality(spark, sf)
    return profile.split_choice(
        quality,
        [(2, None, "db2"), (10, None, "mysql"), (60, None, "mysql"), (10, "l_orderkey", "db2"), (10, None, "oracle")],
    )


_BEST = "(SELECT column_name FROM q WHERE n_groups > {n} ORDER BY group_stddev, ordinal LIMIT 1)"
SPLIT_CHOICE_SQL = inp.with_inputs(
    f"""SELECT CAST(2 AS INTEGER) AS readers, 'db2' AS vendor, CAST(NULL AS VARCHAR) AS primary_key, {_BEST.format(n=2)} AS split_column
        UNION ALL SELECT 10, 'mysql', NULL, {_BEST.format(n=10)}
        UNION ALL SELECT 60, 'mysql', NULL, {_BEST.format(n=60)}
        UNION ALL SELECT 10, 'db2', 'l_orderkey', 'l_orderkey'
        UNION ALL SELECT 10, 'oracle', NULL, NULL""",
    p=_PROFILED_SQL, q=_quality_sql(),
)


def split_choice_sketched(spark, sf):
    """The same choice where only columns that sketches cannot tell apart are profiled exactly."""
    return profile.sketched_choice(
        _profiled(spark, sf),
        [(2, None, "db2"), (10, None, "mysql"), (60, None, "mysql"), (10, "l_orderkey", "db2"), (10, None, "oracle")],
    )


def split_limited(spark, sf):
    """A profile in time, and the same one from the store where a later request has no time for its own."""
    lineitem, root = _profiled(spark, sf), scratch(spark, "profiles")
    first = limited.profiled(lineitem, "lineitem", root, dt.datetime(2016, 1, 1), seconds=3_600)
    later = limited.profiled(lineitem, "lineitem", root, dt.datetime(2016, 1, 2), seconds=0)
    return first.unionByName(later).drop("table_name")


def split_bands(spark, sf):
    """The exact profile beside the sketches' bands."""
    lineitem = _profiled(spark, sf)
    bands = profile.sketched_quality(lineitem, profile.splittable(lineitem)).drop("ordinal")
    return split_quality(spark, sf).join(bands, "column_name").select(
        "ordinal", "column_name", "n_groups", "group_stddev",
        F.col("n_groups").between(F.col("groups_low"), F.col("groups_high")).alias("groups_within"),
        F.col("group_stddev").between(F.col("stddev_low") - 1e-9, F.col("stddev_high") + 1e-9).alias("stddev_within"),
    )


def max_lengths(spark, sf):
    t = inp.tables(spark, sf)
    documents = t["documents"].withColumn("empty", F.nullif("lang", "lang"))
    return profile.max_lengths({"documents": documents, "part": t["part"]})


MAX_LENGTHS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(coalesce(max(length(CAST({c} AS VARCHAR))), 38) AS INTEGER) AS max_length FROM {t}"
    for t, columns in {
        "documents": "doc_id text lang source n_chars", "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    }.items()
    for c in columns.split()
) + " UNION ALL SELECT 'documents', 'empty', 38"


def table_stats(spark, sf):
    orders = inp.tables(spark, sf)["orders"]
    path, name = scratch(spark, "table_stats"), unique_name("clone")
    orders.write.parquet(path)
    publish.register_plain(spark, name, path)
    _, rows = publish.analyze(spark, name)
    publish.drop_table(spark, name)
    return spark.read.parquet(path).agg(F.count("*").alias("n_rows")).select(
        F.lit("orders").alias("table_name"), "n_rows", F.lit(rows).cast("bigint").alias("stats_rows")
    )


def _keys(dialect):
    """Index columns of the catalog's tables: the last three columns, in reverse."""
    return f"SELECT table_name, 'ix_' || table_name AS index_name, column_name, CAST(9 - ordinal AS INT) AS position FROM ({inp.catalog(dialect)}) c WHERE ordinal >= 6"


def _indexes(dialect):
    return f"""SELECT table_name, 'ix_' || table_name AS index_name, {inp.pick("k", ["P", "U", "P", "D"])} AS index_kind
               FROM (SELECT table_name, k // 8 AS k FROM ({inp.catalog(dialect)}) c WHERE ordinal = 1) x""".replace(
        "k // 8", inp.div("k", 8, dialect)
    )


def _cardinalities(dialect):
    return f"""SELECT table_name, ordinal, column_name, data_type, nullable, char_length % 10 AS cardinality
               FROM (SELECT table_name, ordinal, column_name, data_type, CASE WHEN k % 3 = 0 THEN 'Y' ELSE 'N' END AS nullable,
                            char_length FROM ({inp.catalog(dialect)}) c WHERE vendor = 'db2') x"""


def split_primary_key(spark, sf):
    keyed = profile.first_key_column(
        inp.derive(spark, sf, _indexes(SPARK)), inp.derive(spark, sf, _keys(SPARK))
    ).withColumn("rule", F.lit("key"))
    distinct = profile.most_distinct_column(inp.derive(spark, sf, _cardinalities(SPARK)))
    return keyed.unionByName(distinct.withColumn("rule", F.lit("cardinality")))


SPLIT_PK_SQL = inp.with_inputs(
    """SELECT table_name, split_column, 'key' AS rule FROM (
         SELECT i.table_name, k.column_name AS split_column, row_number() OVER (PARTITION BY i.table_name ORDER BY position, i.index_name) AS n
         FROM i JOIN k ON i.table_name = k.table_name AND i.index_name = k.index_name WHERE index_kind = 'P') a WHERE n = 1
       UNION ALL SELECT table_name, split_column, 'cardinality' FROM (
         SELECT table_name, column_name AS split_column, row_number() OVER (PARTITION BY table_name ORDER BY cardinality DESC, ordinal) AS n
         FROM d WHERE nullable = 'N' AND upper(data_type) IN ('CHAR','INTEGER','BIGINT','LONGVAR','SMALLINT','ROWID','VARCHAR')) b WHERE n = 1""",
    i=_indexes(DUCK), k=_keys(DUCK), d=_cardinalities(DUCK),
)


def _td_indices(dialect):
    return f"""SELECT table_name, column_name, {inp.pick("k + char_length", ["P", "Q", "S", "K", "J", "N", "J", "J", "J"])} AS index_type,
                      CAST(k % 3 + 1 AS INT) AS index_number
               FROM ({inp.catalog(dialect)}) c WHERE vendor = 'teradata' AND ordinal <= 3"""


def _td_ints(dialect):
    return f"""SELECT table_name, ordinal, column_name, data_type FROM ({inp.catalog(dialect)}) c
               WHERE vendor = 'teradata' AND data_type IN ('I', 'I8')"""


def split_index_rank(spark, sf):
    return profile.best_index_column(
        inp.derive(spark, sf, _td_indices(SPARK)), inp.derive(spark, sf, _td_ints(SPARK))
    )


SPLIT_RANK_SQL = inp.with_inputs(
    """SELECT table_name, index_rank, CASE WHEN index_rank < 7 THEN column_name ELSE coalesce(int_column, 'no-split') END AS split_column
       FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY index_rank, column_name) AS n
             FROM (SELECT *, CAST(CASE WHEN index_type = 'Q' AND index_number = 1 THEN 1 WHEN index_type = 'P' AND index_number = 1 THEN 2
                               WHEN index_type = 'Q' AND index_number = 2 THEN 3 WHEN index_type = 'P' AND index_number = 2 THEN 4
                               WHEN index_type = 'K' THEN 5 WHEN index_type = 'S' THEN 6 ELSE 7 END AS INTEGER) AS index_rank FROM i) r) b
       LEFT JOIN (SELECT table_name, arg_min(column_name, ordinal) AS int_column FROM t GROUP BY 1) f USING (table_name)
       WHERE n = 1""",
    i=_td_indices(DUCK), t=_td_ints(DUCK),
)


def split_first_int(spark, sf):
    """First column of each integer type (ranked by type), and first integer of each table (by dictionary joins)."""
    by_type = profile.first_of_type(inp.derive(spark, sf, _td_ints(SPARK)), ["table_name", "data_type"])
    rows = inp.derive(spark, sf, inp.catalog(SPARK)).where(F.col("vendor").isin("sqlserver", "mysql"))
    columns = rows.select(F.md5("table_name").alias("object_id"), F.col("ordinal").alias("column_id"), "column_name", F.md5("data_type").alias("type_id"))
    kinds = rows.select(F.md5("data_type").alias("type_id"), F.col("data_type").alias("type_name")).distinct()
    tables = rows.where("ordinal = 1").select(F.md5("table_name").alias("object_id"), "table_name")
    first = profile.first_integer(columns, kinds, tables)
    return by_type.select("table_name", "data_type", "ordinal", F.col("column_name").alias("split_column")).unionByName(
        first.select("table_name", F.lit("any integer").alias("data_type"), F.col("column_id").alias("ordinal"), "split_column")
    )


SPLIT_INT_SQL = inp.with_inputs(
    """SELECT table_name, data_type, ordinal, column_name AS split_column FROM (
         SELECT *, rank() OVER (PARTITION BY table_name, data_type ORDER BY ordinal) AS rnk FROM t) r WHERE rnk = 1
       UNION ALL SELECT table_name, 'any integer', ordinal, column_name FROM (
         SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY ordinal) AS n FROM c
         WHERE vendor IN ('sqlserver', 'mysql') AND data_type LIKE '%int%') x WHERE n = 1""",
    t=_td_ints(DUCK), c=inp.catalog(DUCK),
)

_DB2_INTS = ("INTEGER", "SMALLINT", "BIGINT")


def split_rules(spark, sf):
    """All rules of two vendors' chains: DB2 by cardinality, then integers; MySQL by key, then integers."""
    rows = inp.derive(spark, sf, inp.catalog(SPARK))
    keys = inp.derive(spark, sf, _keys(SPARK))
    db2 = rows.where("vendor = 'db2'")
    db2_chain = profile.by_rules(
        db2.where("ordinal = 1"),
        [
            profile.most_distinct_column(inp.derive(spark, sf, _cardinalities(SPARK)).where("cardinality > 6")),
            profile.unique_or_first_integer(db2.where(F.col("data_type").isin(*_DB2_INTS)), keys),
        ],
    )
    mysql = rows.where("vendor = 'mysql'")
    primary = profile.first_key_column(inp.derive(spark, sf, _indexes(SPARK)).where("table_name LIKE '%1'"), keys)
    ints = profile.first_of_type(mysql.where("data_type LIKE '%int%'"), ["table_name"])
    mysql_chain = profile.by_rules(
        mysql.where("ordinal = 1"), [primary, ints.withColumnRenamed("column_name", "split_column")]
    )
    return db2_chain.unionByName(mysql_chain)


SPLIT_RULES_SQL = inp.with_inputs(
    """SELECT table_name, coalesce(a.n, b.n, 'no-split') AS split_column,
              CAST(CASE WHEN a.n IS NOT NULL THEN 1 WHEN b.n IS NOT NULL THEN 2 ELSE 0 END AS INTEGER) AS rule
       FROM (SELECT DISTINCT table_name FROM c WHERE vendor = 'db2') t
       LEFT JOIN (SELECT DISTINCT ON (table_name) table_name, column_name AS n FROM d
                  WHERE cardinality > 6 AND nullable = 'N' AND upper(data_type) IN ('CHAR','INTEGER','BIGINT','LONGVAR','SMALLINT','ROWID','VARCHAR')
                  ORDER BY table_name, cardinality DESC, ordinal) a USING (table_name)
       LEFT JOIN (SELECT DISTINCT ON (c.table_name) c.table_name, c.column_name AS n FROM c
                  LEFT JOIN k ON k.table_name = c.table_name AND k.column_name = c.column_name
                  WHERE vendor = 'db2' AND data_type IN ('INTEGER', 'SMALLINT', 'BIGINT')
                  ORDER BY c.table_name, k.column_name IS NULL, c.ordinal) b USING (table_name)
       UNION ALL
       SELECT table_name, coalesce(p.n, i.n, 'no-split'),
              CAST(CASE WHEN p.n IS NOT NULL THEN 1 WHEN i.n IS NOT NULL THEN 2 ELSE 0 END AS INTEGER)
       FROM (SELECT DISTINCT table_name FROM c WHERE vendor = 'mysql') t
       LEFT JOIN (SELECT DISTINCT ON (x.table_name) x.table_name, k.column_name AS n FROM x JOIN k USING (table_name, index_name)
                  WHERE index_kind = 'P' AND x.table_name LIKE '%1' ORDER BY x.table_name, position) p USING (table_name)
       LEFT JOIN (SELECT DISTINCT ON (table_name) table_name, column_name AS n FROM c
                  WHERE vendor = 'mysql' AND data_type LIKE '%int%' ORDER BY table_name, ordinal) i USING (table_name)""",
    c=inp.catalog(DUCK), d=_cardinalities(DUCK), k=_keys(DUCK), x=_indexes(DUCK),
)

KEYS = {
    "clean_names": (clean_names, CLEAN_NAMES_SQL),
    "lake_schema": (lake_schema, LAKE_SCHEMA_SQL),
    "load_class": (load_class, inp.with_inputs(f"SELECT k, est_rows, {LOAD_SQL} AS load FROM s", s=_sized_tables(DUCK))),
    "max_lengths": (max_lengths, MAX_LENGTHS_SQL),
    "measured_precision": (measured_precision, MEASURED_SQL),
    "parse_vendor_date": (parse_vendor_date, PARSE_DATE_SQL),
    "reader_parallelism": (reader_parallelism, READERS_SQL),
    "row_count": (row_count, ROW_COUNT_SQL),
    "split_bands": (
        split_bands,
        inp.with_inputs("SELECT *, true AS groups_within, true AS stddev_within FROM q", p=_PROFILED_SQL, q=_quality_sql()),
    ),
    "split_choice": (split_choice, SPLIT_CHOICE_SQL),
    "split_choice_sketched": (split_choice_sketched, SPLIT_CHOICE_SQL),
    "split_first_int": (split_first_int, SPLIT_INT_SQL),
    "split_index_rank": (split_index_rank, SPLIT_RANK_SQL),
    "split_primary_key": (split_primary_key, SPLIT_PK_SQL),
    "split_limited": (
        split_limited,
        inp.with_inputs(
            "SELECT q.*, '2016-01-01 00:00:00' AS profiled_at, unnest([true, false]) AS fresh FROM q",
            p=_PROFILED_SQL, q=_quality_sql(),
        ),
    ),
    "split_quality": (split_quality, SPLIT_QUALITY_SQL),
    "split_rules": (split_rules, SPLIT_RULES_SQL),
    "table_stats": (table_stats, "SELECT 'orders' AS table_name, count(*) AS n_rows, count(*) AS stats_rows FROM orders"),
    "typed_projection": (typed_projection, TYPED_SQL),
}
