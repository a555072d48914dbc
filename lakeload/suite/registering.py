"""Queries for the registry and for custom steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes
from ..operators import merge, registry
from ..plans import steps
from . import inputs as inp
from .inputs import DUCK, SPARK

_SHOWN = ["source_database_name", "source_table_name", "db_env", "load", "hold", "views"]
_SHOWN_SQL = ", ".join(_SHOWN)
_BITS = inp.values([(n, b) for n, b in codes.FREQUENCY_BITS.items()], "freq, bits")
_WEIGHTS = inp.values([(n, b) for n, b in codes.WEIGHT_BITS.items()], "weight, bits")


def _registry(spark, sf):
    return inp.derive(spark, sf, inp.registry(SPARK)).drop("k")


def registry_lookup(spark, sf):
    rows = _registry(spark, sf)
    by_domain = registry.lookup(rows, domain="finance", hold=0).withColumn("asked", F.lit("domain"))
    ungrouped = registry.lookup(rows, automation_group=None).withColumn("asked", F.lit("no group"))
    return by_domain.unionByName(ungrouped).select("asked", *_SHOWN)


LOOKUP_SQL = inp.with_inputs(
    f"""SELECT 'domain' AS asked, {_SHOWN_SQL} FROM r WHERE domain = 'finance' AND hold = 0
        UNION ALL SELECT 'no group', {_SHOWN_SQL} FROM r WHERE automation_group IS NULL""",
    r=inp.registry(DUCK),
)


def registry_by_schedule(spark, sf):
    return registry.by_schedule(_registry(spark, sf), "weekly").select(*_SHOWN)


def _requests(dialect):
    """Requests for tables from orders; some tables are not registered and some leave out the env."""
    shift = "CASE WHEN o_orderkey % 31 = 0 THEN 100000000 ELSE 0 END"
    return f"""
      SELECT o_orderkey AS request_id, 'db' || c_nationkey AS source_database_name,
             'tbl_' || (o_custkey + {shift}) AS source_table_name,
             CASE WHEN o_custkey % 4 = 0 THEN '' WHEN o_custkey % 4 = 3 THEN NULL
                  ELSE {inp.pick("o_custkey", ["dev", "int", "prod", "dev"])} END AS db_env
      FROM orders JOIN customer ON c_custkey = o_custkey"""


def request_status(spark, sf):
    return registry.request_status(inp.derive(spark, sf, _requests(SPARK)), _registry(spark, sf))


STATUS_SQL = inp.with_inputs(
    """SELECT q.request_id, q.source_database_name, q.source_table_name, q.env AS db_env,
              CASE WHEN r.hold IS NULL THEN 'missing' WHEN r.hold = 0 THEN 'available' ELSE 'hold' END AS status
       FROM (SELECT *, coalesce(nullif(db_env, ''), 'dev') AS env FROM q0) q
       LEFT JOIN r ON r.source_database_name = q.source_database_name AND r.source_table_name = q.source_table_name AND r.db_env = q.env""",
    q0=_requests(DUCK), r=inp.registry(DUCK),
)


def _asked(dialect):
    """Changes asked for registered tables, with fields left empty and fields to be cleared."""
    return f"""
      SELECT 'db' || c_nationkey AS source_database_name, 'tbl_' || c_custkey AS source_table_name,
             {inp.pick("c_custkey", ["dev", "int", "prod", "dev"])} AS db_env,
             {inp.pick("c_custkey", ["", "hr", "null"])} AS domain,
             CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '' || (c_custkey % 9) END AS mappers,
             {inp.pick("c_custkey", ["updated_at", "null", "", "seen_at"])} AS check_column,
             {inp.pick("c_custkey", ["", None, "team_a|sales", "null"])} AS views
      FROM customer WHERE c_custkey % 6 <> 5"""


_DIFF_COLUMNS = ["domain", "mappers", "check_column", "views"]


def registry_diff(spark, sf):
    return registry.diff(_registry(spark, sf), inp.derive(spark, sf, _asked(SPARK)), _DIFF_COLUMNS)


DIFF_SQL = inp.with_inputs(
    " UNION ALL ".join(
        f"""SELECT source_database_name, source_table_name, db_env, '{c}' AS column_name,
                   coalesce(CAST(r.{c} AS VARCHAR), '') AS old_value, CASE WHEN a.{c} = 'null' THEN '' ELSE a.{c} END AS new_value
            FROM a JOIN r USING (source_database_name, source_table_name, db_env)
            WHERE coalesce(a.{c}, '') <> '' AND (a.{c} <> coalesce(CAST(r.{c} AS VARCHAR), '') OR a.{c} = 'null')"""
        for c in _DIFF_COLUMNS
    ),
    a=_asked(DUCK), r=inp.registry(DUCK),
)


def _fresh_requests(dialect):
    return f"""
      SELECT 'db' || c_nationkey AS source_database_name, 'tbl_' || c_custkey AS source_table_name,
             {inp.pick("c_custkey", ["dev", "int", "prod"])} AS db_env,
             {inp.pick("c_custkey", ["", "sales", None, "int_sales", "prod_hr"])} AS domain,
             {inp.pick("c_custkey", [*codes.FREQUENCY_BITS, ""])} AS refresh_frequency,
             {inp.pick("c_custkey", [*codes.WEIGHT_BITS, None])} AS weight,
             {inp.pick("c_custkey", ["a|b", None, "b|c|a", "d"])} AS views,
             {inp.pick("c_custkey", ["b|x", "a", "", "a|c|a", "c|d"])} AS new_views,
             CAST(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 20 END AS INT) AS mappers,
             CAST(CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 1000 END AS INT) AS fetch_size
      FROM customer"""


_NORMAL = ["source_database_name", "source_table_name", "db_env", "domain", "load", "views", "mappers", "fetch_size"]


def registry_normalise(spark, sf):
    return registry.normalise(inp.derive(spark, sf, _fresh_requests(SPARK))).select(*_NORMAL)


NORMALISE_SQL = inp.with_inputs(
    """SELECT source_database_name, source_table_name, db_env,
              CASE WHEN db_env = 'dev' OR contains(plain, db_env || '_') THEN plain ELSE db_env || '_' || plain END AS domain,
              coalesce(b.bits, '000') || coalesce(w.bits, '001') AS load,
              CASE WHEN new_views = '' THEN '' ELSE merged END AS views,
              coalesce(mappers, 10) AS mappers, coalesce(fetch_size, 50000) AS fetch_size
       FROM (SELECT *, coalesce(nullif(domain, ''), source_database_name || '_i') AS plain,
                    array_to_string([v FOR v, i IN al IF list_position(al, v) = i], '|') AS merged
             FROM (SELECT *, list_filter(list_concat(string_split(coalesce(views, ''), '|'), string_split(new_views, '|')), lambda v: v <> '') AS al
                   FROM q) a) x
       LEFT JOIN b ON b.freq = refresh_frequency LEFT JOIN w USING (weight)""",
    q=_fresh_requests(DUCK), b=_BITS, w=_WEIGHTS,
)


def registry_domains(spark, sf):
    rows = _registry(spark, sf)
    found = registry.domains(rows).select(F.lit("domain").alias("kind"), F.col("domain").alias("value"))
    parts = registry.id_parts(rows).select(F.lit("id part").alias("kind"), F.col("id_part").alias("value"))
    return found.unionByName(parts)


DOMAINS_SQL = inp.with_inputs(
    """SELECT DISTINCT 'domain' AS kind, domain AS value FROM r WHERE domain IS NOT NULL
       UNION ALL SELECT DISTINCT 'id part', substr(automation_appl_id, length(automation_appl_id) - 3, 3) FROM r""",
    r=inp.registry(DUCK),
)


def registry_dump(spark, sf):
    return registry.dump(_registry(spark, sf), "oracle")


_DUMP_FIELDS = " || chr(10) || ".join(
    f"'{c}:' || coalesce(CAST({c} AS VARCHAR), '')" for c in registry.DUMP_LINES
)
DUMP_SQL = inp.with_inputs(
    f"SELECT '[Request]' || chr(10) || {_DUMP_FIELDS} AS section FROM (SELECT r.*, b.freq AS refresh_frequency, w.weight "
    "FROM r JOIN b ON b.bits = substr(load, 1, 3) JOIN w ON w.bits = substr(load, 4, 3)) x WHERE lower(jdbcurl) LIKE '%oracle%'",
    r=inp.registry(DUCK), b=_BITS, w=_WEIGHTS,
)


def registry_groups(spark, sf):
    return registry.groups(_registry(spark, sf))


GROUPS_SQL = inp.with_inputs(
    """SELECT 'vendor' AS group_kind, split_part(jdbcurl, ':', 2) AS group_value, full_table_name FROM r
       UNION ALL SELECT 'domain', domain, full_table_name FROM r
       UNION ALL SELECT 'database', source_database_name, full_table_name FROM r
       UNION ALL SELECT 'schedule', b.freq, full_table_name FROM r JOIN b ON b.bits = substr(load, 1, 3)""",
    r=inp.registry(DUCK), b=_BITS,
)


def _new_rows(dialect):
    """Rows to register: every third table under its own key, and new tables kept on hold."""
    base = inp.registry(dialect)
    load = "'101001' AS load"
    return f"""
      SELECT source_database_name, source_table_name, db_env, {load}, CAST(0 AS INT) AS hold, 'fresh' AS views FROM ({base}) a WHERE k % 3 = 0
      UNION ALL SELECT source_database_name, source_table_name || '_new', db_env, {load}, CAST(1 AS INT), '' FROM ({base}) b WHERE k % 7 = 0"""


def _current(spark, sf):
    return _registry(spark, sf).select(*_SHOWN)


def registry_insert(spark, sf):
    return merge.insert_absent(_current(spark, sf), inp.derive(spark, sf, _new_rows(SPARK)), registry.KEYS)


def registry_update(spark, sf):
    return merge.replace_present(_current(spark, sf), inp.derive(spark, sf, _new_rows(SPARK)), registry.KEYS)


_KEY = "source_database_name, source_table_name, db_env"
INSERT_SQL = inp.with_inputs(
    f"SELECT {_SHOWN_SQL} FROM r UNION ALL SELECT {_SHOWN_SQL} FROM n WHERE ({_KEY}) NOT IN (SELECT ({_KEY}) FROM r)",
    r=inp.registry(DUCK), n=_new_rows(DUCK),
)
UPDATE_SQL = inp.with_inputs(
    f"""SELECT {_KEY}, coalesce(n.load, r.load) AS load, coalesce(n.hold, r.hold) AS hold,
               CASE WHEN n.load IS NULL THEN r.views ELSE n.views END AS views
        FROM r LEFT JOIN n USING ({_KEY})""",
    r=inp.registry(DUCK), n=_new_rows(DUCK),
)


def registry_drop(spark, sf):
    gone = inp.derive(spark, sf, _new_rows(SPARK)).where("hold = 0")
    return registry.remove(_current(spark, sf), gone)


def registry_placeholder(spark, sf):
    """Tables asked for but not registered, put on hold until somebody fills them in."""
    asked = registry.request_status(inp.derive(spark, sf, _requests(SPARK)), _registry(spark, sf))
    missing = asked.where("status = 'missing'").select(*registry.KEYS).distinct()
    return registry.placeholders(missing).select(*registry.KEYS, "hold", "load", "mappers", "fetch_size", "domain")


PLACEHOLDER_SQL = f"""
SELECT DISTINCT source_database_name, source_table_name, db_env, CAST(1 AS INTEGER) AS hold, '000001' AS load,
       CAST(10 AS INTEGER) AS mappers, CAST(50000 AS INTEGER) AS fetch_size, CAST(NULL AS VARCHAR) AS domain
FROM ({STATUS_SQL}) s WHERE status = 'missing'
"""


def custom_sql_steps(spark, sf):
    """Two SQL steps around one written as a function."""
    t = inp.tables(spark, sf)
    return steps.run_steps(
        spark,
        {"orders": t["orders"], "customer": t["customer"]},
        [
            ("recent", "SELECT o_custkey, o_orderkey FROM {orders} WHERE o_orderdate >= '1998-01-01'"),
            ("counted", lambda known: known["recent"].groupBy("o_custkey").agg(F.count("*").alias("n_orders"))),
            (
                "segments",
                "SELECT c_mktsegment, count(*) AS n_customers, sum(n_orders) AS n_orders "
                "FROM {counted} JOIN {customer} ON c_custkey = o_custkey GROUP BY c_mktsegment",
            ),
        ],
    )


STEPS_SQL = """
SELECT c_mktsegment, count(*) AS n_customers, CAST(sum(n) AS BIGINT) AS n_orders
FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= '1998-01-01' GROUP BY 1) x
JOIN customer ON c_custkey = o_custkey GROUP BY 1
"""

KEYS = {
    "custom_sql_steps": (custom_sql_steps, STEPS_SQL),
    "registry_by_schedule": (
        registry_by_schedule, inp.with_inputs(f"SELECT {_SHOWN_SQL} FROM r WHERE load LIKE '100%'", r=inp.registry(DUCK))
    ),
    "registry_diff": (registry_diff, DIFF_SQL),
    "registry_domains": (registry_domains, DOMAINS_SQL),
    "registry_drop": (
        registry_drop,
        inp.with_inputs(
            f"SELECT {_SHOWN_SQL} FROM r WHERE ({_KEY}) NOT IN (SELECT ({_KEY}) FROM n WHERE hold = 0)",
            r=inp.registry(DUCK), n=_new_rows(DUCK),
        ),
    ),
    "registry_dump": (registry_dump, DUMP_SQL),
    "registry_groups": (registry_groups, GROUPS_SQL),
    "registry_insert": (registry_insert, INSERT_SQL),
    "registry_lookup": (registry_lookup, LOOKUP_SQL),
    "registry_normalise": (registry_normalise, NORMALISE_SQL),
    "registry_placeholder": (registry_placeholder, PLACEHOLDER_SQL),
    "registry_update": (registry_update, UPDATE_SQL),
    "request_status": (request_status, STATUS_SQL),
}
