"""Queries for staging, publishing, views and team copies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import project, teams
from ..plans import chains, loads
from ..plans.steps import unique_name
from ..session import scratch
from ..sinks import publish, views
from ..sources import files
from . import inputs as inp
from .inputs import DUCK, SPARK
from .quality import _conforms_sql
from .typing import LINEITEM_FIELDS, _TYPED_COLUMNS

AT = dt.datetime(2016, 1, 1, 16, 47, 56)
STAMP, INGEST_TIME = "full_20160101164756", "2016-01-01 16:47:56"


def stage_partition(spark, sf):
    """Decimals are shown as text, so their scale is compared as well."""
    typed = project.typed(inp.derive(spark, sf, inp.lineitem_text(SPARK)), LINEITEM_FIELDS, "db2")
    stamped = project.with_system_columns(typed, INGEST_TIME, project.load_stamp(AT, full=True))
    staged = publish.write_stage(stamped, scratch(spark, "stage"))
    return staged.withColumns(
        {c: F.col(c).cast("string") for c in ("l_quantity", "l_extendedprice", "l_discount")}
    ).withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


STAGE_SQL = inp.with_inputs(
    f"SELECT {_TYPED_COLUMNS}, '{INGEST_TIME}' AS ingest_timestamp, '{STAMP}' AS incr_ingest_timestamp FROM t",
    t=inp.lineitem_text(DUCK),
)


def load_report(spark, sf):
    """The flagship: lineitem from text to a typed stage partition, and a verdict on every column."""
    landing = files.land(inp.derive(spark, sf, inp.lineitem_text(SPARK)), scratch(spark, "report_landing"))
    typed = project.typed(landing, LINEITEM_FIELDS, "db2")
    stamped = project.with_system_columns(typed, INGEST_TIME, project.load_stamp(AT, full=True))
    staged = publish.write_stage(stamped, scratch(spark, "report"))
    return loads.load_report(landing, staged, LINEITEM_FIELDS, "db2")


ORDER_FIELDS = [
    project.Field("o_orderkey", "BIGINT"), project.Field("o_custkey", "BIGINT"), project.Field("o_orderstatus", "VARCHAR", 1),
    project.Field("o_totalprice", "DOUBLE"), project.Field("o_orderdate", "DATETIME"), project.Field("o_orderpriority", "VARCHAR", 15),
]


def ingest_chain(spark, sf):
    """A full load of the lower half of orders and an increment of the rest, with checks and audit."""
    orders = inp.tables(spark, sf)["orders"]
    half = orders.agg(F.max("o_orderkey")).first()[0] // 2
    root = scratch(spark, "chain")
    table = chains.Table(
        "mysql", "sales", "orders", ORDER_FIELDS, loads.Folders(f"{root}/orders"), f"{root}/audit",
        sample_id="o_orderkey", check_column="o_orderkey",
    )
    chains.ingest_full(orders.where(F.col("o_orderkey") <= half), table, AT)
    chains.ingest_increment(orders, table, LATER)
    return publish.read_partitioned(spark, table.folders.live, spark.read.parquet(table.folders.live).schema)


_LAKE = dict(zip([f.name for f in LINEITEM_FIELDS], project.lake_types(LINEITEM_FIELDS, "db2")))
REPORT_SQL = inp.with_inputs(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS lake_type, count(*) AS source_rows, count(*) AS target_rows, true AS count_ok, "
        f"count({c}) - count(x_{c}) AS lost, count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({_conforms_sql(c, t)})) AS unfit FROM y"
        for c, t in _LAKE.items()
    ),
    t=inp.lineitem_text(DUCK),
    y="SELECT *, " + ", ".join(
        f"{c} AS x_{c}" if t.startswith(("VARCHAR", "CHAR")) else f"TRY_CAST({c} AS {t.replace('INT', 'INTEGER') if t == 'INT' else t}) AS x_{c}"
        for c, t in _LAKE.items()
    ) + " FROM t",
)


def _staged_orders(spark, sf, folder, where="true", at=AT, full=True):
    orders = inp.tables(spark, sf)["orders"].where(where)
    stamped = project.with_system_columns(orders, at.strftime("%Y-%m-%d %H:%M:%S"), project.load_stamp(at, full))
    return publish.write_stage(stamped, folder)


def _swapped(spark, sf, label):
    """A first load of the even orders, replaced by a second load of all."""
    root = scratch(spark, label)
    stage, live, backup = f"{root}/stage", f"{root}/live", f"{root}/backup"
    first = _staged_orders(spark, sf, stage, "o_orderkey % 2 = 0")
    publish.swap(spark, stage, live, backup)
    _staged_orders(spark, sf, stage)
    publish.swap(spark, stage, live, backup)
    return live, backup, first.schema


def publish_swap(spark, sf):
    live, _, schema = _swapped(spark, sf, "swap")
    return publish.read_partitioned(spark, live, schema)


def restore_backup(spark, sf):
    live, backup, schema = _swapped(spark, sf, "restore")
    publish.restore(spark, live, backup)
    return publish.read_partitioned(spark, live, schema)


def stamped_sql(where: str = "true", time: str = INGEST_TIME, stamp: str = STAMP) -> str:
    return f"SELECT *, '{time}' AS ingest_timestamp, '{stamp}' AS incr_ingest_timestamp FROM orders WHERE {where}"


LATER = dt.datetime(2016, 2, 1, 8, 0, 0)
BOTH_LOADS_SQL = (
    stamped_sql("o_orderkey % 2 = 0") + " UNION ALL "
    + stamped_sql("o_orderkey % 2 = 1", "2016-02-01 08:00:00", "20160201080000")
)


def _two_loads(spark, sf, label):
    """A live table of two loads: the even orders, then the odd ones."""
    live = scratch(spark, label)
    first = _staged_orders(spark, sf, live, "o_orderkey % 2 = 0")
    odd = inp.tables(spark, sf)["orders"].where("o_orderkey % 2 = 1")
    increment = project.with_system_columns(odd, LATER.strftime("%Y-%m-%d %H:%M:%S"), project.load_stamp(LATER, False))
    return publish.merge_partition(increment, live), live, first.schema


def live_table(spark, sf):
    _, live, schema = _two_loads(spark, sf, "live_table")
    return publish.register_live(spark, unique_name("live"), live, schema)


def _increment_beside(spark, sf, label):
    """A live table of the even orders, and the odd ones staged beside it as an increment."""
    root = scratch(spark, label)
    live, stage = f"{root}/live", f"{root}/stage"
    first = _staged_orders(spark, sf, live, "o_orderkey % 2 = 0")
    _staged_orders(spark, sf, stage, "o_orderkey % 2 = 1", LATER, full=False)
    return live, stage, first.schema, project.load_stamp(LATER, False)


def incr_move(spark, sf):
    """The increment becomes a partition of the live table by one rename."""
    live, stage, schema, stamp = _increment_beside(spark, sf, "incr_move")
    publish.move_partition(spark, stage, live, stamp)
    return publish.read_partitioned(spark, live, schema)


def incr_attach(spark, sf):
    """The increment stays where it was staged, and the table names that place as its partition."""
    live, stage, schema, stamp = _increment_beside(spark, sf, "incr_attach")
    table = unique_name("live")
    publish.register_live(spark, table, live, schema)
    publish.attach_partition(spark, table, stamp, f"{stage}/{publish.partition_folder(stamp)}")
    return spark.table(table)


def partition_sizes(spark, sf):
    _, live, _ = _two_loads(spark, sf, "sizes")
    sizes = publish.partition_sizes(spark, live)
    newest = publish.newest_partition_size(sizes).select(F.lit("newest").alias("scope"), "incr_ingest_timestamp", "n_bytes")
    return sizes.select(F.lit("partition").alias("scope"), "incr_ingest_timestamp", "n_bytes").unionByName(newest)


def partition_newest(spark, sf):
    """The newest load of a table, found by its label's time: an increment is newer than an older full load."""
    _, live, _ = _two_loads(spark, sf, "newest")
    newest = publish.newest_partition_size(publish.partition_sizes(spark, live))
    return newest.select("incr_ingest_timestamp", (F.col("n_bytes") > 0).alias("has_bytes"))


def view_over_live(spark, sf):
    _, live, schema = _two_loads(spark, sf, "view_over")
    table = unique_name("live")
    publish.register_live(spark, table, live, schema)
    return views.view_over(spark, unique_name("team_view"), table)


def filtered_view(spark, sf):
    inp.tables(spark, sf)
    table = unique_name("lineitem_live")
    publish.register_plain(spark, table, f"{sf}/lineitem.parquet")
    return views.filtered_view(
        spark, unique_name("returns"), table, ["l_orderkey", "l_linenumber", "l_quantity"],
        "l_returnflag = 'R' AND l_quantity > 30",
    )


def team_copy_full(spark, sf):
    rows, _, _ = _two_loads(spark, sf, "copy_source")
    return views.copy_full(rows, scratch(spark, "team_copy"))


def team_copy_incr(spark, sf):
    """The copy is made after the first load and brought up to date after the second."""
    rows, live, schema = _two_loads(spark, sf, "copy_source")
    copy = scratch(spark, "team_copy")
    views.copy_full(rows.where(F.col("incr_ingest_timestamp") == STAMP), copy)
    return views.copy_newer(rows, copy)


def team_copy_loads(spark, sf):
    """As ``team_copy_incr``, where only the loads that the copy lacks are read."""
    rows, live, schema = _two_loads(spark, sf, "copy_source")
    copy = scratch(spark, "team_copy")
    views.copy_full(rows.where(F.col("incr_ingest_timestamp") == STAMP), copy)
    return views.copy_new_loads(spark, live, copy, schema)


def team_members(spark, sf):
    return teams.members(inp.derive(spark, sf, inp.registry(SPARK)), "team_a").select("full_table_name", "views", "db_env")


TEAM_MEMBERS_SQL = inp.with_inputs(
    "SELECT full_table_name, views, db_env FROM r WHERE list_contains(string_split(views, '|'), 'team_a')",
    r=inp.registry(DUCK),
)

DOMAINS = ("sales", "risk", "hr")


def view_domain_split(spark, sf):
    return teams.copy_sources(inp.derive(spark, sf, inp.registry(SPARK)), DOMAINS)


VIEW_DOMAIN_SQL = inp.with_inputs(
    """SELECT full_table_name, source_domain, view_name FROM (
         SELECT full_table_name, CASE WHEN len(common) > 0 AND len(common) <> len(v) THEN common[1] END AS source_domain,
                unnest(v) AS view_name
         FROM (SELECT full_table_name, string_split(views, '|') AS v,
                      list_filter(string_split(views, '|'), lambda x: list_contains(['sales', 'risk', 'hr'], x)) AS common
               FROM r WHERE views IS NOT NULL) a) b
       WHERE source_domain IS NULL OR lower(view_name) <> source_domain""",
    r=inp.registry(DUCK),
)

AS_OF = dt.datetime(2016, 3, 1, 12, 0, 0)


def _rules(dialect):
    return f"""SELECT {inp.pick("c_custkey", ["none", "daily", "weekly", "biweekly", "fortnightly", "monthly", "quarterly", "yearly"])} AS frequency,
                      {inp.pick("c_custkey", ["yes", "Yes", "no"])} AS activate,
                      'team_' || (c_custkey % 5) AS view_name, 'dom.tbl_' || c_custkey AS full_table_name FROM customer"""


def _last_ingests(dialect):
    started = "TIMESTAMP_NTZ '2016-03-01 11:00:00'" if dialect == SPARK else "TIMESTAMP '2016-03-01 11:00:00'"
    return f"""SELECT 'team_' || (c_custkey % 5) AS view_name, 'dom.tbl_' || c_custkey AS full_table_name,
                      {inp.plus_seconds(started, "-(c_custkey % 120) * 86400 + c_custkey % 7200", dialect)} AS last_ingest
               FROM customer WHERE c_custkey % 17 <> 0"""


def team_refresh_due(spark, sf):
    return teams.refresh_due(inp.derive(spark, sf, _rules(SPARK)), inp.derive(spark, sf, _last_ingests(SPARK)), AS_OF)


REFRESH_SQL = inp.with_inputs(
    """SELECT view_name, full_table_name, frequency, age_days,
              coalesce(days <> 0 AND age_days >= days AND lower(activate) = 'yes', false) AS due
       FROM (SELECT r.*, CAST(floor(date_diff('second', last_ingest, TIMESTAMP '2016-03-01 12:00:00') / 86400) AS INTEGER) AS age_days,
                    CASE frequency WHEN 'none' THEN 0 WHEN 'daily' THEN 1 WHEN 'weekly' THEN 7 WHEN 'biweekly' THEN 14
                         WHEN 'fortnightly' THEN 15 WHEN 'monthly' THEN 30 WHEN 'quarterly' THEN 90 ELSE 364 END AS days
             FROM r LEFT JOIN i USING (view_name, full_table_name)) x""",
    r=_rules(DUCK), i=_last_ingests(DUCK),
)


def _rule_changes(dialect):
    return f"""SELECT {inp.pick("c_custkey", ["daily", None, "yearly"])} AS frequency,
                      {inp.pick("c_custkey", ["default", "no", None, None])} AS activate,
                      'team_' || (c_custkey % 5) AS view_name, 'dom.tbl_' || c_custkey AS full_table_name
               FROM customer WHERE c_custkey % 4 < 3
               UNION ALL SELECT 'weekly', 'default', 'team_new', 'dom.tbl_' || c_custkey FROM customer WHERE c_custkey % 50 = 0"""


def team_rule_upsert(spark, sf):
    return teams.upsert_rules(inp.derive(spark, sf, _rules(SPARK)), inp.derive(spark, sf, _rule_changes(SPARK)))


RULE_UPSERT_SQL = inp.with_inputs(
    """SELECT view_name, full_table_name, coalesce(c.frequency, r.frequency) AS frequency,
              CASE WHEN c.activate = 'default' THEN 'yes' ELSE coalesce(c.activate, r.activate) END AS activate
       FROM r FULL JOIN c USING (view_name, full_table_name)""",
    r=_rules(DUCK), c=_rule_changes(DUCK),
)

KEYS = {
    "filtered_view": (
        filtered_view,
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30",
    ),
    "incr_attach": (incr_attach, BOTH_LOADS_SQL),
    "incr_move": (incr_move, BOTH_LOADS_SQL),
    "ingest_chain": (
        ingest_chain,
        stamped_sql("o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders)") + " UNION ALL "
        + stamped_sql("o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)", "2016-02-01 08:00:00", "20160201080000"),
    ),
    "load_report": (load_report, REPORT_SQL),
    "live_table": (live_table, BOTH_LOADS_SQL),
    "partition_newest": (
        partition_newest,
        "SELECT max('20160201080000') AS incr_ingest_timestamp, count(*) > 0 AS has_bytes FROM orders WHERE o_orderkey % 2 = 1",
    ),
    "partition_sizes": (partition_sizes, None),
    "publish_swap": (publish_swap, stamped_sql()),
    "restore_backup": (restore_backup, stamped_sql("o_orderkey % 2 = 0")),
    "stage_partition": (stage_partition, STAGE_SQL),
    "team_copy_full": (team_copy_full, BOTH_LOADS_SQL),
    "team_copy_incr": (team_copy_incr, BOTH_LOADS_SQL),
    "team_copy_loads": (team_copy_loads, BOTH_LOADS_SQL),
    "team_members": (team_members, TEAM_MEMBERS_SQL),
    "team_refresh_due": (team_refresh_due, REFRESH_SQL),
    "team_rule_upsert": (team_rule_upsert, RULE_UPSERT_SQL),
    "view_domain_split": (view_domain_split, VIEW_DOMAIN_SQL),
    "view_over_live": (view_over_live, BOTH_LOADS_SQL),
}
