"""Queries for the run log and the audit table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes
from ..operators import audit, runlog
from ..session import scratch
from . import inputs as inp
from .inputs import DUCK, SPARK

_ACTION = """named_struct('id', CAST(action_id AS STRING), 'name', name, 'type', type, 'status', status,
  'startTime', start_text, 'endTime', end_text, 'conf', conf, 'stats', stats, 'externalId', CAST(NULL AS STRING))"""


def _exports(text: str) -> str:
    """The run log's actions as those of exports."""
    for old, new in (
        ("'import_prep'", "'export_prep'"), ("'import'", "'export'"), ("'avro_parquet'", "'parquet_text'"),
        ("target_dir", "source_dir"), ("HDFS_BYTES_WRITTEN", "HDFS_BYTES_READ"),
    ):
        text = text.replace(old, new)
    return text


def _runs(spark, sf, text=None):
    """Runs with their actions nested. A run is eight actions, so no list grows with the table."""
    actions = inp.derive(spark, sf, text or inp.run_actions(SPARK))
    listed = F.array_sort(F.collect_list(F.expr(_ACTION)))
    return actions.groupBy("run_id", "app").agg(listed.alias("actions")).select(
        F.col("run_id").cast("string").alias("id"), F.col("app").alias("appName"), F.lit("SUCCEEDED").alias("status"),
        F.lit(0).alias("run"), F.lit(None).cast("string").alias("startTime"), F.lit(None).cast("string").alias("endTime"),
        F.lit(None).cast("string").alias("parentId"), "actions",
    )


def _logged_runs(spark, sf):
    """The same runs, written as run-log files and read back."""
    path = scratch(spark, "runlog")
    _runs(spark, sf).write.json(path)
    return runlog.read_runs(spark, path)


def runlog_actions(spark, sf):
    actions = runlog.actions_by_table(_logged_runs(spark, sf))
    return actions.select(
        "run_id", "app", "table_name", F.col("id").alias("action_id"), "name", "type", "status",
        runlog.log_time(F.col("startTime")).alias("started"),
    )


_OF_TABLE = """
  SELECT a.*, p.raw_table AS table_name FROM a
  JOIN (SELECT DISTINCT run_id, raw_table FROM a WHERE name LIKE '%import\\_prep' ESCAPE '\\') p
    ON p.run_id = a.run_id AND contains(a.name, replace(p.raw_table, '-', ''))"""


def _runlog_sql(body: str) -> str:
    return inp.with_inputs(body, a=inp.run_actions(DUCK), b=_OF_TABLE)


ACTIONS_SQL = _runlog_sql(
    """SELECT CAST(run_id AS VARCHAR) AS run_id, app, table_name, CAST(action_id AS VARCHAR) AS action_id, name, type, status,
              date_trunc('second', started) AS started FROM b"""
)


def runlog_inout(spark, sf):
    actions = _logged_runs(spark, sf).select(F.col("id").alias("run_id"), F.inline("actions"))
    return runlog.in_out(actions)


INOUT_SQL = _runlog_sql(
    """SELECT CAST(run_id AS VARCHAR) AS run_id, CAST(action_id AS VARCHAR) AS action_id, records_in, records_out,
              records_in = records_out AS in_out_ok FROM a WHERE type = 'sqoop'"""
)


def audit_records(spark, sf):
    return runlog.table_records(runlog.actions_by_table(_runs(spark, sf)))


RECORDS_SQL = _runlog_sql(
    """SELECT CAST(run_id AS VARCHAR) AS run_id, table_name,
              arg_max('mdm/' || raw_table, o) FILTER (WHERE is_prep) AS directory,
              arg_max('dom' || (action_id % 3), o) FILTER (WHERE is_prep) AS domain,
              arg_max(CASE WHEN records_in = records_out THEN coalesce(records_in, -1) ELSE -1 END, o) FILTER (WHERE is_import) AS rows0,
              CASE WHEN rows0 = -1 THEN NULL ELSE rows0 END AS rows,
              CAST(arg_max(date_diff('second', s, e), o) FILTER (WHERE is_import) AS INTEGER) AS pull_time,
              arg_max(bytes_written, o) FILTER (WHERE is_import) AS avro_size,
              arg_max(start_text, o) FILTER (WHERE is_import) AS ingest_timestamp,
              CAST(coalesce(date_diff('second', max(s) FILTER (WHERE name = plain || '_avro_parquet'),
                                      max(e) FILTER (WHERE name = plain || '_parquet_live')), 0) AS INTEGER) AS parquet_time,
              CASE WHEN bool_and(status = 'OK') THEN '0' ELSE '2' END AS success
       FROM (SELECT *, date_trunc('second', started) AS s, date_trunc('second', ended) AS e, replace(table_name, '-', '') AS plain,
                    {'s': date_trunc('second', started), 'i': CAST(action_id AS VARCHAR)} AS o,
                    name LIKE '%import\\_prep' ESCAPE '\\' AS is_prep,
                    type = 'sqoop' AND status = 'OK' AS is_import FROM b) x
       GROUP BY run_id, table_name"""
)
RECORDS_SQL = f"SELECT * EXCLUDE (rows0) FROM ({RECORDS_SQL}) r"


def audit_records_export(spark, sf):
    runs = _runs(spark, sf, _exports(inp.run_actions(SPARK)))
    return runlog.table_records(runlog.actions_by_table(runs, runlog.EXPORT), runlog.EXPORT)


EXPORT_RECORDS_SQL = (
    _exports(RECORDS_SQL.replace("%import\\_prep", "%export\\_prep").replace("_avro_parquet'", "_parquet_text'"))
    .replace(" AS rows,", " AS row_count,").replace("pull_time", "push_time")
    .replace("AS avro_size", "AS txt_size").replace("AS ingest_timestamp", "AS export_timestamp")
)


def audit_success(spark, sf):
    actions = _runs(spark, sf).select(F.col("id").alias("run_id"), F.inline("actions"))
    return runlog.success_codes(actions)


SUCCESS_SQL = _runlog_sql(
    "SELECT CAST(run_id AS VARCHAR) AS run_id, CASE WHEN bool_and(status = 'OK') THEN '0' ELSE '2' END AS success FROM a GROUP BY run_id"
)


def run_latest_subjob(spark, sf):
    """Runs whose actions are sub-runs job_0, job_1, ...; the highest name is the newest."""
    subs = inp.derive(spark, sf, inp.run_actions(SPARK)).where("action_id % 3 <> 0")
    action = F.struct(
        F.col("action_id").cast("string").alias("id"), F.concat(F.lit("job_"), F.col("action_id") % 12).alias("name"),
        F.lit("sub-workflow").alias("type"), F.concat(F.lit("ext-"), F.col("action_id")).alias("externalId"),
    )
    runs = subs.groupBy("run_id").agg(F.collect_list(action).alias("actions")).withColumnRenamed("run_id", "id")
    return runlog.newest_sub_run(runs)


SUBJOB_SQL = _runlog_sql(
    """SELECT run_id, max('job_' || (action_id % 12)) AS sub_name, arg_max('ext-' || action_id, 'job_' || (action_id % 12)) AS external_id
       FROM a WHERE action_id % 3 <> 0 GROUP BY run_id"""
)


def _run_starts(dialect):
    return f"SELECT app, run_id, min(started) AS at FROM ({inp.run_actions(dialect)}) a GROUP BY app, run_id"


def _run_requests(dialect):
    """Start requests: for each event of five kinds of app, some before and some after the last run."""
    return f"SELECT 'wf_' || (event_id % 22) AS app, event_id AS request_id, ts AS at FROM events WHERE event_id % 5 <> 0"


def run_closest(spark, sf):
    return runlog.closest_runs(inp.derive(spark, sf, _run_requests(SPARK)), inp.derive(spark, sf, _run_starts(SPARK)))


CLOSEST_SQL = inp.with_inputs(
    """SELECT q.request_id, q.app, s.run_id, (epoch_us(s.at) - epoch_us(q.at)) // 1000000 AS gap_seconds
       FROM q ASOF LEFT JOIN s ON q.app = s.app AND s.at >= q.at""",
    q=_run_requests(DUCK), s=_run_starts(DUCK),
)


def run_step_gaps(spark, sf):
    steps = inp.derive(spark, sf, inp.run_actions(SPARK)).select(
        "app", F.col("action_id").alias("step_id"), F.col("started").alias("at"), "ended"
    )
    return runlog.step_gaps(steps, ["app"])


GAPS_SQL = _runlog_sql(
    """SELECT app, step_id, next_step_id, CAST(trunc((epoch_us(next_at) - epoch_us(ended)) / 1000000.0) AS BIGINT) AS gap_seconds
       FROM (SELECT app, action_id AS step_id, ended, lead(action_id) OVER w AS next_step_id, lead(started) OVER w AS next_at
             FROM a WINDOW w AS (PARTITION BY app ORDER BY started, action_id)) x"""
)

# the audit table ------------------------------------------------------------------------


def _changes(dialect):
    """New audit rows: of every fourth table, and of tables not audited before."""
    q = "`" if dialect == SPARK else '"'
    base = inp.audit(dialect)
    shown = f"""directory, pull_time, avro_size, '2016-02-01 00:00:00' AS ingest_timestamp, parquet_time, parquet_size,
      {q}rows{q} + 1 AS {q}rows{q}, lifespan, ack, cleaned, current_repull, automation_appl_id, domain"""
    return f"""SELECT {shown}, {q}table{q} FROM ({base}) a WHERE pull_time % 4 = 0
               UNION ALL SELECT {shown}, {q}table{q} || '_new' AS {q}table{q} FROM ({base}) b WHERE pull_time % 10 = 1"""


def _audit(spark, sf):
    return inp.derive(spark, sf, inp.audit(SPARK))


def audit_upsert(spark, sf):
    return audit.replace_rows(_audit(spark, sf), inp.derive(spark, sf, _changes(SPARK)))


UPSERT_SQL = inp.with_inputs(
    """SELECT * FROM cur WHERE (domain, "table") NOT IN (SELECT (domain, "table") FROM chg) UNION ALL BY NAME SELECT * FROM chg""",
    cur=inp.audit(DUCK), chg=_changes(DUCK),
)


def audit_history(spark, sf):
    current = _audit(spark, sf)
    history = current.where("cleaned = 0 AND pull_time % 50 = 0").withColumn("archived_at", F.lit("2016-01-15 00:00:00"))
    return audit.to_history(history, current, inp.derive(spark, sf, _changes(SPARK)), "2016-02-01 00:00:00")


HISTORY_SQL = inp.with_inputs(
    """SELECT *, '2016-01-15 00:00:00' AS archived_at FROM cur WHERE cleaned = 0 AND pull_time % 50 = 0
       UNION ALL BY NAME SELECT *, '2016-02-01 00:00:00' AS archived_at FROM cur
       WHERE (domain, "table") IN (SELECT (domain, "table") FROM chg)""",
    cur=inp.audit(DUCK), chg=_changes(DUCK),
)


def audit_in_progress(spark, sf):
    starting = _audit(spark, sf).where("pull_time % 6 = 0").select("domain", "table")
    return audit.replace_rows(_audit(spark, sf), audit.in_progress(starting, "2016-02-02 00:00:00"))


IN_PROGRESS_SQL = inp.with_inputs(
    """SELECT * FROM cur WHERE pull_time % 6 <> 0 UNION ALL BY NAME
       SELECT domain, "table", '2016-02-02 00:00:00' AS ingest_timestamp, CAST(1 AS INTEGER) AS current_repull FROM cur WHERE pull_time % 6 = 0""",
    cur=inp.audit(DUCK),
)


def _audit_log(dialect):
    q = "`" if dialect == SPARK else '"'
    return f"""SELECT 'dom' || (user_id % 3) AS domain, 'tab_' || user_id AS {q}table{q},
                      {inp.time_text("ts", dialect, True)} AS ingest_timestamp,
                      CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS {q}rows{q} FROM events"""


def audit_last_rows(spark, sf):
    return audit.last_rows(inp.derive(spark, sf, _audit_log(SPARK)))


LAST_ROWS_SQL = inp.with_inputs(
    """SELECT domain, "table", ingest_timestamp, coalesce(rows, 0) AS rows FROM (
         SELECT *, row_number() OVER (PARTITION BY domain, "table" ORDER BY ingest_timestamp DESC) AS n FROM l) x WHERE n = 1""",
    l=_audit_log(DUCK),
)


def audit_lifespan(spark, sf):
    return audit.with_lifespan(_audit(spark, sf), inp.derive(spark, sf, inp.registry(SPARK)))


LIFESPAN_SQL = inp.with_inputs(
    """SELECT cur.* REPLACE (coalesce(f.freq, lifespan) AS lifespan) FROM cur
       LEFT JOIN (SELECT domain, source_table_name, b.freq FROM r JOIN b ON b.bits = substr(load, 1, 3)) f
         ON f.domain = cur.domain AND f.source_table_name = cur."table" """,
    cur=inp.audit(DUCK), r=inp.registry(DUCK), b=inp.values(list(codes.FREQUENCY_BITS.items()), "freq, bits"),
)

KEYS = {
    "audit_history": (audit_history, HISTORY_SQL),
    "audit_in_progress": (audit_in_progress, IN_PROGRESS_SQL),
    "audit_last_rows": (audit_last_rows, LAST_ROWS_SQL),
    "audit_lifespan": (audit_lifespan, LIFESPAN_SQL),
    "audit_records": (audit_records, RECORDS_SQL),
    "audit_records_export": (audit_records_export, EXPORT_RECORDS_SQL),
    "audit_success": (audit_success, SUCCESS_SQL),
    "audit_upsert": (audit_upsert, UPSERT_SQL),
    "run_closest": (run_closest, CLOSEST_SQL),
    "run_latest_subjob": (run_latest_subjob, SUBJOB_SQL),
    "run_step_gaps": (run_step_gaps, GAPS_SQL),
    "runlog_actions": (runlog_actions, ACTIONS_SQL),
    "runlog_inout": (runlog_inout, INOUT_SQL),
}
