"""Reading the run log: which actions ran for which table, and what their counters say."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .ordered import next_value

# Columns of the run log.
ACTION = (
    "STRUCT<id: STRING, name: STRING, type: STRING, status: STRING, startTime: STRING, endTime: STRING, "
    "conf: STRING, stats: STRING, externalId: STRING>"
)
RUN_LOG = (
    "id STRING, appName STRING, status STRING, run INT, startTime STRING, endTime STRING, parentId STRING, "
    f"actions ARRAY<{ACTION}>"
)
# How the log writes times, settings and counters.
TIME_PATTERN = "dd MMM yyyy HH:mm:ss"
NOT_IN_NAME = "[^A-Za-z0-9_]"
OK_STATUS = "OK"
SUCCESS, FAILURE = "0", "2"


@dataclass(frozen=True)
class Direction:
    """What the steps, settings and counters of a load in one direction are called."""

    prep_step: str
    move_step: str
    folder_setting: str
    bytes_counter: str
    first_convert_step: str
    rows: str
    seconds: str
    size: str
    started: str


# Names in the log, and of the audit columns they fill.
INGEST = Direction(
    "import_prep", "_import", "target_dir", "HDFS_BYTES_WRITTEN", "_avro_parquet",
    "rows", "pull_time", "avro_size", "ingest_timestamp",
)
EXPORT = Direction(
    "export_prep", "_export", "source_dir", "HDFS_BYTES_READ", "_parquet_text",
    "row_count", "push_time", "txt_size", "export_timestamp",
)
LAST_CONVERT_STEP, MERGE_STEP = "_parquet_live", "_merge_partition"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run-log files, one JSON document per line, with a fixed schema (no inference pass)."""
    return spark.read.schema(RUN_LOG).json(path)


def log_time(col: Column) -> Column:
    """Timestamp of ``Wed, 30 Sep 2015 19:01:00 GMT``."""
    return F.try_to_timestamp(F.substring(col, 6, 20), F.lit(TIME_PATTERN)).cast("timestamp_ntz")


def seconds_of(col: Column) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(F.substring(col, 6, 20), F.lit(TIME_PATTERN)))


def setting(conf: Column, name: str) -> Column:
    found = F.regexp_extract(conf, f"<env-var>{name}=(.*?)</env-var>", 1)
    return F.when(found != "", found)


def counter(stats: Column, name: str) -> Column:
    found = F.regexp_extract(stats, f'"{name}":([0-9]+)', 1)
    return F.when(found != "", found.cast("bigint"))


def tables_of(actions: Column, direction: Direction = INGEST) -> Column:
    """The tables a run prepares, from the settings of its preparing steps."""
    preps = F.filter(actions, lambda a: (a["type"] == "shell") & a["name"].contains(direction.prep_step))
    named = F.transform(preps, lambda a: setting(a["conf"], "source_table_name"))
    return F.array_distinct(F.filter(named, lambda t: t.isNotNull()))


def actions_by_table(runs: DataFrame, direction: Direction = INGEST) -> DataFrame:
    """One row per action and table it belongs to: the tables whose cleaned name is in its name.

    The tables of a run sit in the run's own row, so the match needs no join and no shuffle.
    """
    with_tables = runs.select(
        F.col("id").alias("run_id"), F.col("appName").alias("app"),
        tables_of(F.col("actions"), direction).alias("tables"), "actions",
    )
    one = with_tables.select("run_id", "app", "tables", F.explode("actions").alias("a"))
    mine = F.filter("tables", lambda t: F.col("a.name").contains(F.regexp_replace(t, NOT_IN_NAME, "")))
    return one.select("run_id", "app", F.explode(mine).alias("table_name"), "a.*")


def in_out(actions: DataFrame) -> DataFrame:
    """Records in and out of each import action, and whether they agree."""
    imports = actions.where((F.col("type") == "sqoop") & F.col("stats").isNotNull())
    n_in, n_out = counter(F.col("stats"), "MAP_INPUT_RECORDS"), counter(F.col("stats"), "MAP_OUTPUT_RECORDS")
    return imports.select(
        "run_id", F.col("id").alias("action_id"), n_in.alias("records_in"), n_out.alias("records_out"),
        F.coalesce(n_in == n_out, F.lit(False)).alias("in_out_ok"),
    )


def table_records(actions: DataFrame, direction: Direction = INGEST) -> DataFrame:
    """Statistics of each run and table, by one grouped pass over the actions.

    Where a step ran twice the later one counts. Rows are NULL when in and out disagree.
    """
    d = direction
    start, end = seconds_of(F.col("startTime")), seconds_of(F.col("endTime"))
    order = F.struct(start, F.col("id"))
    plain = F.regexp_replace("table_name", NOT_IN_NAME, "")
    step = F.col("name")
    is_move = (F.col("type") == "sqoop") & step.contains(d.move_step) & (F.col("status") == OK_STATUS)
    is_prep = (F.col("type") == "shell") & step.contains(d.prep_step)
    n_in, n_out = counter(F.col("stats"), "MAP_INPUT_RECORDS"), counter(F.col("stats"), "MAP_OUTPUT_RECORDS")
    begins = (step == F.concat(plain, F.lit(d.first_convert_step))) | step.contains(MERGE_STEP)
    finishes = (step == F.concat(plain, F.lit(LAST_CONVERT_STEP))) | step.contains(MERGE_STEP)

    def latest(value: Column, when: Column) -> Column:
        return F.max_by(value, F.when(when, order))

    grouped = actions.groupBy("run_id", "table_name").agg(
        latest(setting(F.col("conf"), d.folder_setting), is_prep).alias("directory"),
        latest(setting(F.col("conf"), "domain"), is_prep).alias("domain"),
        latest(F.when(n_in == n_out, n_in), is_move).alias(d.rows),
        latest((end - start).cast("int"), is_move).alias(d.seconds),
        latest(counter(F.col("stats"), d.bytes_counter), is_move).alias(d.size),
        latest(F.col("startTime"), is_move).alias(d.started),
        F.max(F.when(begins, start)).alias("_begin"),
        F.max(F.when(finishes, end)).alias("_end"),
        F.bool_and(F.col("status") == OK_STATUS).alias("_ok"),
    )
    return grouped.withColumns(
        {
            "parquet_time": F.coalesce((F.col("_end") - F.col("_begin")).cast("int"), F.lit(0)),
            "success": F.when(F.col("_ok"), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)),
        }
    ).drop("_begin", "_end", "_ok")


def with_parquet_size(records: DataFrame, newest: DataFrame, live: str = "live") -> DataFrame:
    """Add the bytes of the newest load in each table's live folder, as the file listing gives them."""
    sizes = newest.select(F.col("directory").alias("_live"), F.col("n_bytes").alias("parquet_size"))
    joined = records.join(sizes, F.concat_ws("/", "directory", F.lit(live)) == F.col("_live"), "left")
    return joined.drop("_live")


def success_codes(actions: DataFrame) -> DataFrame:
    """``0`` for a run whose actions are all OK, else ``2``."""
    all_ok = F.bool_and(F.col("status") == OK_STATUS)
    return actions.groupBy("run_id").agg(F.when(all_ok, F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("success"))


def newest_sub_run(runs: DataFrame) -> DataFrame:
    """The sub-run each run started last, by name."""
    subs = runs.select(F.col("id").alias("run_id"), F.explode("actions").alias("a")).where(
        F.col("a.type") == "sub-workflow"
    )
    return subs.groupBy("run_id").agg(
        F.max("a.name").alias("sub_name"), F.max_by("a.externalId", "a.name").alias("external_id")
    )


def closest_runs(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """For each request (request_id, app, at) the first run of the app that starts at or after it.

    Requests and runs become one ordered stream per app, and each request takes the next run
    in it, so no pair of request and run is formed that is not the answer.
    """
    asked = requests.select("app", "at", F.lit(0).alias("kind"), F.col("request_id").alias("tie"), F.lit(None).cast("struct<run_id:bigint,at:timestamp_ntz>").alias("run"))
    ran = runs.select("app", "at", F.lit(1).alias("kind"), F.col("run_id").alias("tie"), F.struct("run_id", "at").alias("run"))
    stream = asked.unionByName(ran).withColumn("micros", F.unix_micros(F.col("at").cast("timestamp")))
    found = next_value(stream, ["app"], ["micros", "kind", "tie"], "run")
    return found.where(F.col("kind") == 0).select(
        F.col("tie").alias("request_id"), "app", F.col("next_run.run_id").alias("run_id"),
        F.expr("timestampdiff(SECOND, at, next_run.at)").alias("gap_seconds"),
    )


def step_gaps(steps: DataFrame, keys: list[str]) -> DataFrame:
    """Each step (``step_id``, ``at``, ``ended``) with the step after it and the seconds between them."""
    timed = steps.withColumns(
        {"micros": F.unix_micros(F.col("at").cast("timestamp")), "step": F.struct("step_id", "at")}
    )
    found = next_value(timed, keys, ["micros", "step_id"], "step")
    return found.select(
        *keys, "step_id", F.col("next_step.step_id").alias("next_step_id"),
        F.expr("timestampdiff(SECOND, ended, next_step.at)").alias("gap_seconds"),
    )
