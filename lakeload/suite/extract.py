"""Queries for extracts, increments and the stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import catalog, incremental, profile, project, ranges, sample
from ..plans import loads
from ..sinks import marks, publish
from ..sources import files
from ..session import scratch
from ..streaming import ingest
from . import inputs as inp
from .inputs import DUCK, SPARK

SPLIT_AT = "2024-01-15 00:00:00"
FULL_AT = dt.datetime(2024, 1, 15, 0, 0, 0)
INCR_AT = dt.datetime(2024, 2, 1, 6, 30, 0)


def _older(events):
    return events.where(F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz"))


def extract_full(spark, sf):
    orders = inp.tables(spark, sf)["orders"]
    return files.land(orders, scratch(spark, "extract_full"))


def split_bounds(spark, sf):
    return profile.split_bounds(inp.tables(spark, sf)["lineitem"], "l_orderkey", 10)


SPLIT_BOUNDS_SQL = """
WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem),
     w AS (SELECT lo, CAST(ceil((hi - lo + 1) / 10.0) AS BIGINT) AS width FROM b),
     r AS (SELECT CAST(i AS INTEGER) AS range_no, lo + i * width AS lower, lo + (i + 1) * width - 1 AS upper
           FROM w, range(10) t(i))
SELECT range_no, lower, upper, count(l_orderkey) AS n_rows
FROM r LEFT JOIN lineitem ON l_orderkey BETWEEN lower AND upper GROUP BY ALL
"""


EVEN_READERS = 10
# One row in two has key 1, one in three no key at all.
_EVEN = {
    "zipf": ("lineitem", "CAST(1000 / (1 + l_partkey % 1000) AS BIGINT)", "l_orderkey"),
    "nulls": ("events", "CASE WHEN event_id % 3 > 0 THEN user_id END", "event_id"),
    "gaps": ("orders", "CASE WHEN o_orderkey % 10 > 0 THEN o_orderkey ELSE o_orderkey * 1000000000 END", None),
    "times": ("events", "ts", "event_id"),
    "decimals": ("orders", "CAST(o_totalprice AS DECIMAL(15, 2))", None),
}


def split_even(spark, sf):
    """Parts of about equal rows for ten readers: all rows, those in exactly one part, and whether none is over 1.5 shares."""
    t = inp.tables(spark, sf)
    found = None
    for label, (name, key, second) in _EVEN.items():
        rows = t[name].select(F.expr(key).alias("k"), *([F.col(second).alias("second")] if second else []))
        parts = ranges.filters(rows, "k", EVEN_READERS, "second" if second else None)
        one = ranges.measured(rows, parts).select(
            F.lit(label).alias("split_key"), "n_rows", "n_once",
            (F.col("largest") * (2 * EVEN_READERS) <= F.col("n_rows") * 3).cast("int").alias("even"),
        )
        found = one if found is None else found.unionByName(one)
    return found


SPLIT_EVEN_SQL = " UNION ALL ".join(
    f"SELECT '{label}' AS split_key, count(*) AS n_rows, count(*) AS n_once, 1 AS even FROM {name}" for label, (name, _, _) in _EVEN.items()
)


def extract_where(spark, sf):
    """Orders under awkward source names, filtered by a custom condition on them."""
    orders = inp.tables(spark, sf)["orders"].select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("1 total price"),
        F.col("o_orderpriority").alias("_priority"), F.col("o_orderstatus").alias("status"),
    )
    picked = project.extracted(orders, "status = 'F' AND `1 total price` > 100000")
    return files.land(picked, scratch(spark, "extract_where"))


def extract_validate(spark, sf):
    tables = inp.tables(spark, sf)
    counted = []
    for name in ("orders", "events", "customer", "part"):
        landed, extracted = files.land_counted(tables[name], scratch(spark, "extract_validate"))
        counted.append(
            landed.agg(F.count("*").alias("landed_rows")).select(
                F.lit(name).alias("table_name"), F.lit(extracted).cast("bigint").alias("source_rows"), "landed_rows"
            )
        )
    both = counted[0]
    for one in counted[1:]:
        both = both.unionByName(one)
    return both.withColumn("counts_equal", F.col("source_rows") == F.col("landed_rows"))


EXTRACT_VALIDATE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS landed_rows, true AS counts_equal FROM {t}"
    for t in ("orders", "events", "customer", "part")
)

# What each vendor's own dictionary calls the catalog's columns.
_RENAMES = {
    "ordinal": "ordinal", "name": "column_name", "data_type": "data_type", "scale": "num_scale",
    "table": "table_name", "precision": "num_precision", "length": "char_length",
}


def _dictionary(rows, vendor):
    d = catalog.DICTIONARIES[vendor]
    given = {getattr(d, part): F.col(column) for part, column in _RENAMES.items()}
    given[d.length] = F.col("char_length")
    if d.nullable:
        given[d.nullable] = F.col("nullable")
    given[d.identity] = F.when(F.col("is_identity"), F.lit(d.identity_marks[0]))
    return rows.where(F.col("vendor") == vendor).select(*[c.alias(n) for n, c in given.items()])


def catalog_scan(spark, sf):
    rows = inp.derive(spark, sf, inp.catalog(SPARK))
    scanned = [catalog.from_dictionary(v, _dictionary(rows, v)) for v in catalog.DICTIONARIES]
    both = scanned[0]
    for one in scanned[1:]:
        both = both.unionByName(one)
    return both


CATALOG_SCAN_SQL = inp.with_inputs(
    """SELECT vendor, table_name, ordinal, trim(column_name) AS column_name, data_type, char_length,
              CASE WHEN vendor = 'db2' THEN char_length ELSE num_precision END AS num_precision, num_scale,
              CASE WHEN vendor = 'mysql' THEN NULL ELSE nullable END AS nullable, is_identity FROM c""",
    c=inp.catalog(DUCK),
)


def _described(dialect):
    return f"""
      SELECT vendor, table_name, ordinal, column_name,
             CASE k % 4 WHEN 0 THEN 'decimal(' || (10 + k % 20) || ',' || (k % 6) || ')'
                        WHEN 1 THEN 'varchar(' || (k % 400 + 1) || ')'
                        WHEN 2 THEN 'timestamp' ELSE 'char(' || (k % 9 + 1) || ')' END AS col_type
      FROM ({inp.catalog(dialect)}) c
      UNION ALL SELECT vendor, table_name, CAST(9 AS INT), 'ingest_timestamp', 'string' FROM ({inp.catalog(dialect)}) c WHERE ordinal = 1
      UNION ALL SELECT vendor, table_name, CAST(10 AS INT), 'incr_ingest_timestamp', 'string' FROM ({inp.catalog(dialect)}) c WHERE ordinal = 1"""


def describe_target(spark, sf):
    return catalog.describe_lake(inp.derive(spark, sf, _described(SPARK)))


DESCRIBE_TARGET_SQL = inp.with_inputs(
    r"""SELECT vendor, table_name, ordinal, column_name, upper(split_part(col_type, '(', 1)) AS data_type,
               CASE WHEN col_type LIKE '%char(%' THEN CAST(regexp_extract(col_type, '\((\d+)\)', 1) AS INTEGER) END AS char_length,
               CASE WHEN col_type LIKE 'decimal%' THEN CAST(regexp_extract(col_type, '\((\d+),', 1) AS INTEGER) END AS num_precision,
               CASE WHEN col_type LIKE 'decimal%' THEN CAST(regexp_extract(col_type, ',(\d+)\)', 1) AS INTEGER) END AS num_scale
        FROM d WHERE column_name NOT IN ('ingest_timestamp', 'incr_ingest_timestamp')""",
    d=_described(DUCK),
)


def peek_rows(spark, sf):
    return sample.peek(inp.tables(spark, sf)["orders"], ["o_orderkey"])


def incr_lastmodified(spark, sf):
    events = inp.tables(spark, sf)["events"]
    return incremental.above(events, "ts", incremental.high_watermark(_older(events), "ts"))


def _lower_half(orders):
    half = orders.agg(F.max("o_orderkey")).first()[0] // 2
    return orders.where(F.col("o_orderkey") <= half)


def incr_append(spark, sf):
    orders = inp.tables(spark, sf)["orders"]
    return incremental.above(orders, "o_orderkey", incremental.high_watermark(_lower_half(orders), "o_orderkey"))


def high_watermark(spark, sf):
    t = inp.tables(spark, sf)
    checks = [("events", "ts"), ("lineitem", "l_shipdate"), ("orders", "o_orderkey"), ("events", "event_id")]
    marks = None
    for name, column in checks:
        mode = incremental.mode_of(t[name], column)
        mark = incremental.mark_literal(incremental.high_watermark(t[name], column))
        text = F.date_format(mark, project.TEXT_TIMESTAMP_PATTERN) if mode == "lastmodified" else mark.cast("string")
        one = spark.range(1).select(F.lit(name).alias("table_name"), F.lit(column).alias("check_column"), F.lit(mode).alias("mode"), text.alias("mark"))
        marks = one if marks is None else marks.unionByName(one)
    return marks


HIGH_WATERMARK_SQL = f"""
SELECT 'events' AS table_name, 'ts' AS check_column, 'lastmodified' AS mode, {inp.time_text("max(ts)", DUCK, True)} AS mark FROM events
UNION ALL SELECT 'lineitem', 'l_shipdate', 'lastmodified', {inp.time_text("max(l_shipdate)", DUCK, True)} FROM lineitem
UNION ALL SELECT 'orders', 'o_orderkey', 'append', CAST(max(o_orderkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'events', 'event_id', 'append', CAST(max(event_id) AS VARCHAR) FROM events
"""


def _three_loads(spark, sf, live):
    """A full load, an increment, and a later load of one event in ten, older and newer than the mark."""
    events, late = inp.tables(spark, sf)["events"], F.col("event_id") % 10 == 0
    newer = events.where(F.col("ts") >= F.lit(SPLIT_AT).cast("timestamp_ntz"))
    for label, rows in {"full_20240115000000": _older(events).where(~late), "20240201063000": newer.where(~late), "20240301000000": events.where(late)}.items():
        publish.merge_partition(rows.withColumn(publish.PARTITION, F.lit(label)), live)
        marks.refresh(spark, live, "ts", events.schema)
    return events.schema


def mark_spans(spark, sf):
    """The span of every load partition as it is kept beside the live table, each partition read once."""
    live = scratch(spark, "mark_spans")
    schema = _three_loads(spark, sf, live)
    return marks.spans(spark, live, "ts", schema)


MARK_SPANS_SQL = f"""
SELECT CASE WHEN event_id % 10 = 0 THEN '20240301000000' WHEN ts < TIMESTAMP '{SPLIT_AT}' THEN 'full_20240115000000' ELSE '20240201063000' END
       AS incr_ingest_timestamp, count(*) AS n_rows, min(ts) AS low, max(ts) AS high
FROM events GROUP BY 1
"""


def incr_empty_skip(spark, sf):
    """Each event type is a source; two of them are already loaded whole."""
    events = inp.tables(spark, sf)["events"]
    live = events.where((F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz")) | F.col("event_type").isin("error", "view"))
    found = incremental.increments(events, live, ["event_type"], "ts")
    return found.select("event_type", F.col("has_rows").cast("int").alias("has_rows"), F.when(F.col("has_rows"), "publish").otherwise("skip").alias("action"))


INCR_EMPTY_SQL = f"""
SELECT event_type,
       CAST(max(ts) > max(ts) FILTER (WHERE ts < TIMESTAMP '{SPLIT_AT}' OR event_type IN ('error', 'view')) AS INTEGER) AS has_rows,
       CASE WHEN max(ts) > max(ts) FILTER (WHERE ts < TIMESTAMP '{SPLIT_AT}' OR event_type IN ('error', 'view'))
            THEN 'publish' ELSE 'skip' END AS action
FROM events GROUP BY event_type
"""

_EVENT_FIELDS = [
    project.Field("event_id", "BIGINT"), project.Field("ts", "TIMESTAMP"), project.Field("user_id", "BIGINT"),
    project.Field("event_type", "VARCHAR", 20), project.Field("value", "DOUBLE PRECISION"), project.Field("props", "TEXT"),
]


def _load_twice(spark, sf, label, reruns):
    events = inp.tables(spark, sf)["events"]
    to = loads.Folders(scratch(spark, label))
    live = loads.full_load(_older(events), _EVENT_FIELDS, "mysql", to, FULL_AT)
    increment = events.where(F.col("ts") >= F.lit(SPLIT_AT).cast("timestamp_ntz"))
    loads.incremental_load(increment, _EVENT_FIELDS, "mysql", "ts", to, INCR_AT)
    for _ in range(reruns):
        # A repeated load has no newer rows to find, so it writes its own increment again.
        again = project.with_system_columns(
            project.typed(files.read_landing(spark, to.landing), _EVENT_FIELDS, "mysql"),
            INCR_AT.strftime("%Y-%m-%d %H:%M:%S"), project.load_stamp(INCR_AT, False),
        )
        publish.merge_partition(again, to.live)
    return publish.read_partitioned(spark, to.live, live.schema)


def incr_merge(spark, sf):
    return _load_twice(spark, sf, "incr_merge", 0)


def incr_rerun(spark, sf):
    return _load_twice(spark, sf, "incr_rerun", 1)


INCR_MERGE_SQL = f"""
SELECT *, CASE WHEN ts < TIMESTAMP '{SPLIT_AT}' THEN '2024-01-15 00:00:00' ELSE '2024-02-01 06:30:00' END AS ingest_timestamp,
       CASE WHEN ts < TIMESTAMP '{SPLIT_AT}' THEN 'full_20240115000000' ELSE '20240201063000' END AS incr_ingest_timestamp
FROM events
"""


def delta_count(spark, sf):
    t = inp.tables(spark, sf)
    vendors = tuple(catalog.DICTIONARIES)
    by_time = incremental.delta_counts(t["events"], "ts", incremental.high_watermark(_older(t["events"]), "ts"), vendors)
    mark = incremental.high_watermark(_lower_half(t["orders"]), "o_orderkey")
    return by_time.unionByName(incremental.delta_counts(t["orders"], "o_orderkey", mark, vendors))


DELTA_COUNT_SQL = f"""
WITH v AS (SELECT unnest(['oracle', 'db2', 'teradata', 'sqlserver', 'postgresql', 'mysql']) AS vendor),
     m AS (SELECT max(ts) AS mark FROM events WHERE ts < TIMESTAMP '{SPLIT_AT}'),
     n AS (SELECT count(*) FILTER (WHERE ts > mark) AS gt, count(*) FILTER (WHERE ts >= mark) AS ge FROM events, m),
     o AS (SELECT count(*) AS gt FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders))
SELECT vendor, 'lastmodified' AS mode, CASE WHEN vendor IN ('db2', 'teradata') THEN gt ELSE ge END AS n_rows FROM v, n
UNION ALL SELECT vendor, 'append', gt FROM v, o
"""

_CUSTOMER_CSV = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def csv_inbound(spark, sf):
    customer = inp.tables(spark, sf)["customer"]
    drop = scratch(spark, "csv_drop")
    customer.where("c_custkey % 2 = 0").write.csv(drop, header=True)
    customer.where("c_custkey % 2 = 1").write.mode("append").csv(drop, header=True, compression="gzip")
    return files.ingest_csv(spark, drop, _CUSTOMER_CSV, scratch(spark, "csv_table"))


def landing_roundtrip(spark, sf):
    return files.land(inp.tables(spark, sf)["customer"], scratch(spark, "landing"))


def land_as_string(spark, sf):
    events = inp.tables(spark, sf)["events"]
    text = project.lands_as_text(
        [project.Field("ts", "TIMESTAMP(6)"), project.Field("props", "JSON"), project.Field("event_type", "VARCHAR")]
    )
    return project.land_as_text(events, text)


LAND_AS_STRING_SQL = f"SELECT * REPLACE ({inp.time_text('ts', DUCK, True)} AS ts) FROM events"


def stream_ingest(spark, sf):
    events = inp.tables(spark, sf)["events"]
    folder = scratch(spark, "stream")
    landing, live, checkpoint = f"{folder}/landing", f"{folder}/live", f"{folder}/checkpoint"
    newer = events.where(F.col("ts") >= F.lit(SPLIT_AT).cast("timestamp_ntz"))
    for drop in (_older(events), newer):
        drop.write.mode("append").parquet(landing)
        ingest.run_available(
            spark, landing, events.schema, live, checkpoint, lambda df: project.typed(df, _EVENT_FIELDS, "mysql"), ingest_time=SPLIT_AT
        )
    return publish.read_partitioned(spark, live, T.StructType([*events.schema.fields, T.StructField("ingest_timestamp", T.StringType())]))


STREAM_SQL = f"""
SELECT *, '{SPLIT_AT}' AS ingest_timestamp, CASE WHEN ts < TIMESTAMP '{SPLIT_AT}' THEN 'batch_0' ELSE 'batch_1' END AS incr_ingest_timestamp FROM events
"""

def stream_each_once(spark, sf):
    """Three drops: the second repeats the last hour before it, the third all of the second and brings one event in ten, most of them late."""
    events = inp.tables(spark, sf)["events"]
    folder = scratch(spark, "stream_once")
    landing, live, late = f"{folder}/landing", f"{folder}/live", f"{folder}/late"
    held_back, since = F.col("event_id") % 10 == 0, F.lit(SPLIT_AT).cast("timestamp_ntz")
    second = events.where(~held_back & (F.col("ts") >= since - F.expr("INTERVAL 1 HOUR")))
    for drop in (_older(events).where(~held_back), second, second.unionByName(events.where(held_back))):
        drop.write.mode("append").parquet(landing)
        ingest.run_each_once(spark, landing, events.schema, live, late, f"{folder}/checkpoint", ["event_id"], "ts", "1 DAY")
    return publish.read_partitioned(spark, live, events.schema).withColumn("is_late", F.lit(0)).unionByName(
        publish.read_partitioned(spark, late, events.schema).withColumn("is_late", F.lit(1))
    )


STREAM_ONCE_SQL = f"""
WITH m AS (SELECT max(ts) - INTERVAL 1 DAY AS cutoff FROM events WHERE event_id % 10 <> 0)
SELECT events.*,
       CASE WHEN event_id % 10 = 0 THEN 'batch_2' WHEN ts < TIMESTAMP '{SPLIT_AT}' THEN 'batch_0' ELSE 'batch_1' END AS incr_ingest_timestamp,
       CAST(event_id % 10 = 0 AND ts < cutoff AS INTEGER) AS is_late
FROM events, m
"""

KEYS = {
    "catalog_scan": (catalog_scan, CATALOG_SCAN_SQL),
    "csv_inbound": (csv_inbound, "SELECT * FROM customer"),
    "delta_count": (delta_count, DELTA_COUNT_SQL),
    "describe_target": (describe_target, DESCRIBE_TARGET_SQL),
    "extract_full": (extract_full, "SELECT * FROM orders"),
    "extract_validate": (extract_validate, EXTRACT_VALIDATE_SQL),
    "extract_where": (
        extract_where,
        'SELECT o_orderkey AS orderkey, o_totalprice AS "i_1totalprice", o_orderpriority AS "i_priority", o_orderstatus AS status '
        "FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
    ),
    "high_watermark": (high_watermark, HIGH_WATERMARK_SQL),
    "incr_append": (incr_append, "SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)"),
    "incr_empty_skip": (incr_empty_skip, INCR_EMPTY_SQL),
    "incr_lastmodified": (
        incr_lastmodified,
        f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{SPLIT_AT}')",
    ),
    "incr_merge": (incr_merge, INCR_MERGE_SQL),
    "incr_rerun": (incr_rerun, INCR_MERGE_SQL),
    "land_as_string": (land_as_string, LAND_AS_STRING_SQL),
    "landing_roundtrip": (landing_roundtrip, "SELECT * FROM customer"),
    "mark_spans": (mark_spans, MARK_SPANS_SQL),
    "peek_rows": (peek_rows, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 3"),
    "split_bounds": (split_bounds, SPLIT_BOUNDS_SQL),
    "split_even": (split_even, SPLIT_EVEN_SQL),
    "stream_each_once": (stream_each_once, STREAM_ONCE_SQL),
    "stream_ingest": (stream_ingest, STREAM_SQL),
}
