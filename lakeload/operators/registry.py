"""The registry of tables: lookups, request status, defaults, changes, dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes

# Keys and columns of the registries of loads and of exports.
KEYS = ["source_database_name", "source_table_name", "db_env"]
REGISTRY = (
    "full_table_name STRING, domain STRING, target_dir STRING, split_by STRING, mappers INT, jdbcurl STRING, "
    "connection_factories STRING, db_username STRING, password_file STRING, load STRING, fetch_size INT, hold INT, "
    "automation_appl_id STRING, views STRING, automation_group STRING, check_column STRING, source_schema_name STRING, "
    "sql_query STRING, actions STRING, source_database_name STRING, source_table_name STRING, db_env STRING"
)
EXPORT_REGISTRY = (
    "full_table_name STRING, source_dir STRING, mappers INT, jdbcurl STRING, connection_factories STRING, "
    "db_username STRING, password_file STRING, frequency STRING, fetch_size INT, target_schema STRING, "
    "target_table STRING, staging_database STRING, source_database_name STRING, source_table_name STRING, db_env STRING"
)
# Fixed values.
DEFAULT_ENV = "dev"
DOMAIN_SUFFIX = "_i"
VIEW_SEPARATOR = "|"
CLEAR = "null"
DEFAULT_MAPPERS, DEFAULT_FETCH_SIZE = 10, 50_000
# Order of the lines a registry dump writes per table.
DUMP_LINES = (
    "domain jdbcurl db_username password_file split_by mappers refresh_frequency weight fetch_size hold "
    "automation_appl_id views automation_group check_column source_schema_name sql_query actions "
    "source_database_name source_table_name db_env"
).split()


def view_list(col: Column) -> Column:
    """The names in a ``|``-separated list, in order; an empty or missing list has none."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), r"\|"), lambda v: v != "")


def lookup(registry: DataFrame, **wanted) -> DataFrame:
    """Rows whose columns equal the given values; None asks for a missing value."""
    for column, value in wanted.items():
        col = F.col(column)
        registry = registry.where(col.isNull() if value is None else col == value)
    return registry


def frequency(load: Column | None = None) -> Column:
    """Frequency name of a load code; a missing code has the default's."""
    load = F.col("load") if load is None else load
    filled = F.when(F.coalesce(load, F.lit("")) == "", F.lit(codes.DEFAULT_LOAD)).otherwise(load)
    return codes.frequency_name(F.substring(filled, 1, 3))


def by_schedule(registry: DataFrame, name: str) -> DataFrame:
    return registry.where(frequency() == name)


def request_status(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Each request as available, on hold or missing; a request without an env means the default one.

    The export registry has no holds, so its requests are available or missing.
    """
    asked = requests.withColumn("db_env", F.coalesce(F.nullif("db_env", F.lit("")), F.lit(DEFAULT_ENV)))
    hold = F.col("hold") if "hold" in registry.columns else F.lit(0)
    known = registry.select(*KEYS, hold.alias("_hold"), F.lit(True).alias("_known"))
    status = (
        F.when(F.col("_known").isNull(), F.lit("missing"))
        .when(F.col("_hold") == 0, F.lit("available"))
        .otherwise(F.lit("hold"))
    )
    return asked.join(known, KEYS, "left").withColumn("status", status).drop("_hold", "_known")


def merged_views(current: Column, asked: Column) -> Column:
    """New views after the current ones, each once; an empty request clears the list."""
    merged = F.array_join(F.array_distinct(F.concat(view_list(current), view_list(asked))), VIEW_SEPARATOR)
    return F.when(F.size(view_list(asked)) == 0, F.lit("")).otherwise(merged)


def normalise(requests: DataFrame) -> DataFrame:
    """Fill a request's defaults.

    Needs ``domain``, ``db_env``, ``refresh_frequency``, ``weight``, ``views`` and ``new_views``.
    """
    plain = F.coalesce(F.nullif("domain", F.lit("")), F.concat("source_database_name", F.lit(DOMAIN_SUFFIX)))
    env = F.concat("db_env", F.lit("_"))
    prefixed = F.when((F.col("db_env") == DEFAULT_ENV) | plain.contains(env), plain).otherwise(F.concat(env, plain))
    load = F.concat(
        codes.frequency_bits(F.col("refresh_frequency")),
        F.coalesce(codes.weight_bits(F.col("weight")), F.lit(codes.DEFAULT_LOAD[3:])),
    )
    return requests.withColumns(
        {
            "domain": prefixed,
            "load": load,
            "views": merged_views(F.col("views"), F.col("new_views")),
            "mappers": F.coalesce("mappers", F.lit(DEFAULT_MAPPERS)),
            "fetch_size": F.coalesce("fetch_size", F.lit(DEFAULT_FETCH_SIZE)),
        }
    )


def diff(current: DataFrame, asked: DataFrame, columns: list[str]) -> DataFrame:
    """One row per changed field. Empty means keep, the word ``null`` means clear."""
    new = asked.select(*KEYS, *[F.col(c).cast("string").alias(f"_new_{c}") for c in columns])
    old = current.select(*KEYS, *[F.col(c).cast("string").alias(f"_old_{c}") for c in columns])
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.coalesce(F.col(f"_old_{c}"), F.lit("")).alias("old_value"),
                F.coalesce(F.col(f"_new_{c}"), F.lit("")).alias("new_value"),
            )
            for c in columns
        ]
    )
    changed = F.filter(
        pairs,
        lambda p: (p["new_value"] != "") & ((p["new_value"] != p["old_value"]) | (p["new_value"] == CLEAR)),
    )
    rows = new.join(old, KEYS).select(*KEYS, F.explode(changed).alias("p"))
    return rows.select(
        *KEYS,
        F.col("p.column_name").alias("column_name"),
        F.col("p.old_value").alias("old_value"),
        F.when(F.col("p.new_value") == CLEAR, F.lit("")).otherwise(F.col("p.new_value")).alias("new_value"),
    )


def domains(registry: DataFrame) -> DataFrame:
    return registry.select("domain").where(F.col("domain").isNotNull()).distinct()


def id_parts(registry: DataFrame) -> DataFrame:
    """Distinct middle parts of the automation ids: three characters, the last but one at the end."""
    part = F.substr("automation_appl_id", F.length("automation_appl_id") - 3, F.lit(3))
    return registry.select(part.alias("id_part")).distinct()


def remove(registry: DataFrame, keys: DataFrame) -> DataFrame:
    """The registry without the rows of the given keys."""
    return registry.join(keys.select(*KEYS), KEYS, "left_anti")


def placeholders(requests: DataFrame) -> DataFrame:
    """Rows on hold for requested tables: only the key is known, so nothing loads them yet."""
    shape = requests.sparkSession.createDataFrame([], REGISTRY).schema
    known = {k: F.col(k) for k in KEYS} | {
        "hold": F.lit(1), "load": F.lit(codes.DEFAULT_LOAD), "mappers": F.lit(DEFAULT_MAPPERS),
        "fetch_size": F.lit(DEFAULT_FETCH_SIZE),
    }
    return requests.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])


def dump(registry: DataFrame, vendor: str | None = None) -> DataFrame:
    """One text section per table, of all tables or of one vendor's."""
    if vendor:
        registry = registry.where(F.lower("jdbcurl").contains(vendor))
    readable = registry.withColumns(
        {"refresh_frequency": frequency(), "weight": codes.weight_name(F.substring("load", 4, 3))}
    )
    lines = [F.concat(F.lit(f"{c}:"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in DUMP_LINES]
    return readable.select(F.concat_ws("\n", F.lit("[Request]"), *lines).alias("section"))


def groups(registry: DataFrame) -> DataFrame:
    """Which tables belong to which vendor, domain, database and schedule.

    One row per membership, so no group is ever held in one place; sort or count it as needed.
    """
    member = F.array(
        F.struct(F.lit("vendor").alias("kind"), codes.vendor_of(F.col("jdbcurl")).alias("value")),
        F.struct(F.lit("domain").alias("kind"), F.col("domain").alias("value")),
        F.struct(F.lit("database").alias("kind"), F.col("source_database_name").alias("value")),
        F.struct(F.lit("schedule").alias("kind"), frequency().alias("value")),
    )
    return registry.select(F.explode(member).alias("m"), "full_table_name").select(
        F.col("m.kind").alias("group_kind"), F.col("m.value").alias("group_value"), "full_table_name"
    )
