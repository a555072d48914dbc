"""Checks that compare a source with its lake copy: counts, schemas, rows, conformance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import compat, types
from ..functions.literals import find
from .sample import MAX_SAMPLE_ROWS, check_sample

# A count passes above this share of the source, up to all of it.
COUNT_ABOVE_PERCENT, COUNT_UP_TO_PERCENT = 95, 100
NULL_TEXT = "(null)"
EMPTY_DATE = "0001-01-01"
TIME_ONLY_DAY = "1900-01-01 "
NULLABLE_MARKS = ("Y", "YES")
NUMERIC = ("DECIMAL", "INT", "SMALLINT", "BIGINT", "TINYINT", "FLOAT", "DOUBLE")
WHOLE = ("INT", "SMALLINT", "BIGINT", "TINYINT")
DATES = ("TIMESTAMP", "DATE")
TEXT = ("STRING", "VARCHAR", "CHAR")


# counts ---------------------------------------------------------------------------------

def count_check(counts: DataFrame) -> DataFrame:
    """Add the percentage of source rows that arrived and whether it passes."""
    source, target = F.col("source_rows"), F.col("target_rows")
    percent = F.when(source == 0, F.lit(100.0)).otherwise(target * F.lit(100.0) / F.nullif(source, F.lit(0)))
    return counts.withColumns(
        {
            "percent": percent,
            "count_ok": (percent > COUNT_ABOVE_PERCENT) & (percent <= COUNT_UP_TO_PERCENT),
            "target_when_source_empty": (source == 0) & (target > 0),
        }
    )


def two_counts(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """Rows per ``by`` on both sides, from one grouped pass over their union."""
    both = source.select(*by, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*by, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    rows = lambda side: F.coalesce(F.sum(side), F.lit(0))  # noqa: E731  sums over nothing are NULL
    return both.groupBy(*by).agg(rows("_s").alias("source_rows"), rows("_t").alias("target_rows"))


def require_equal_counts(source_rows: int, landed_rows: int) -> None:
    if source_rows != landed_rows:
        raise ValueError(f"extract read {source_rows} rows but {landed_rows} landed")


# schemas --------------------------------------------------------------------------------

#: What names a table in a catalog. The lake's side may leave the vendor out, and catalogs of one owner the owner.
TABLE = ("vendor", "owner", "table_name")


def table_key(*catalogs: DataFrame) -> list[str]:
    """The columns that name a table in all of the catalogs."""
    return [c for c in TABLE if all(c in df.columns for df in catalogs)]


def schema_match(source: DataFrame, lake: DataFrame, direction: str = "ingest") -> DataFrame:
    """Each source column beside the lake column at its place, for any number of tables.

    ``source`` is a vendor catalog with cleaned names and ``lake`` a lake catalog. Lake columns
    beyond the source's last are left out; a source column without a lake column fails. On the
    way out the identity column is dropped first and the sizes must fit the other way round.
    Tables of one name are kept apart by vendor and owner, as far as both catalogs have them.
    """
    named, shared = table_key(source), table_key(source, lake)
    if direction == "export":
        source = source.where(~F.col("is_identity"))
    size = F.when(F.lower("data_type").isin("number", "decimal", "numeric", "d"), F.lit(None).cast("int"))
    left = source.select(
        *named,
        "ordinal",
        F.col("column_name").alias("source_column"),
        F.col("data_type").alias("source_type"),
        size.otherwise(types.string_length(F.col("char_length"))).alias("s_length"),
        F.col("num_precision").alias("s_precision"),
        F.col("num_scale").alias("s_scale"),
    )
    right = lake.select(
        *shared,
        "ordinal",
        F.col("column_name").alias("lake_column"),
        F.col("data_type").alias("lake_type"),
        F.col("char_length").alias("t_length"),
        F.col("num_precision").alias("t_precision"),
        F.col("num_scale").alias("t_scale"),
    )
    joined = left.join(right, [*shared, "ordinal"], "left")

    def fits(s: str, t: str) -> Column:
        small, large = (F.col(s), F.col(t)) if direction == "ingest" else (F.col(t), F.col(s))
        return F.coalesce(small <= large, F.lit(True))

    sized = F.col("lake_type").isin(*types.SIZED)
    fit = fits("s_length", "t_length") & fits("s_precision", "t_precision") & fits("s_scale", "t_scale")
    return joined.select(
        *named,
        "ordinal",
        "source_column",
        "lake_column",
        F.coalesce(F.lower("source_column") == F.lower("lake_column"), F.lit(False)).alias("name_ok"),
        compat.is_allowed(F.col("vendor"), F.col("lake_type"), F.col("source_type"), direction).alias("type_ok"),
        (F.col("lake_column").isNotNull() & (~sized | fit)).alias("length_ok"),
    )


def schema_verdict(matched: DataFrame) -> DataFrame:
    """Matched and mismatched columns per table, and whether the table passes."""
    ok = F.col("name_ok") & F.col("type_ok") & F.col("length_ok")
    return matched.groupBy(*table_key(matched)).agg(
        F.count_if(ok).alias("matched"), F.count_if(~ok).alias("mismatched"), F.bool_and(ok).alias("schema_ok")
    )


def nullable_check(catalog: DataFrame) -> DataFrame:
    """Whether every column of each table accepts NULL."""
    return catalog.groupBy(*table_key(catalog)).agg(
        F.bool_and(F.coalesce(F.upper("nullable").isin(*NULLABLE_MARKS), F.lit(False))).alias("all_nullable")
    )


def column_set_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """Column names that stand on one side only; DB2 requires none, other vendors accept any."""
    named = table_key(source, target)
    both = (
        source.select(*named, F.lower("column_name").alias("column_name"), F.lit(1).alias("side"))
        .unionByName(
            target.select(*named, F.lower("column_name").alias("column_name"), F.lit(2).alias("side"))
        )
        .groupBy(*named, "column_name")
        .agg(F.bit_or("side").alias("sides"))
    )
    return both.groupBy(*named).agg(
        F.count_if(F.col("sides") == 1).alias("only_source"),
        F.count_if(F.col("sides") == 2).alias("only_target"),
        (F.bool_and(F.col("sides") == 3) | (F.first("vendor") != "db2")).alias("columns_ok"),
    )


# rows -----------------------------------------------------------------------------------

def base_lake_type(lake: str) -> str:
    return lake.split("(")[0].upper()


def comparable(df: DataFrame, name: str, lake: str) -> Column:
    """A value in the form two systems can be compared in: trimmed, numbers as numbers, dates by shape.

    Only text is parsed; a column that already has a number or time type is taken as it is.
    """
    kind, col, held = base_lake_type(lake), F.col(name), dict(df.dtypes)[name]
    if held != "string":
        if kind in DATES and held.startswith(("timestamp", "date")):
            col = col.cast("timestamp_ntz")
            return F.when(col.cast("date") != F.lit(EMPTY_DATE).cast("date"), col)
        if kind == "DECIMAL":
            return col.try_cast(lake.lower())
        if kind in NUMERIC:
            return col
    text = F.trim(col.cast("string"))
    text = F.when(text != NULL_TEXT, text)
    if kind in ("FLOAT", "DOUBLE"):
        return text.try_cast("double")
    if kind == "DECIMAL":
        return text.try_cast(lake.lower())
    if kind in NUMERIC:
        return text.try_cast("decimal(38,10)")
    if kind in DATES:
        text = F.when(~text.startswith(EMPTY_DATE), text)
        time_only = (F.length(text) == 8) & text.contains(":")
        return F.when(time_only, F.concat(F.lit(TIME_ONLY_DAY), text)).otherwise(text).try_cast("timestamp_ntz")
    return text


def unread(df: DataFrame, name: str, lake: str) -> Column:
    """Text of a value that is there but that its lake type cannot hold; such values differ unless their texts agree."""
    text = F.trim(F.col(name).cast("string"))
    kind = base_lake_type(lake)
    if kind not in NUMERIC and kind not in DATES:
        return F.lit(None).cast("string")
    there = (text != NULL_TEXT) & (text != "")
    if kind in DATES:
        there = there & ~text.startswith(EMPTY_DATE)
    return F.when(comparable(df, name, lake).isNull() & there, text)


def match_rows(source: DataFrame, target: DataFrame, keys: list[str], lake: dict[str, str]) -> DataFrame:
    """Every source row against the lake rows of its key.

    Gives how many lake rows have the key and which columns differ from the one that does.
    Copies of a key collapse before the lake side is shuffled. The join also takes a hash of
    the key, so that both its inputs are plain shuffles and not the grouping's own output:
    adaptive execution can only split a hot source key in that form.
    """
    values = [c for c in lake if c not in keys]
    held, stored = dict(source.dtypes), dict(target.dtypes)
    match_on = [f"_key_{k}" for k in keys]

    def key(df: DataFrame, k: str) -> Column:
        """One form for both sides: a key that is text on one side and a number on the other meets as a number."""
        col, kind = comparable(df, k, lake[k]), base_lake_type(lake[k])
        if kind in NUMERIC and held[k] != stored[k]:
            col = col.try_cast("double" if kind in ("FLOAT", "DOUBLE") else lake[k].lower() if kind == "DECIMAL" else "decimal(38,10)")
        return col.alias(f"_key_{k}")

    def prepared(df: DataFrame, *more: str) -> DataFrame:
        value = lambda c: F.struct(comparable(df, c, lake[c]).alias("held"), unread(df, c, lake[c]).alias("unread"))
        row = F.struct(*[value(c).alias(c) for c in values]).alias("_row")
        return df.select(*more, *[key(df, k) for k in keys], row)

    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(*match_on))

    lake_rows = prepared(target).groupBy(*match_on).agg(F.count("*").alias("_n"), F.min("_row").alias("_found"))
    joined = hashed(prepared(source, *keys)).join(hashed(lake_rows), ["_hash", *match_on], "left")
    differing = [F.when(~F.col(f"_row.{c}").eqNullSafe(F.col(f"_found.{c}")), F.lit(c)) for c in values]
    return joined.select(
        *keys,
        F.coalesce("_n", F.lit(0)).alias("n_matches"),
        F.when(F.col("_n") == 1, F.concat_ws(",", *differing)).otherwise(F.lit("")).alias("mismatched"),
    ).withColumn("row_ok", (F.col("n_matches") == 1) & (F.col("mismatched") == ""))


def find_sample(sample: DataFrame, target: DataFrame, lake: dict[str, str], id_column: str) -> DataFrame:
    """Lake rows that equal each sampled row on all columns but dates and empty text.

    The sample is counted before it is broadcast, and a large one is refused; the lake
    table is scanned once without a shuffle. The id is the join's key, so a table of text
    columns is looked up by hash too; a row without an id is found nowhere.
    """
    check_sample(sample.limit(MAX_SAMPLE_ROWS + 1).count())
    looked_up = [c for c, t in lake.items() if base_lake_type(t) not in DATES or c == id_column]
    wanted = sample.select(
        F.col(id_column).alias("_id"), *[comparable(sample, c, lake[c]).alias(f"_s_{c}") for c in looked_up]
    )
    big = target.select(*[comparable(target, c, lake[c]).alias(f"_t_{c}") for c in looked_up])

    def same(c: str) -> Column:
        if c == id_column:
            return F.col(f"_t_{c}") == F.col(f"_s_{c}")
        equal = F.col(f"_t_{c}").eqNullSafe(F.col(f"_s_{c}"))
        return equal | (F.col(f"_s_{c}") == "") if base_lake_type(lake[c]) in TEXT else equal

    condition = reduce(lambda a, b: a & b, [same(c) for c in dict.fromkeys([id_column, *looked_up])])
    hits = big.join(F.broadcast(wanted), condition).groupBy("_id").agg(F.count("*").alias("n_matches"))
    return (
        sample.select(F.col(id_column))
        .join(hits.withColumnRenamed("_id", id_column), id_column, "left")
        .select(id_column, F.coalesce("n_matches", F.lit(0)).alias("n_matches"))
    )


# conformance ----------------------------------------------------------------------------

# Whole-number types a column may be held in without a value ever breaking the lake type.
_WITHIN = {
    "TINYINT": ("tinyint",),
    "SMALLINT": ("tinyint", "smallint"),
    "INT": ("tinyint", "smallint", "int"),
    "BIGINT": ("tinyint", "smallint", "int", "bigint"),
    "FLOAT": ("float",),
    "DOUBLE": ("float", "double"),
    "BOOLEAN": ("boolean",),
    "TIMESTAMP": ("timestamp", "timestamp_ntz", "date"),
}


def always_conforms(held: str, lake: str) -> bool:
    """Whether the type a column is held in settles the question, so its values need not be read."""
    kind = base_lake_type(lake)
    return kind == "STRING" or held in _WITHIN.get(kind, ()) or held.upper() == lake.upper()


def conforms(df: DataFrame, name: str, lake: str) -> Column:
    """Whether a value, in text or typed, can be held by the lake type without loss."""
    if always_conforms(dict(df.dtypes)[name], lake):
        return F.lit(True)
    kind, col = base_lake_type(lake), F.col(name)
    text = col.cast("string")
    if kind in ("VARCHAR", "CHAR"):
        size = int(lake[len(kind) + 1 : -1])
        fits = F.length(text) <= size
    elif kind == "DECIMAL":
        precision, scale = (int(x) for x in lake[8:-1].split(","))
        whole = f"0*[0-9]{{0,{precision - scale}}}"
        fits = text.rlike(rf"^ *[+-]?(?=\.?[0-9]){whole}(\.[0-9]{{0,{scale}}}0*)? *$")
    elif kind in WHOLE:
        fits = text.try_cast(kind.lower()).isNotNull()
    elif kind in ("FLOAT", "DOUBLE"):
        fits = text.try_cast("double").isNotNull()
    elif kind in DATES:
        fits = text.try_cast("timestamp_ntz").isNotNull()
    else:
        fits = text.try_cast("boolean").isNotNull()
    return col.isNull() | fits


def conformance(df: DataFrame, lake: dict[str, str]) -> DataFrame:
    """Rows of the whole table that break their column's lake type, all columns in one scan."""
    bad = df.agg(*[F.count_if(~conforms(df, c, t)).alias(c) for c, t in lake.items()], F.count("*").alias("_rows"))
    long = bad.unpivot(["_rows"], list(lake), "column_name", "n_bad")
    return long.select(
        "column_name",
        find(lake, F.col("column_name")).alias("lake_type"),
        F.col("_rows").alias("n_rows"),
        "n_bad",
        (F.col("n_bad") == 0).alias("conforms"),
    )
