"""High-water marks and the rows above them."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import Column, DataFrame, functions as F

TIMESTAMP_KINDS = ("timestamp", "timestamp_ntz", "date")


def mode_of(df: DataFrame, check_column: str) -> str:
    """``lastmodified`` for a time column, ``append`` for a number; other columns are refused."""
    kinds = dict(df.dtypes)
    if check_column not in kinds:
        raise ValueError(f"check column {check_column} is not one of: {', '.join(df.columns)}")
    kind = kinds[check_column]
    if kind in TIMESTAMP_KINDS:
        return "lastmodified"
    if kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        return "append"
    raise ValueError(f"check column {check_column} is {kind}; a time or whole number is needed")


def high_watermark(live: DataFrame, check_column: str):
    """Largest value already loaded, or None for an empty table. One value reaches the driver."""
    mode_of(live, check_column)
    return live.agg(F.max(check_column)).first()[0]


def mark_literal(mark) -> Column:
    if isinstance(mark, dt.datetime) and mark.tzinfo is None:
        return F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(mark)


def above(source: DataFrame, check_column: str, mark, inclusive: bool = False) -> DataFrame:
    """Rows newer than the mark. The literal lets the filter reach the scan; no mark means all rows."""
    mode_of(source, check_column)
    if mark is None:
        return source
    limit = mark_literal(mark)
    if dict(source.dtypes)[check_column] == "timestamp":
        limit = limit.cast("timestamp")
    col = F.col(check_column)
    return source.where(col >= limit if inclusive else col > limit)


# Vendors whose time check counts the row at the mark as well.
INCLUSIVE_VENDORS = ("oracle", "sqlserver", "mysql", "postgresql")


def delta_counts(source: DataFrame, check_column: str, mark, vendors: tuple[str, ...]) -> DataFrame:
    """Rows newer than the mark, as each vendor counts them, from one pass over the source."""
    mode = mode_of(source, check_column)
    limit = mark_literal(mark)
    col = F.col(check_column)
    counted = source.agg(F.count_if(col > limit).alias("after"), F.count_if(col >= limit).alias("from_mark"))
    vendor = F.explode(F.array(*[F.lit(v) for v in vendors]))
    inclusive = F.col("vendor").isin(*INCLUSIVE_VENDORS) & F.lit(mode == "lastmodified")
    return counted.select(vendor.alias("vendor"), "after", "from_mark").select(
        "vendor",
        F.lit(mode).alias("mode"),
        F.when(inclusive, F.col("from_mark")).otherwise(F.col("after")).alias("n_rows"),
    )


def where_clause(vendor: str, check_column: str, mark) -> str:
    """The increment filter as SQL the vendor's database runs, for a JDBC read."""
    if isinstance(mark, (int, decimal.Decimal)):
        return f"{check_column} > {mark}"
    text = mark.isoformat(sep=" ", timespec="microseconds")
    written = {
        "oracle": f"{check_column.upper()} > to_timestamp('{text}', 'YYYY-MM-DD HH24:MI:SS.FF9')",
        "teradata": f"{check_column.upper()} > TIMESTAMP '{text}'",
        "db2": f"timestamp({check_column.upper()}) > timestamp('{text}')",
        "sqlserver": f"{check_column} > convert(datetime2, '{text}')",
    }
    return written.get(vendor, f"{check_column} > '{text}'")


def has_rows(increment: DataFrame) -> bool:
    return not increment.isEmpty()


def increments(source: DataFrame, live: DataFrame, by: list[str], check_column: str) -> DataFrame:
    """For each value of ``by`` in the source whether it has rows above its own mark, by one grouped pass over both sides.

    A table that has no live row yet has no mark: all its rows are new. One without a value to compare is left out.
    """
    mode_of(source, check_column)
    both = source.select(*by, F.col(check_column).alias("_new"), F.lit(None).cast(source.schema[check_column].dataType).alias("_mark")).unionByName(
        live.select(*by, F.lit(None).cast(source.schema[check_column].dataType).alias("_new"), F.col(check_column).alias("_mark"))
    )
    top = both.groupBy(*by).agg(F.max("_new").alias("newest"), F.max("_mark").alias("mark"))
    some = F.col("mark").isNull() | (F.col("newest") > F.col("mark"))
    return top.where("newest IS NOT NULL").select(*by, "mark", some.alias("has_rows"))
