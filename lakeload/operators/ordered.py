"""Looking ahead within a key without gathering a whole key in one task.

A window over one hot key would be a single task. Here the order column is cut into many
slices, each (key, slice) is a window of its own, and what a row cannot find in its slice
comes from a small table with one row per (key, slice).

Slices cannot cut rows of one key that share one order value. Where there are many of those, they
are a group of their own: one row stands for the group among the others, and inside it the next
order column is cut into slices in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.literals import array_of, quoted

# Cut points taken from the data; each part between two of them is cut further by width.
PARTS = 64
SLICES_PER_SHUFFLE_PARTITION = 4
# Rows of one key and order value that may stay together in one window; more are cut by the next order column.
MOST_TIED = 100_000


@dataclass(frozen=True)
class Cuts:
    """Lower bound and slice width of each part, in order."""

    lows: list[int]
    widths: list[int]
    per_part: int


def find_cuts(df: DataFrame, order: Column) -> Cuts:
    """Cut points by one pass: quantiles for balance, equal widths between them for number.

    The number of slices grows with the session's shuffle partitions, so that a third of all
    rows under one key still spreads over all of them. At most ``PARTS`` values are collected.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_part = max(1, -(-partitions * SLICES_PER_SHUFFLE_PARTITION // PARTS))
    shares = F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)])
    found = df.agg(
        F.min(order).alias("low"), F.max(order).alias("high"), F.percentile_approx(order, shares, F.lit(1000)).alias("inner")
    ).first()
    if found.low is None:
        return Cuts([0], [1], 1)
    lows = sorted({found.low, *found.inner})
    ends = [*lows[1:], found.high + 1]
    return Cuts(lows, [max(1, -(-(end - low) // per_part)) for low, end in zip(lows, ends)], per_part)


def part_of(order: str, lows: list[int], base: int = 0) -> str:
    """SQL for the index of the last lower bound at or below the value: a balanced tree of comparisons."""
    if len(lows) <= 1:
        return str(base)
    mid = len(lows) // 2
    below, above = part_of(order, lows[:mid], base), part_of(order, lows[mid:], base + mid)
    return f"CASE WHEN `{order}` < {quoted(lows[mid])} THEN {below} ELSE {above} END"


def with_slice(df: DataFrame, order: str) -> DataFrame:
    """Add ``_slice``, a whole number that never falls as the long column ``order`` rises."""
    cuts = find_cuts(df, F.col(order))
    low, width = (f"get({array_of(values)}, _part)" for values in (cuts.lows, cuts.widths))
    inside = f"CAST(floor((`{order}` - {low}) / {width}) AS BIGINT)"
    return (
        df.withColumn("_part", F.expr(part_of(order, cuts.lows)))
        .withColumn("_slice", F.expr(f"_part * {cuts.per_part} + least({inside}, {cuts.per_part - 1})"))
        .drop("_part")
    )


def next_value(df: DataFrame, keys: list[str], order: list[str], value: str, most_tied: int = MOST_TIED) -> DataFrame:
    """Add ``next_<value>``: the first non-null value after the row, by ``order`` within ``keys``.

    ``order[0]`` is a long that is cut into slices; ``order`` as a whole must leave no ties. A
    NULL in it comes after all values, and rows with a NULL key are a key of their own. More than
    ``most_tied`` rows of one key and ``order[0]`` are cut by ``order[1]`` where that is a whole number too.
    """
    if len(order) > 1 and isinstance(df.schema[order[1]].dataType, T.IntegralType):
        at = [*keys, order[0]]
        tied = df.groupBy(*at).agg(F.count("*").alias("_n")).where(F.col("_n") > most_tied)
        tied = tied.select(*[F.col(c).alias(f"_at_{c}") for c in at])
        if not tied.isEmpty():
            return _next_with_ties(df, tied, keys, order, value, most_tied)
    return _next_by_slices(df, keys, order, value)


def _next_with_ties(df: DataFrame, tied: DataFrame, keys: list[str], order: list[str], value: str, most_tied: int) -> DataFrame:
    """Each tied group is one row, its first value, among the rows without ties; what follows that row follows the group."""
    at = [*keys, order[0]]
    among = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in at])
    crowd, others = df.join(tied, among, "left_semi"), df.join(tied, among, "left_anti")

    place = F.struct(*_position(order[1:]))
    first = F.min_by(F.col(value), F.when(F.col(value).isNotNull(), place))
    stand_ins = crowd.groupBy(*at).agg(first.alias(value)).withColumn("_stands_in", F.lit(True))
    line = others.withColumn("_stands_in", F.lit(False)).unionByName(stand_ins, allowMissingColumns=True)
    found = _next_by_slices(line, keys, order, value)

    found_next = f"next_{value}"
    after = found.where("_stands_in").select(*[F.col(c).alias(f"_at_{c}") for c in at], F.col(found_next).alias("_after"))
    inside = next_value(crowd, at, order[1:], value, most_tied).join(after, among)
    inside = inside.withColumn(found_next, F.coalesce(found_next, "_after")).select(*df.columns, found_next)
    return found.where(~F.col("_stands_in")).select(*df.columns, found_next).unionByName(inside)


def _position(order: list[str]) -> list[Column]:
    return [part for c in order for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]


def _next_by_slices(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    sliced = with_slice(df, order[0])
    position = F.struct(*_position(order))

    backwards = Window.partitionBy(*keys, "_slice").orderBy(*[F.col(c).desc_nulls_first() for c in order])
    inside = F.last(value, ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, -1))

    heads = sliced.groupBy(*keys, "_slice").agg(
        F.min_by(F.col(value), F.when(F.col(value).isNotNull(), position)).alias("_head")
    )
    later = Window.partitionBy(*keys).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    held = [F.col(k).alias(f"_of_{k}") for k in keys]
    heads = heads.select(*held, F.col("_slice").alias("_of_slice"), F.last("_head", ignorenulls=True).over(later).alias("_later"))

    same = F.col("_slice") == F.col("_of_slice")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return (
        sliced.withColumn("_inside", inside)
        .join(heads, same)
        .withColumn(f"next_{value}", F.coalesce("_inside", "_later"))
        .drop("_slice", "_inside", "_later", "_of_slice", *[f"_of_{k}" for k in keys])
    )
