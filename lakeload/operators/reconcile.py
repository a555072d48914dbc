"""Comparing two large tables without moving the rows that agree.

Rows fall into buckets by a hash of their key. Each side adds up a hash of its whole rows for
each bucket; such sums combine before they are shuffled, and equal sums with equal counts mean
equal rows. Buckets that differ are divided again, as in a hash tree, until they are small.
Only rows of the last differing buckets are joined one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle
from .compare import comparable, match_rows, unread

#: Bits of the key's hash by which a bucket is divided, and rows a bucket may hold to be joined.
FAN_BITS, LEAF_ROWS = 12, 64


def _common(name: str, left: Column, right: Column, frames: tuple[DataFrame, DataFrame]) -> tuple[Column, Column]:
    """Both sides' forms of a column in the one type that Spark would compare them in."""
    kinds = [df.select(c.alias(name)).dtypes[0][1] for df, c in zip(frames, (left, right), strict=True)]
    if kinds[0] == kinds[1]:
        return left, right
    return F.coalesce(left, F.lit(None).cast(kinds[1])), F.coalesce(right, F.lit(None).cast(kinds[0]))


def _hashed(source: DataFrame, target: DataFrame, keys: list[str], lake: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``_bucket``, a hash of the key, and ``_row``, a hash of key and values in comparable form."""
    names = [*keys, *[c for c in lake if c not in keys]]
    forms = [_common(c, comparable(source, c, lake[c]), comparable(target, c, lake[c]), (source, target)) for c in names]
    out = []
    for side, df in enumerate((source, target)):
        own = [f[side] for f in forms]
        key = F.xxhash64(*own[: len(keys)])
        # xxhash64 passes over NULLs, so what is NULL is hashed as well.
        absent = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in own])
        strange = [F.coalesce(unread(df, c, lake[c]), F.lit("")) for c in names]
        row = F.xxhash64(absent, *own, *strange)
        # A NULL key matches nothing on the other side, whatever stands there.
        without_key = F.lit(False)
        for c in own[: len(keys)]:
            without_key = without_key | c.isNull()
        out.append(df.withColumn("_bucket", key).withColumn("_row", F.when(without_key, F.xxhash64(row, F.lit(side))).otherwise(row)))
    return out[0], out[1]


def differing(source: DataFrame, target: DataFrame, bits: int) -> tuple[DataFrame, int]:
    """The buckets (the key hash's first bits) whose counts or sums differ, and the rows of both sides."""
    bucket = F.shiftrightunsigned("_bucket", 64 - bits).alias("_b")
    both = source.select(bucket, "_row", F.lit(1).alias("_side")).unionByName(target.select(bucket, "_row", F.lit(-1).alias("_side")))
    # The row's hash in two halves, whose sums cannot overflow; signed by side they cancel where both sides agree.
    low, high = F.col("_row").bitwiseAND(0xFFFFFFFF), F.shiftright("_row", 32)
    sums = both.groupBy("_b").agg(
        F.sum("_side").alias("n"), F.sum(F.col("_side") * low).alias("low"), F.sum(F.col("_side") * high).alias("high"),
        F.sum(F.col("_side") * F.shiftrightunsigned(F.xxhash64("_row"), 32)).alias("mixed"),
        F.count("*").alias("rows"),
    )
    sums = settle(sums, "sums")
    total = sums.agg(F.sum("rows")).first()[0] or 0
    return sums.where("n <> 0 OR low <> 0 OR high <> 0 OR mixed <> 0").select("_b"), total


def suspects(source: DataFrame, target: DataFrame, keys: list[str], lake: dict[str, str], leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Source and target rows of the differing buckets, and the other source rows, which stand in the target as they are.

    The source holds each key once, as a primary key does. Rows whose hashes collide in all
    sums of a bucket would pass as equal; the sums are 96 bits.
    """
    left, right = _hashed(source, target, keys, lake)
    bits, inside = FAN_BITS, (left, right)
    while True:
        buckets, total = differing(*inside, bits)
        rest = [df.join(buckets, F.shiftrightunsigned(df["_bucket"], 64 - bits) == buckets["_b"], "left_semi") for df in (left, right)]
        # Rows of a bucket at this level, if the hash spreads the whole table.
        if bits == FAN_BITS:
            whole = total
        if whole >> bits <= leaf_rows or bits + FAN_BITS > 60 or buckets.isEmpty():
            break
        bits, inside = bits + FAN_BITS, tuple(rest)
    alike = left.join(buckets, F.shiftrightunsigned(left["_bucket"], 64 - bits) == buckets["_b"], "left_anti")
    return rest[0].drop("_bucket", "_row"), rest[1].drop("_bucket", "_row"), alike.drop("_bucket", "_row")


def reconcile(source: DataFrame, target: DataFrame, keys: list[str], lake: dict[str, str], leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """What ``match_rows`` gives, by joining the rows of differing buckets alone."""
    some_source, some_target, alike = suspects(source, target, keys, lake, leaf_rows)
    matched = match_rows(some_source, some_target, keys, lake)
    passed = alike.select(*keys, F.lit(1).cast("long").alias("n_matches"), F.lit("").alias("mismatched"), F.lit(True).alias("row_ok"))
    return matched.unionByName(passed)
