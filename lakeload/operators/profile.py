"""Row counts, split ranges, and which column to split a table on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.literals import find
from ..session import settle

WHOLE = ("tinyint", "smallint", "int", "bigint")
NO_SPLIT = "no-split"
LENGTH_IF_EMPTY = 38


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def ranges(low: int, high: int, n: int) -> list[tuple[int, int]]:
    """``n`` equal whole-number ranges that cover low..high, both ends included."""
    width = -(-(high - low + 1) // n)
    return [(low + i * width, low + (i + 1) * width - 1) for i in range(n)]


def split_bounds(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ranges parallel readers would take, and how many rows each of them holds."""
    if column not in df.columns:
        raise ValueError(f"split column {column} is not one of: {', '.join(df.columns)}")
    low, high = df.agg(F.min(column), F.max(column)).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "range_no int, lower bigint, upper bigint, n_rows bigint")
    parts = ranges(low, high, n)
    width = parts[0][1] - parts[0][0] + 1
    number = F.expr(f"CAST((`{column}` - {low}) div {width} AS INT)")
    counted = df.where(F.col(column).isNotNull()).groupBy(number.alias("range_no")).agg(F.count("*").alias("n"))
    listed = spark.range(n).select(
        F.col("id").cast("int").alias("range_no"),
        (F.col("id") * width + low).alias("lower"),
        ((F.col("id") + 1) * width + low - 1).alias("upper"),
    )
    return listed.join(counted, "range_no", "left").select(
        "range_no", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


def splittable(df: DataFrame) -> list[str]:
    """The columns a range reader can take: whole numbers, decimals, dates and times."""
    return [c for c, kind in df.dtypes if kind in WHOLE or kind.startswith(("decimal", "date", "timestamp"))]


def _value(name: str, kind: str, plain: bool) -> Column:
    """A column's value in the one type all profiled columns share: a long where that holds them all, else text."""
    col = F.col(name)
    if not plain:
        return col.cast("string")
    if kind in WHOLE:
        return col.cast("bigint")
    return F.unix_micros(col.cast("timestamp"))


def split_quality(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: how many groups its values form and how evenly rows spread over them.

    Whole numbers and times are counted as longs, which is what is shuffled; one decimal or
    text column among ``columns`` makes all of them text.

    All columns are profiled by one job: unpivot, count per (column, value), then one row
    per column from exact whole-number sums. NULL is a group of size 0.
    """
    columns = columns or df.columns
    place = {c: i for i, c in enumerate(columns, start=1)}
    kinds = dict(df.dtypes)
    plain = all(kinds[c] in WHOLE or kinds[c].startswith(("date", "timestamp")) for c in columns)
    values = df.select(*[_value(c, kinds[c], plain).alias(c) for c in columns])
    long = values.unpivot([], columns, "column_name", "value")
    sizes = long.groupBy("column_name", "value").agg(F.count("value").cast("decimal(38,0)").alias("size"))
    sums = sizes.groupBy("column_name").agg(
        F.count("*").alias("n_groups"),
        F.sum("size").cast("decimal(38,0)").alias("total"),
        F.sum(F.expr("CAST(size * size AS DECIMAL(38,0))")).cast("decimal(38,0)").alias("squares"),
    )
    spread = F.expr("CAST(CAST(n_groups AS DECIMAL(38,0)) * squares AS DECIMAL(38,0)) - CAST(total * total AS DECIMAL(38,0))")
    return sums.select(
        find(place, F.col("column_name")).alias("ordinal"),
        "column_name",
        "n_groups",
        (F.sqrt(spread.cast("double")) / F.col("n_groups")).alias("group_stddev"),
    )


def split_choice(quality: DataFrame, tables: list[tuple[int, str | None, str]]) -> DataFrame:
    """The split column for each (readers, primary key, vendor), from one pass over the profile.

    The primary key if there is one, else the evenest column with more groups than readers,
    NULL if none fits. Oracle reads by row ranges and needs none.
    """

    def pick(readers: int, key: str | None, vendor: str) -> Column:
        if vendor == "oracle" or key:
            return F.lit(None if vendor == "oracle" else key).cast("string")
        order = F.when(F.col("n_groups") > readers, F.struct("group_stddev", "ordinal"))
        return F.min_by("column_name", order)

    rows = [
        F.struct(
            F.lit(readers).alias("readers"),
            F.lit(vendor).alias("vendor"),
            F.lit(key).cast("string").alias("primary_key"),
            pick(readers, key, vendor).alias("split_column"),
        )
        for readers, key, vendor in tables
    ]
    return quality.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def max_lengths(tables: dict[str, DataFrame]) -> DataFrame:
    """Longest text form of every column, one scan per table; 38 where a column is all NULL."""
    found = []
    for name, df in tables.items():
        longest = df.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in df.columns])
        long = longest.unpivot([], df.columns, "column_name", "longest")
        found.append(
            long.select(
                F.lit(name).alias("table_name"),
                "column_name",
                F.coalesce("longest", F.lit(LENGTH_IF_EMPTY)).alias("max_length"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def first_key_column(indexes: DataFrame, index_columns: DataFrame, kinds: tuple[str, ...] = ("P",)) -> DataFrame:
    """First column, by position, of each table's primary key."""
    keys = indexes.where(F.col("index_kind").isin(*kinds)).select("table_name", "index_name")
    return (
        keys.join(index_columns, ["table_name", "index_name"])
        .groupBy("table_name")
        .agg(F.min_by("column_name", F.struct("position", "index_name")).alias("split_column"))
    )


# Column types a key may have where the vendor only keeps cardinalities.
CARDINALITY_TYPES = ("CHAR", "INTEGER", "BIGINT", "LONGVAR", "SMALLINT", "ROWID", "VARCHAR")


def most_distinct_column(columns: DataFrame) -> DataFrame:
    """Per table the non-null column with the highest recorded cardinality, the leftmost of equals."""
    usable = columns.where((F.col("nullable") == "N") & F.upper("data_type").isin(*CARDINALITY_TYPES))
    return usable.groupBy("table_name").agg(
        F.min_by("column_name", F.struct(-F.col("cardinality"), F.col("ordinal"))).alias("split_column")
    )


# Index kinds and numbers in the order a split column is taken from them.
INDEX_RANKS = {("Q", 1): 1, ("P", 1): 2, ("Q", 2): 3, ("P", 2): 4, ("K", None): 5, ("S", None): 6}
OTHER_INDEX = 7


def index_rank(kind: Column, number: Column) -> Column:
    ranked = F.lit(OTHER_INDEX)
    for (k, n), rank in INDEX_RANKS.items():
        match = kind == k
        ranked = F.when(match if n is None else match & (number == n), F.lit(rank)).otherwise(ranked)
    return ranked


def best_index_column(indices: DataFrame, first_ints: DataFrame) -> DataFrame:
    """Per table the column of the best-ranked index; unranked tables take their first integer."""
    ranked = indices.withColumn("index_rank", index_rank(F.col("index_type"), F.col("index_number")))
    best = ranked.groupBy("table_name").agg(
        F.min("index_rank").alias("index_rank"),
        F.min_by("column_name", F.struct("index_rank", "column_name")).alias("index_column"),
    )
    ints = first_ints.groupBy("table_name").agg(F.min_by("column_name", "ordinal").alias("int_column"))
    return best.join(ints, "table_name", "left").select(
        "table_name",
        "index_rank",
        F.when(F.col("index_rank") < OTHER_INDEX, F.col("index_column"))
        .otherwise(F.coalesce("int_column", F.lit(NO_SPLIT)))
        .alias("split_column"),
    )


def first_of_type(columns: DataFrame, keys: list[str]) -> DataFrame:
    """The leftmost column of each type: what rank() = 1 by ordinal keeps, as a mergeable minimum."""
    return columns.groupBy(*keys).agg(
        F.min("ordinal").alias("ordinal"), F.min_by("column_name", "ordinal").alias("column_name")
    )


def first_integer(columns: DataFrame, types: DataFrame, tables: DataFrame) -> DataFrame:
    """Leftmost integer column of each table, from the column, type and table dictionaries."""
    ints = types.where(F.col("type_name").contains("int"))
    joined = columns.join(ints, "type_id").join(tables, "object_id")
    return joined.groupBy("table_name").agg(
        F.min("column_id").alias("column_id"), F.min_by("column_name", "column_id").alias("split_column")
    )


def unique_or_first_integer(columns: DataFrame, unique_columns: DataFrame) -> DataFrame:
    """Per table an integer column of a unique index, else the first integer column."""
    marked = columns.join(
        unique_columns.select("table_name", "column_name", F.lit(0).alias("not_unique")).distinct(),
        ["table_name", "column_name"],
        "left",
    )
    return marked.groupBy("table_name").agg(
        F.min_by("column_name", F.struct(F.coalesce("not_unique", F.lit(1)), F.col("ordinal"))).alias("split_column")
    )


def by_rules(tables: DataFrame, rules: list[DataFrame]) -> DataFrame:
    """Each table's split column by the first rule that gives one, for all tables at once."""
    given = [r.select("table_name", "split_column", F.lit(i).alias("rule")) for i, r in enumerate(rules, start=1)]
    found = reduce(DataFrame.unionByName, given).where(F.col("split_column").isNotNull())
    first = found.groupBy("table_name").agg(F.min("rule").alias("rule"), F.min_by("split_column", "rule").alias("split_column"))
    return tables.select("table_name").join(first, "table_name", "left").select(
        "table_name", F.coalesce("split_column", F.lit(NO_SPLIT)).alias("split_column"), F.coalesce("rule", F.lit(0)).alias("rule")
    )


# Sketches of the same profile: what they say is within known bands, and no value is shuffled.

#: Counters of a column's sketch, its registers (as a power of two), and how many deviations its bands are wide.
COUNTERS, REGISTERS, DEVIATIONS = 2048, 12, 4.0


def sketched_quality(df: DataFrame, columns: list[str] | None = None, counters: int = COUNTERS) -> DataFrame:
    """Bands for ``split_quality``: per column ``groups_low`` to ``groups_high`` and ``stddev_low`` to ``stddev_high``.

    The number of groups comes from a HyperLogLog sketch. The sum of squared group sizes comes
    from a tug-of-war sketch: every value's hash picks a counter and a sign, rows are added up
    with their sign, and the counters' squares add up to that sum, give or take its
    sqrt(2 / counters). What leaves a task is one row per column and counter. Bands are
    DEVIATIONS standard deviations wide on either side; the squares are also never under what
    even groups would give. A column of NULLs alone has one group and no spread.
    """
    columns = columns or df.columns
    names = {f"_{i}": c for i, c in enumerate(columns, start=1)}
    hashed = df.select(*[F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(i), c)).alias(f"_{i}") for i, c in enumerate(columns, start=1)])
    drawn = hashed.unpivot([], list(names), "column", "h").where("h IS NOT NULL")
    tug = drawn.groupBy("column", F.pmod("h", F.lit(counters)).alias("counter")).agg(
        F.sum(F.when(F.shiftright("h", 40).bitwiseAND(1) == 0, 1).otherwise(-1)).cast("double").alias("pull")
    )
    squares = tug.groupBy("column").agg(F.sum(F.col("pull") * F.col("pull")).alias("squares"))
    counted = hashed.agg(
        F.count("*").alias("n_rows"),
        *[F.count(k).alias(f"n{k}") for k in names],
        *[F.hll_sketch_estimate(F.hll_sketch_agg(k, REGISTERS)).alias(f"g{k}") for k in names],
    )
    each = F.array(*[F.struct(F.lit(k).alias("column"), F.lit(c).alias("column_name"), F.lit(int(k[1:])).alias("ordinal"), F.col(f"n{k}").alias("total"), F.col(f"g{k}").alias("seen")) for k, c in names.items()])
    rows = counted.select("n_rows", F.explode(each).alias("e")).select("n_rows", "e.*").join(squares, "column", "left")
    # NULL is a group of size 0.
    null = F.when(F.col("n_rows") > F.col("total"), 1).otherwise(0)
    off, wide = DEVIATIONS * 1.04 / (1 << REGISTERS) ** 0.5, DEVIATIONS * (2.0 / counters) ** 0.5
    low = F.greatest(F.ceil(F.col("seen") / (1 + off)), F.least("seen", F.lit(1))) + null
    high = F.least(F.floor(F.col("seen") / (1 - off)), F.col("total")) + null
    t = F.col("total").cast("double")
    rows = rows.select("ordinal", "column_name", "total", low.alias("groups_low"), high.alias("groups_high"), F.coalesce("squares", F.lit(0.0)).alias("_f"), t.alias("_t"))
    variance = lambda f, n: F.greatest(f / n - (F.col("_t") / n) * (F.col("_t") / n), F.lit(0.0))
    ends = F.col("groups_low"), F.greatest("groups_high", "groups_low")
    small, large = F.greatest(F.col("_f") * (1 - wide), F.col("_t")), F.greatest(F.col("_f") * (1 + wide), F.col("_t"))
    # At a given sum of squares the variance is greatest at 2 t² / f groups, if that many are possible.
    top = F.least(F.greatest(2 * F.col("_t") * F.col("_t") / large, ends[0]), ends[1])
    none = F.col("total") == 0
    return rows.select(
        "ordinal",
        "column_name",
        F.col("groups_low").cast("long").alias("groups_low"),
        ends[1].cast("long").alias("groups_high"),
        F.when(none, 0.0).otherwise(F.sqrt(F.least(variance(small, ends[0]), variance(small, ends[1])))).alias("stddev_low"),
        F.when(none, 0.0).otherwise(F.sqrt(F.greatest(variance(large, ends[0]), variance(large, ends[1]), variance(large, top)))).alias("stddev_high"),
    )


def contenders(bands: DataFrame, readers: int) -> list[str]:
    """Columns that may be the evenest with more groups than readers. One row per column reaches the driver."""
    possible = bands.where(F.col("groups_high") > readers)
    best = possible.agg(F.min(F.when(F.col("groups_low") > readers, F.col("stddev_high")))).first()[0]
    if best is not None:
        possible = possible.where(F.col("stddev_low") <= best)
    return [r["column_name"] for r in possible.orderBy("ordinal").select("column_name").collect()]


def sketched_choice(df: DataFrame, tables: list[tuple[int, str | None, str]], columns: list[str] | None = None) -> DataFrame:
    """``split_choice`` of the exact profile, which is taken of the columns alone that the sketches cannot tell apart."""
    columns = columns or splittable(df)
    asked = sorted({readers for readers, key, vendor in tables if not key and vendor != "oracle"})
    wanted: set[str] = set()
    if asked and columns:
        bands = settle(sketched_quality(df, columns), "bands")
        for readers in asked:
            wanted |= set(contenders(bands, readers))
    named = [c for c in columns if c in wanted]
    place = {c: i for i, c in enumerate(columns, start=1)}
    if not named:
        kind = "ordinal int, column_name string, n_groups bigint, group_stddev double"
        return split_choice(df.sparkSession.createDataFrame([], kind), tables)
    exact = split_quality(df, named)
    return split_choice(exact.withColumn("ordinal", find(place, F.col("column_name"))), tables)
