"""Stores of many small appended files, folded into few large ones.

A store's appends are units: a folder each, told apart by the partition columns ``unit``. ``fold``
writes a new generation, which holds every unit known so far, beside the store. A unit's folder
goes one fold later, so that a reader that found the older generation still finds the folder. Appends
during a fold stay, as they are in no generation yet. A fold that was broken off leaves no
generation, and the next one starts from the last whole one.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..sinks import publish

BYTES_PER_FILE = 128 << 20
GENERATION = "generation="


def _generations(spark: SparkSession, path: str) -> list[str]:
    """Whole generations, oldest first: Spark leaves its mark in a folder only when all files are there."""
    root = f"{path}_folded"
    named = [f"{root}/{name}" for name in publish.folders(spark, root) if name.startswith(GENERATION)]
    return [folder for folder in named if publish.exists(spark, f"{folder}/_SUCCESS")]


def _same(unit: list[str]) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in unit])


def _units(rows: DataFrame, unit: list[str]) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"_{c}") for c in unit]).distinct()


def _appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not publish.exists(spark, path):
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).option("ignoreMissingFiles", "true").parquet(path)
    return stored.select(*[f"`{c}`" for c in schema.names])


def _merged(appended: DataFrame, folder: str | None, unit: list[str]) -> DataFrame:
    """A generation with what was appended since; a unit that was appended again counts as it is now."""
    if folder is None:
        return appended
    kept = appended.sparkSession.read.schema(appended.schema).parquet(folder)
    return kept.join(_units(appended, unit), _same(unit), "left_anti").unionByName(appended)


def read_folded(spark: SparkSession, path: str, schema: str, unit: list[str]) -> DataFrame:
    """All rows of the store, folded or not. ``schema`` names the unit's columns too."""
    shape = spark.createDataFrame([], schema).schema
    # Generations are looked up first: folders that go later are in them.
    folder = next(reversed(_generations(spark, path)), None)
    return _merged(_appended(spark, path, shape), folder, unit)


def fold(spark: SparkSession, path: str, schema: str, unit: list[str], bytes_per_file: int = BYTES_PER_FILE) -> int:
    """Write the next generation and drop what the last one made needless; gives the number of folders dropped.

    One fold of a store may run at a time; readers and appends need not wait for it.
    """
    shape = spark.createDataFrame([], schema).schema
    before = _generations(spark, path)
    last = next(reversed(before), None)
    appended = _appended(spark, path, shape)
    needless = _folders_in(appended, last, unit) if last else []

    size = sum(publish.folder_bytes(spark, f) for f in (path, last) if f and publish.exists(spark, f))
    number = int(last.rsplit(GENERATION, 1)[1]) + 1 if last else 1
    rows = _merged(appended, last, unit).coalesce(max(1, -(-size // bytes_per_file)))
    rows.write.mode("overwrite").parquet(f"{path}_folded/{GENERATION}{number:010d}")

    for folder in needless:
        publish.delete(spark, folder)
    for folder in before[:-1]:
        publish.delete(spark, folder)
    return len(needless)


def _folders_in(appended: DataFrame, generation: str, unit: list[str]) -> list[str]:
    """Folders of the units whose rows, all of them and no others, the generation holds.

    A unit that was appended again with other rows is kept until a generation has those.
    """
    spark, columns = appended.sparkSession, appended.columns
    marks = [F.count("*").alias("n_rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("sum")]
    # Spark's listing of the same folders is on the driver already; their names are no more than that.
    place = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1).alias("_place")
    placed = appended.select(*columns, place).groupBy("_place", *unit).agg(*marks)
    kept = spark.read.schema(appended.schema).parquet(generation).groupBy(*[F.col(c).alias(f"_{c}") for c in unit]).agg(*marks)
    kept = kept.withColumnsRenamed({"n_rows": "_n_rows", "sum": "_sum"})
    return sorted(r[0] for r in placed.join(kept, _same([*unit, "n_rows", "sum"]), "left_semi").select("_place").collect())
