"""File sources: inbound CSV drops, landing files, delimited registry and audit text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def read_csv_drop(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files with a header, plain or gzip, from a drop folder. The schema is given, not inferred."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", multiLine=False)


def ingest_csv(spark: SparkSession, drop: str, schema: str, table_path: str) -> DataFrame:
    """Replace a Parquet table by what lies in the drop folder."""
    read_csv_drop(spark, drop, schema).write.mode("overwrite").parquet(table_path)
    return spark.read.parquet(table_path)


def read_delimited(spark: SparkSession, path: str, schema: str, separator: str = "|") -> DataFrame:
    """Registry or audit rows kept as delimited text."""
    return spark.read.schema(schema).csv(path, sep=separator, nullValue="\\N")


def land(df: DataFrame, path: str) -> DataFrame:
    """Write extracted rows to the landing area as they come, without a shuffle, and read them back."""
    df.write.mode("overwrite").parquet(path)
    return read_landing(df.sparkSession, path)


def land_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Land the rows and count what the extract read, both in the one pass over the source."""
    seen = Observation()
    landed = land(df.observe(seen, F.count(F.lit(1)).alias("n")), path)
    return landed, seen.get["n"]


def read_landing(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Landing rows with the schema of the files themselves.

    ``avro`` works where the session has Spark's Avro package.
    """
    return spark.read.format(kind).load(path)
