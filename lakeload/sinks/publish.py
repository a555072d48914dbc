"""Stage, merge, swap and restore the published copies of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

PARTITION = "incr_ingest_timestamp"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def folder_bytes(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def rename(spark: SparkSession, old: str, new: str) -> None:
    if not _fs(spark, old).rename(_path(spark, old), _path(spark, new)):
        raise OSError(f"could not rename {old} to {new}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a folder; none where it is not there."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)) if s.isDirectory())


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def _with_partition(schema: T.StructType) -> T.StructType:
    """Partition labels last, as text: 20160101164756 must not come back as a number."""
    plain = [f for f in schema.fields if f.name != PARTITION]
    return T.StructType([*plain, T.StructField(PARTITION, T.StringType())])


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(_with_partition(schema)).parquet(path)


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Recreate the stage table. All rows carry one load label, so no shuffle is needed."""
    df.write.mode("overwrite").partitionBy(PARTITION).parquet(path)
    return read_partitioned(df.sparkSession, path, df.schema)


def merge_partition(df: DataFrame, live: str) -> DataFrame:
    """Write the rows' partitions into the live table and leave every other partition alone.

    Running the same load again replaces its partition, so a retry changes nothing.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(live)
    )
    return read_partitioned(df.sparkSession, live, df.schema)


def partition_folder(stamp: str) -> str:
    return f"{PARTITION}={stamp}"


def move_partition(spark: SparkSession, stage: str, live: str, stamp: str) -> None:
    """Publish a staged load partition by renaming its folder into the live table: nothing is written again.

    A load that is repeated replaces its partition. The one it replaces waits beside the live
    folder until the new one is in place; a move broken off at any rename can be repeated.
    """
    name = partition_folder(stamp)
    staged, target, aside = f"{stage}/{name}", f"{live}/{name}", f"{live}_replaced/{name}"
    if not exists(spark, staged):
        if exists(spark, aside) and not exists(spark, target):
            rename(spark, aside, target)
        raise FileNotFoundError(staged)
    if exists(spark, target):
        # What waits there is older than what is live: a move broken off before its last step.
        delete(spark, aside)
        make_folder(spark, f"{live}_replaced")
        rename(spark, target, aside)
    make_folder(spark, live)
    try:
        rename(spark, staged, target)
    except Exception:
        if exists(spark, aside) and not exists(spark, target):
            rename(spark, aside, target)
        raise
    delete(spark, aside)


def attach_partition(spark: SparkSession, table: str, stamp: str, place: str) -> None:
    """Publish a written load partition where it lies, by naming its folder in the table.

    For stores where a rename copies. Readers of the table see all of the load or nothing; a
    repeated load names its new folder in place of the old one, in one statement.
    """
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({PARTITION}='{stamp}') LOCATION '{place}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({PARTITION}='{stamp}') SET LOCATION '{place}'")
    spark.catalog.refreshTable(table)


def swap(spark: SparkSession, stage: str, live: str, backup: str) -> None:
    """Stage becomes live and live becomes the backup.

    The superseded backup goes only after the new live folder is in place, and a failed
    rename puts the old live folder back. A swap broken off half-way can simply be repeated.
    """
    if not exists(spark, stage):
        raise FileNotFoundError(stage)
    superseded = f"{backup}_superseded"
    if exists(spark, superseded):
        # Left by a swap that was broken off: the backup if there is no newer one.
        if exists(spark, backup):
            delete(spark, superseded)
        else:
            rename(spark, superseded, backup)
    if exists(spark, live):
        if exists(spark, backup):
            rename(spark, backup, superseded)
        rename(spark, live, backup)
    try:
        rename(spark, stage, live)
    except Exception:
        if not exists(spark, live) and exists(spark, backup):
            rename(spark, backup, live)
        if exists(spark, superseded):
            rename(spark, superseded, backup)
        raise
    if exists(spark, superseded):
        delete(spark, superseded)


def restore(spark: SparkSession, live: str, backup: str) -> None:
    """Put the backup back as the live folder; the rejected live folder takes its place."""
    if not exists(spark, backup):
        raise FileNotFoundError(backup)
    rejected = f"{live}_rejected"
    if exists(spark, live):
        rename(spark, live, rejected)
    try:
        rename(spark, backup, live)
    except Exception:
        if not exists(spark, live) and exists(spark, rejected):
            rename(spark, rejected, live)
        raise
    if exists(spark, rejected):
        rename(spark, rejected, backup)


def point_live(spark: SparkSession, view: str, version: str, path: str, schema: T.StructType) -> DataFrame:
    """Publish by pointing: register the stage folder as a version of its own and aim the view at it.

    Nothing is moved, which suits stores where a rename copies, and readers see either the
    old version or the new one. Aim the view at an earlier version to take a load back.
    """
    register_live(spark, version, path, schema)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {version}")
    return spark.table(view)


def columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_live(spark: SparkSession, table: str, path: str, schema: T.StructType) -> DataFrame:
    """External partitioned table over the live folder, with its partitions discovered.

    A table that already has this place and these columns stays, so that readers always find
    one; its partitions are brought up to date.
    """
    if _is_registered(spark, table, path, schema):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        return spark.table(table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns_ddl(_with_partition(schema))}) USING parquet "
        f"PARTITIONED BY ({PARTITION}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def _is_registered(spark: SparkSession, table: str, path: str, schema: T.StructType) -> bool:
    if not spark.catalog.tableExists(table):
        return False
    wanted = [(f.name, f.dataType) for f in _with_partition(schema).fields]
    if [(f.name, f.dataType) for f in spark.table(table).schema.fields] != wanted:
        return False
    place = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").select("data_type").first()
    return place is not None and _path(spark, place[0]).toUri().getPath() == _path(spark, path).toUri().getPath()


def add_partition(spark: SparkSession, table: str, stamp: str) -> None:
    """Register the one partition a load has written; no other is looked at."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({PARTITION}='{stamp}')")


def register_plain(spark: SparkSession, table: str, path: str) -> DataFrame:
    """External table over a folder or file of Parquet, without a copy of its rows."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    return spark.table(table)


def drop_partition(spark: SparkSession, table: str, stamp: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PARTITION}='{stamp}')")


def analyze(spark: SparkSession, table: str) -> tuple[int, int]:
    """Compute a table's statistics; gives bytes and rows."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    line = (
        spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").select("data_type").first()[0]
    )
    size, rows = line.split(", ")
    return int(size.split(" ")[0]), int(rows.split(" ")[0])


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget a clone once it is exported; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def partition_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per table folder and load partition below ``root``.

    From the file listing alone: no file is opened, and one listing serves every table.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )
    base = _fs(spark, root).makeQualified(_path(spark, root)).toString()
    inside = F.expr(f"substring(path, {len(base) + 2})")
    partition = f"(?:^|/){PARTITION}=([^/]+)/"
    listed = files.select(
        F.regexp_extract(inside, f"^(.*?){partition}", 1).alias("directory"),
        F.regexp_extract(inside, partition, 1).alias(PARTITION),
        "length",
    )
    return listed.groupBy("directory", PARTITION).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def newest_partition_size(sizes: DataFrame) -> DataFrame:
    """Bytes of each folder's newest load: labels compare by their time, full load or increment."""
    stamp = F.regexp_extract(PARTITION, "([0-9]{14})$", 1)
    return sizes.groupBy("directory").agg(
        F.max_by(PARTITION, stamp).alias(PARTITION), F.max_by("n_bytes", stamp).alias("n_bytes")
    )
