"""Session settings and the shared folder that written intermediates live in."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every load relies on. They can all be set on a running session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Load stamps such as 20160101164756 are labels, not numbers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}

_local_shared: dict[str, str] = {}
_scratched: dict[str, list[str]] = {}


def build(app: str = "lakeload", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


BYTES_PER_SHUFFLE_PARTITION = 256 << 20
# 200,000 partitions of 256 MB are 51 TB; at 100 TB one is 512 MB, which still fits an executor. More is the caller's to allow.
MOST_SHUFFLE_PARTITIONS = 200_000


def size_shuffles(df: DataFrame, per_partition: int = BYTES_PER_SHUFFLE_PARTITION, most: int = MOST_SHUFFLE_PARTITIONS) -> int:
    """Raise the number of shuffle partitions to fit what ``df`` reads; it is never lowered.

    Adaptive execution merges partitions that turn out small but does not add any, so the
    default of 200 would put half a terabyte of a 100 TB table into each. Sources that do not
    know their size, such as JDBC tables, leave the setting as it is.
    """
    conf = df.sparkSession.conf
    current = int(conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        return current
    wanted = -(-size // per_partition)
    if wanted > most:
        logging.getLogger(__name__).warning("%d shuffle partitions wanted for %d bytes, %d allowed", wanted, size, most)
        wanted = most
    if wanted > current:
        conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` as the session names it.

    A local session without that setting gets one temporary folder. A cluster session
    without it is an error, because a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if app not in _local_shared:
        _local_shared[app] = tempfile.mkdtemp(prefix="lakeload-")
    return _local_shared[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _scratched.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the scratch folders this session has made, once its results are stored elsewhere; gives their number."""
    paths = _scratched.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def discard(spark: SparkSession, *settled: DataFrame) -> None:
    """Delete what ``settle`` wrote for these, once the steps that read it have been written themselves."""
    known = _scratched.get(spark.sparkContext.applicationId, [])
    files = [f for df in settled for f in df.inputFiles()]
    # The last part of a scratch path occurs once.
    for path in [p for p in known if any(f"/{p.rsplit('/', 1)[-1]}/" in f for f in files)]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        known.remove(path)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and fixes the rows, so two readers of the result do not
    compute it twice and a lost executor does not restart the whole chain.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; later shuffles are sized for it."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    size_shuffles(df)
    return df
