"""Upserts into a lake folder that rewrite only the files that hold a changed key.

Which files those are is itself a join: the folder's keys, each with the file it stands in,
against the keys of the changes. Keys alone are read, only row groups whose range meets the
changes' are opened, and a set of changes that is small enough to broadcast moves no row of
the folder. All other files stay as they are, untouched by reader or writer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.incremental import mark_literal
from ..operators.merge import one_per_key
from ..session import settle, size_shuffles
from . import publish

NEXT, REPLACED = "_next", "_replaced"
RANGED = ("tinyint", "smallint", "int", "bigint", "string", "date", "timestamp", "timestamp_ntz", "decimal")


@dataclass(frozen=True)
class Rewrite:
    """Files of the folder that were replaced and that stayed, and the rows that were written."""

    replaced: int
    kept: int
    rows: int


def _within(folder: DataFrame, keys: list[str], changes: DataFrame) -> DataFrame:
    """Rows whose keys lie in the changes' ranges; the bounds are literals, so the scan skips by them."""
    kinds = dict(folder.dtypes)
    ranged = [k for k in keys if kinds[k].startswith(RANGED)]
    if not ranged:
        return folder
    bounds = changes.agg(*[f(k).alias(f"{n}_{k}") for k in ranged for n, f in (("low", F.min), ("high", F.max))]).first()
    for k in ranged:
        if bounds[f"low_{k}"] is None:
            return folder.limit(0)  # every key has a NULL and so is nobody's
        folder = folder.where(F.col(k).between(mark_literal(bounds[f"low_{k}"]), mark_literal(bounds[f"high_{k}"])))
    return folder


def files_with(folder: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The files of ``folder`` that hold a key of ``changes``, and how many such rows each has."""
    wanted = changes.select(*keys).distinct()
    placed = _within(folder.select(*keys, F.col("_metadata.file_path").alias("file_path")), keys, wanted)
    return placed.join(wanted, keys, "left_semi").groupBy("file_path").agg(F.count("*").alias("n_rows"))


def rewrite_touched(
    spark: SparkSession, target: str, changes: DataFrame, keys: list[str], insert: bool = True, partition_by: tuple[str, ...] = (), newest: str | None = None
) -> Rewrite:
    """Replace the rows of ``target`` whose keys ``changes`` hold and, with ``insert``, add the others.

    Of a key that is repeated in the changes one row counts, that of the greatest ``newest``,
    else of the greatest values. A NULL in a key matches no row. New files are written aside
    and then moved in; a call that was broken off is finished or taken back by the next one,
    or by ``finish``. While files are moved a reader can see a row in both forms.
    """
    if not keys:
        raise ValueError("an upsert needs its update key")
    finish(spark, target)
    folder = spark.read.parquet(target)
    size_shuffles(folder)
    new = settle(one_per_key(changes.select(*folder.columns), keys, newest), "changes")
    touched = [_plain(spark, r["file_path"]) for r in files_with(folder, new, keys).select("file_path").collect()]
    before = _files(spark, target)
    old = spark.read.schema(folder.schema).option("basePath", target).parquet(*touched) if touched else folder.limit(0)
    changed = new if insert else new.join(old.select(*keys), keys, "left_semi")
    rows = old.join(new.select(*keys), keys, "left_anti").unionByName(changed)
    # Neighbouring keys stay in one file, so that later changes are found in few.
    rows = rows.repartitionByRange(max(1, len(touched)), *keys).sortWithinPartitions(*keys)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{target}/{NEXT}")
    written = spark.read.schema(folder.schema).parquet(f"{target}/{NEXT}").count()
    _note(spark, f"{target}/{REPLACED}", [_relative(spark, target, path) for path in touched])
    finish(spark, target)
    return Rewrite(len(touched), len(before) - len(touched), written)


def finish(spark: SparkSession, target: str) -> bool:
    """End a rewrite that was broken off: complete it if its files were all written, else drop what there is of it."""
    aside, note = f"{target}/{NEXT}", f"{target}/{REPLACED}"
    if not publish.exists(spark, note):
        if publish.exists(spark, aside):
            publish.delete(spark, aside)
        return False
    for path in _files(spark, aside) if publish.exists(spark, aside) else []:
        place = f"{target}/{_relative(spark, aside, path)}"
        publish.make_folder(spark, place.rsplit("/", 1)[0])
        publish.rename(spark, path, place)
    for name in (r.value for r in spark.read.text(note).collect()):
        publish.delete(spark, f"{target}/{name}")
    publish.delete(spark, aside)
    publish.delete(spark, note)
    return True


def _plain(spark: SparkSession, uri: str) -> str:
    """The path of a file as scans name it, without escapes."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def _files(spark: SparkSession, folder: str) -> list[str]:
    """The data files below a folder, as a reader sees them."""
    found, walk = [], publish._fs(spark, folder).listFiles(publish._path(spark, folder), True)
    while walk.hasNext():
        path = walk.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in _relative(spark, folder, path).split("/")):
            found.append(path)
    return found


def _relative(spark: SparkSession, folder: str, path: str) -> str:
    base = publish._fs(spark, folder).makeQualified(publish._path(spark, folder)).toString().rstrip("/")
    full = publish._fs(spark, path).makeQualified(publish._path(spark, path)).toString()
    if not full.startswith(f"{base}/"):
        raise ValueError(f"{full} is not below {base}")
    return full[len(base) + 1 :]


def _note(spark: SparkSession, path: str, lines: list[str]) -> None:
    """Write the list of replaced files; it is there whole or not at all. Readers pass over a folder of that name."""
    publish.delete(spark, f"{path}.part")
    out = publish._fs(spark, path).create(publish._path(spark, f"{path}.part/list"), True)
    try:
        for line in lines:
            out.write(bytearray(f"{line}\n".encode()))
    finally:
        out.close()
    publish.rename(spark, f"{path}.part", path)
