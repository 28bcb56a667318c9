"""Folders of a table that count once they are committed.

A writer fills a folder and then adds its name to the manifest, a small file that names the folders of the table. Readers take the
newest manifest, so what a broken write left behind is never read, and a write that is repeated under its name changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedjobs.operators.lineage import _system, drop


def manifest(spark: SparkSession, path: str) -> dict:
    """version, folders (to read), done (the names of all writes, also those that a compaction merged), retired (folders that the last compaction merged)."""
    at, system = _system(spark, f"{path}/_manifest")
    versions = sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []
    versions = [v for v in versions if v.isdigit()]
    if not versions:
        return {"version": 0, "folders": [], "done": [], "retired": []}
    return json.loads(_text(spark, f"{path}/_manifest/{versions[-1]}"))


def _text(spark: SparkSession, path: str) -> str:
    at, system = _system(spark, path)
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, found: dict) -> None:
    """The next manifest, by renaming a whole file to its name; a name that another writer took first is an error."""
    found = found | {"version": found["version"] + 1}
    name = f"{found['version']:010d}"
    at, system = _system(spark, f"{path}/_manifest/.{name}.tmp")
    stream = system.create(at, True)
    stream.write(bytearray(json.dumps(found).encode()))
    stream.close()
    to, _ = _system(spark, f"{path}/_manifest/{name}")
    if system.exists(to) or not system.rename(at, to):
        raise RuntimeError(f"{path}: another writer committed version {found['version']}")


def write(df: DataFrame, path: str, name: str, partition_by: tuple[str, ...] = ()) -> bool:
    """Write ``df`` as the folder ``name`` and commit it; False, and nothing is written, if that name was committed before."""
    spark = df.sparkSession
    if name in manifest(spark, path)["done"]:
        return False
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/commit={name}")
    found = manifest(spark, path)
    _publish(spark, path, found | {"folders": [*found["folders"], name], "done": [*found["done"], name]})
    return True


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed rows, with their folder's partition columns; columns that older folders lack are null. None before the first commit."""
    folders = manifest(spark, path)["folders"]
    if not folders:
        return None
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*[f"{path}/commit={n}" for n in folders]).drop("commit")


def compact(spark: SparkSession, path: str, partition_by: tuple[str, ...], order: list[str], reduce: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Merge all folders into one, partitioned alike, of the rows that ``reduce`` leaves and in ``order``, so that files can be skipped by their least and greatest values.

    The merged folders stay for readers that are at work, until the next compaction.
    """
    before = manifest(spark, path)
    if len(before["folders"]) < 2:
        return
    name = f"merged-{before['version']:010d}"
    rows = reduce(read(spark, path))
    rows = (rows.repartition(*partition_by) if partition_by else rows).sortWithinPartitions(*partition_by, *order)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/commit={name}")
    _publish(spark, path, before | {"folders": [name], "retired": before["folders"]})
    for old in before["retired"]:
        drop(spark, f"{path}/commit={old}")
