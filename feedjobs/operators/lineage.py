"""Cutting lineage by tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_open: list[list[str]] = []
_roots: dict[tuple[str, str], str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, to which checkpoint() writes too. A local master may set a folder of its own by setCheckpointDir."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new folder in the application's own in the shared one, which goes at the end of the step it belongs to (see step) or of the application."""
    own = spark.sparkContext.applicationId, shared_dir(spark)
    if own not in _roots:
        _roots[own] = f"{own[1]}/feedjobs-{uuid.uuid4().hex}"
        at, system = _system(spark, _roots[own])
        system.mkdirs(at)
        system.deleteOnExit(at)  # only of what is there
    path = f"{_roots[own]}/{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: a short plan, of which no part is computed again when an executor is lost.

    The table is there for every frame made from it, until the step or the application ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def step(spark: SparkSession) -> Iterator[None]:
    """Tables that are made inside go at the end. What is lazy must be written before."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            drop(spark, path)


def replaced(df: DataFrame, made: list[str]) -> DataFrame:
    """``df`` as a table; the tables named in ``made`` go, and this one is named there instead. For rounds, each of which needs the one before it only."""
    spark, before = df.sparkSession, list(made)
    path = scratch(spark)
    df.write.parquet(path)
    made[:] = [path]
    for old in before:
        drop(spark, old)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    at, system = _system(spark, path)
    system.delete(at, True)
    for paths in _open:
        if path in paths:
            paths.remove(path)


def _system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
