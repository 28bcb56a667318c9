"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from feedjobs.operators import lineage
from feedjobs.operators.lineage import shared_dir

Made = TypeVar("Made")

_open: list[list[str]] = []
_kept: dict[Hashable, object] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage like ``checkpoint()`` does, and later reads prune
    columns. The files go when the application ends, or at the end of the step they belong to (see step).
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/feedjobs-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _system(spark, path)[1].deleteOnExit(_system(spark, path)[0])
    if _open:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that not all their texts are Python strings at once."""
    _kept.clear()
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        release()


def kept(key: Hashable, make: Callable[[], Made]) -> Made:
    """What a Python worker keeps from task to task; tasks that ask for another, or read slices, let it go."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Give freed memory back at the end of a task, as the worker lives on beside those of later steps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim:
        trim(0)


def _system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@contextmanager
def step(spark: SparkSession) -> Iterator[list[str]]:
    """What is written inside goes at the end, but for the paths that are taken out of the list."""
    _open.append([])
    try:
        with lineage.step(spark):
            yield _open[-1]
    finally:
        for path in _open.pop():
            drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    at, system = _system(spark, path)
    system.delete(at, True)
