"""Distributed prefix sums: running totals inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one bucket of one group, on average; a bucket is what one task sorts.
BUCKET_ROWS = 2_000


def random_key(*columns: str, seed: int = 0) -> Column:
    """16 hex digits that depend on the columns' values and the seed alone."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.substring(F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))), 1, 16)


def with_prefix_sum(df: DataFrame, group: str, key: str, ties: list[str], weight: str, out: str, rows: int) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the rows of the group that come before this one.

    The order inside a group is ``key`` (hex digits, see random_key), then ``ties``.
    A group is cut into ranges of ``key``; ranges are summed on their own, and a
    range's offset is the sum of the ranges before it. So no task sees a whole
    group, however large. ``rows`` (the row count, to size the ranges) needs no
    exactness. Null groups count as one group.
    """
    buckets = max(1, min(1 << 16, rows // BUCKET_ROWS + 1))
    df = df.withColumn("_bucket", F.floor(F.conv(F.substring(key, 1, 6), 16, 10).cast("long") * buckets / (1 << 24)).cast("int"))
    sums = df.groupBy(group, "_bucket").agg(F.sum(weight).alias("_sum"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, "_bucket").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_bucket") == F.col("_b")))
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_bucket", "_inside", "_g", "_b", "_offset")
    )
