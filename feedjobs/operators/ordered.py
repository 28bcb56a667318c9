"""Numbers, running sums and minima along an order, over tables and groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedjobs.operators.lineage import cut


def running(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str, *, kind: str = "sum", inclusive: bool = True) -> DataFrame:
    """Add ``out``: the sum (0 if there is none) or minimum of ``value`` over the group's rows up to this one, or before it.

    The rows are sorted into ranges of (keys, order), so a group of any size is cut into ranges that single tasks sort. A
    range's start is what the ranges before it in its group add up to: one short row a range and group. Rows that agree in keys and
    order may stand in any order.
    """
    fold = {"sum": F.sum, "min": F.min}[kind]
    placed = cut(rows.withColumn("_value", value).repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*keys, "_range").agg(fold("_value").alias("_whole")).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_r"), fold("_whole").over(before).alias("_start"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = placed.withColumn("_inside", fold("_value").over(inside)).join(starts, same)
    zero = F.lit(0).cast("long")
    made = F.coalesce("_start", zero) + F.coalesce("_inside", zero) if kind == "sum" else F.least("_start", "_inside")
    return joined.withColumn(out, made).select(*rows.columns, out)


def numbered(rows: DataFrame, order: list[str | Column], out: str = "seq") -> DataFrame:
    """Add ``out``: 0, 1, 2, ... in the given order, which must tell rows apart; how the rows lie in files and partitions does not matter.

    The rows are sorted into ranges, each row has its place in its range, and a range starts where the sum of the ranges before it ends: one row
    a partition.
    """
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the lower 33 bits count a partition's rows
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_range": F.spark_partition_id(), "_at": in_range}))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_range").withColumn(out, F.col("_start") + F.col("_at")).drop("_range", "_at", "_start")  # starts: a row a partition
