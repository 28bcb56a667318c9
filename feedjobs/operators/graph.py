"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedjobs.operators.lineage import replaced


def components(edges: DataFrame) -> DataFrame:
    """node, root over undirected edges (a, b): the least node that each can reach. Nodes without an edge to another are not there.

    A round hangs the greater neighbours of every node, then its smaller ones, on the least of them (the large-star and small-star steps of Kiveris et al., 2014), so
    rounds grow with the logarithm of the longest chain. Each round is a table that takes the last one's place; only a count and a checksum, taken as it is written, come to the driver.
    """
    made: list[str] = []
    now, seen = _written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), made)
    before = None
    while seen != before and seen[0]:
        before = seen
        now, seen = _written(star_round(now), made)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def star_round(edges: DataFrame) -> DataFrame:
    around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    lower = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lower.select("a", F.col("m").alias("b")))
    return small.where("a <> b").distinct()


def _written(edges: DataFrame, made: list[str]) -> tuple[DataFrame, tuple]:
    mark = Observation()
    watched = edges.observe(mark, F.count(F.lit(1)).alias("edges"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
    return replaced(watched, made), tuple(mark.get[c] for c in ("edges", "sum"))
