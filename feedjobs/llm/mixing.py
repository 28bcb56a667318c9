"""Mixing sources to target weights by random order, prefix sums and exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedjobs.llm.prefix import random_key, with_prefix_sum
from feedjobs.llm.shared import written

#: What separates words: blank and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Targets per source from (source, source_size): one row a source.

    Weights are dealt in turn over the sources by code point, null last. Together the
    targets make ``share`` of all words. None is above ``most`` times its source; what
    is cut there goes to the others by weight. That level is found by ranking
    sources by cap / weight: all below the level stop at their cap. The totals are
    one short row a source, so they are ranked in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("_w", turn).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    filled, open_ = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    ranked = (
        ranked.withColumn("_budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_cap").over(filled), F.lit(0.0))) / F.sum("_w").over(open_))
        .withColumn("_fits", F.col("_level") <= F.col("_cap") / F.col("_w"))
    )
    level = F.min(F.when(F.col("_fits"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level").alias("level")))).over(everything)["level"]
    return ranked.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(level, F.col("_cap") / F.col("_w")) * F.col("_w")).alias("target"))


def mix(docs: DataFrame, *, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0, extra: list[str] | None = None) -> DataFrame:
    """How many words of each document the mix takes; one row a document.

    Returns doc_id, size, source_size, target, taken, source and the columns of ``extra``.
    In each source documents stand in the order of a hash of their id. The
    mix reads that order to the source's target, from the start again as often
    as needed, and cuts the last document so that the taken words are the target's
    whole part exactly. Order and cut depend on values only: reruns and other
    file layouts agree. Repeated rows are counted before the shuffle and dealt
    out again. A null or wordless text has size 0 and is taken 0 times; a source
    without words has target 0; a null source is one source.
    """
    extra = extra or []
    kinds = docs.select("doc_id", "source", words(F.col("text")).alias("size"), *extra).groupBy("doc_id", "source", "size", *extra).agg(F.count(F.lit(1)).alias("_n"))
    kinds = kinds.withColumn("_key", random_key("doc_id", seed=seed)).withColumn("_weight", F.col("size") * F.col("_n"))
    kinds = written(kinds, "mix")
    totals = kinds.groupBy("source").agg(F.sum("_weight").alias("source_size"))
    targets = source_targets(totals, list(weights), share, most).withColumnRenamed("source", "_s")
    placed = with_prefix_sum(kinds, "source", "_key", ["doc_id", "size", *extra], "_weight", "_before", kinds.count())
    each = placed.join(targets, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("_before") - F.col("_i") * F.col("size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    return each.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", *extra)
