"""A Bloom filter of a batch's keys, as a short table that a large one is filtered by before anything of it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits are 2 to the power of this at most: 2**18 rows of 64 bits, about 4 MB, whatever the batch holds.
MOST_BITS = 24
#: Bits for each key, below that bound; one key in PER_KEY that is not in the batch passes.
PER_KEY = 16


def key_filter(batch: DataFrame, key: str, keys: int) -> tuple[DataFrame, int]:
    """(_word, _bits), bits: the bits of the batch's keys. ``keys``: about how many there are, which decides how many bits there are and nothing else."""
    bits = max(6, min(MOST_BITS, (PER_KEY * max(1, keys) - 1).bit_length()))
    rows = batch.where(F.col(key).isNotNull()).select(_place(F.col(key), bits).alias("_h")).select(F.shiftright("_h", 6).alias("_word"), _bit(F.col("_h")).alias("_bit"))
    return rows.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), bits


def maybe(rows: DataFrame, key: str, made: tuple[DataFrame, int]) -> DataFrame:
    """The rows whose key may be one of the filter's, and some others; null keys are among these. The filter is broadcast, as it has 2**MOST_BITS / 64 rows at most."""
    words, bits = made
    met = rows.withColumn("_h", _place(F.col(key), bits)).withColumn("_word", F.shiftright("_h", 6)).join(F.broadcast(words), "_word")
    return met.where(F.col("_bits").bitwiseAND(_bit(F.col("_h"))) != 0).select(rows.columns)


def _place(key: Column, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1))


def _bit(place: Column) -> Column:
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", one, place.bitwiseAND(F.lit(63)).cast("int"))
