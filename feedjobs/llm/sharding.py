"""Sharding by jump consistent hashing (Lamping and Veach, 2014)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedjobs.llm.prefix import random_key, with_prefix_sum
from feedjobs.llm.shared import written


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, for all keys at once."""
    state, bucket = keys.astype(np.uint64), np.zeros(len(keys), np.int64)
    ahead = np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        bucket[live] = ahead[live]
        with np.errstate(over="ignore"):
            state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1
        ahead[live] = ((bucket[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        live = live[ahead[live] < shards]
    return bucket


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of an integer key; a null key counts as 0."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf(T.IntegerType())
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards).astype(np.int32))

    return place(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def shard_documents(docs: DataFrame, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Place every document; one row a document.

    Returns doc_id, size, text_crc32, law (``key``), shard, slot, grown_shard.
    The id and the number of shards alone decide the shard: with one more shard a
    document stays or moves to the new one. ``slot`` counts from 0 in each shard,
    in an order that depends on the values only, so reruns and other file layouts
    agree. Repeated rows each get a slot; they are counted before the shuffle, so a
    hot id is one row per task. A null text has size 1 and a null checksum, an
    empty one size 1 and checksum 0; a null id hashes as 0. Other columns are
    not read.
    """
    binary = F.col(text_col).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(binary).alias("text_crc32"),
    )
    kinds = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    kinds = kinds.withColumn("shard", shard_of(F.col("doc_id"), shards)).withColumn("grown_shard", shard_of(F.col("doc_id"), shards + 1))
    kinds = written(kinds.withColumn("_key", random_key("doc_id")), "shards")
    placed = with_prefix_sum(kinds, "shard", "_key", ["doc_id", "size", "text_crc32"], "_n", "_first", kinds.count())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias("slot"), "grown_shard",
    )
