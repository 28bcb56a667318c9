"""The index of what is stored: by id and by title, in folders by hash, so that a batch reads only the folders its keys fall into.

Each stored item has two narrow rows, one under its id and one under its title. Rows carry ``added``, the number of the batch that brought them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedjobs.operators import keyfilter
from feedjobs.operators.dedup import SIGHTING
from feedjobs.sources import commits

#: Folders for each kind of key. A store of 10**10 items has some 10**7 rows in one of 1,024.
BUCKETS = 64
ROW = ["id", "title_hash", "source_tier", "seq", *SIGHTING]
KINDS = {"id": "id", "title": "title_hash"}


def bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def add(items: DataFrame, path: str, number: int) -> bool:
    """Index the items of a batch; a batch that was indexed before is left alone."""
    rows = items.select(*ROW, F.lit(number).cast("long").alias("added"))
    both = [rows.withColumns({"by": F.lit(kind), "bucket": bucket(key)}) for kind, key in KINDS.items()]
    return commits.write(both[0].union(both[1]).repartition("by", "bucket"), path, f"{number:010d}", ("by", "bucket"))


def matching(spark: SparkSession, path: str, batch: DataFrame, before: int | None = None) -> DataFrame:
    """The stored rows that share an id or a title with the batch, and a few others; for dedup as good as the whole store.

    Only folders that the batch's keys fall into are read, and of these only rows that pass the Bloom filter of its keys. ``before``: of earlier batches only.
    """
    stored = commits.read(spark, path)
    if stored is None:
        return batch.select(ROW).limit(0)
    if before is not None:
        stored = stored.where(F.col("added") < before)
    n, out = batch.count(), None
    for kind, key in KINDS.items():
        folders = [r[0] for r in batch.select(bucket(key)).distinct().collect()]  # BUCKETS at most
        rows = stored.where((F.col("by") == kind) & F.col("bucket").isin(folders)).select(ROW)
        rows = keyfilter.maybe(rows, key, keyfilter.key_filter(batch, key, n))
        out = rows if out is None else out.union(rows)
    return out


def compact(spark: SparkSession, path: str) -> None:
    commits.compact(spark, path, ("by", "bucket"), ["id", "title_hash"])
