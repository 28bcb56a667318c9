"""What both vector searches share: usable rows, blocks of queries, merging."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedjobs.llm.shared import written

#: Queries that are sent to the tasks at once, about.
QUERY_BLOCK = 4_096
#: Blocks that one job takes past the candidates side by side; so many are on the driver at once.
BLOCKS = 8


def usable(column: str) -> Column:
    """Not null, not empty, all components finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & (F.size(column) > 0) & ~bad


def matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vector its rows' places and their double-precision matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy()[:-1]
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def blocks(queries: DataFrame, size: int = QUERY_BLOCK) -> Iterator[pd.DataFrame]:
    """The query rows in blocks of about ``size`` by a hash of the id, each read when it is asked for.

    A repeated id counts once, with the vector that sorts first.
    """
    queries = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n = max(1, -(-queries.count() // size))
    if n > 1:
        queries = written(queries, "queries")
    for i in range(n):
        yield queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == i).toPandas()


def search(candidates: DataFrame, queries: DataFrame, scan: Callable, k: int, *, descending: bool, score_type: str) -> DataFrame:
    """The k best of ``scan``'s rows (query_id, vec_id, score) for each query: query_id, rank, vec_id, score.

    ``scan(block)`` makes a function over Arrow batches of candidates that yields what may be among a block's best: k rows a query
    and task at most. BLOCKS blocks are one job, whose tasks are a block and a part of the candidates each; what they find is reduced to k rows a query and
    written once. A candidate's id counts once for a query.
    """
    order = F.desc("score") if descending else F.asc("score")
    best = F.max("score") if descending else F.min("score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))

    def reduced(part: DataFrame) -> DataFrame:
        once = part.groupBy("query_id", "vec_id").agg(best.alias("score"))
        return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    scans = (candidates.mapInArrow(scan(block), f"query_id long, vec_id long, score {score_type}") for block in blocks(queries))
    return reduce(DataFrame.union, [written(reduced(reduce(DataFrame.union, some)), "best") for some in batched(scans, BLOCKS)])


class Best:
    """The k best distinct ids so far for each query of a block, in one task."""

    def __init__(self, ids: np.ndarray, k: int, *, descending: bool, kind: type = np.float64) -> None:
        self.ids, self.k, self.sign = ids, k, -1 if descending else 1
        self.kept: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, kind))] * len(ids)

    def limit(self, q: int) -> float:
        """The k-th score, or infinity (signed) if there are fewer."""
        scores = self.kept[q][1]
        return scores[self.k - 1] if len(scores) >= self.k else self.sign * np.inf

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """Offer candidates; the query's own id and what is past the k-th are dropped."""
        fine = ids != self.ids[q]
        fine &= self.sign * scores <= self.sign * self.limit(q)
        if not fine.any():
            return
        ids, scores = np.r_[self.kept[q][0], ids[fine]], np.r_[self.kept[q][1], scores[fine]]
        order = np.lexsort((ids, self.sign * scores))
        _, first = np.unique(ids[order], return_index=True)
        order = order[np.sort(first)][: self.k]
        self.kept[q] = ids[order], scores[order]

    def batch(self, kind: pa.DataType) -> pa.RecordBatch:
        n = np.array([len(x[0]) for x in self.kept], np.int64)
        ids = np.concatenate([x[0] for x in self.kept]) if self.kept else np.zeros(0, np.int64)
        scores = np.concatenate([x[1] for x in self.kept]) if self.kept else np.zeros(0)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, n), pa.int64()), pa.array(ids, pa.int64()), pa.array(scores).cast(kind)], names=["query_id", "vec_id", "score"])
