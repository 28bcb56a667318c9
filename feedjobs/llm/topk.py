"""Exact top-k by columnar branch-and-bound over blocks of dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedjobs.llm.vectors import Best, matrix, search, usable

#: Dimensions that are added before survivors are compacted.
STEP = 8


def rest_mass(columns: np.ndarray, step: int) -> np.ndarray:
    """The length of what is left of each vector (a column) from each block of dimensions on; infinite if its square is."""
    with np.errstate(over="ignore"):
        blocks = [(columns[a : a + step] ** 2).sum(0) for a in range(0, len(columns), step)]
        return np.sqrt(np.cumsum(np.array([*blocks, np.zeros(columns.shape[1])])[::-1], axis=0)[::-1])


def survivors(q: np.ndarray, q_rest: np.ndarray, columns: np.ndarray, rest: np.ndarray, k: int, limit: float, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact inner products of the candidates that may be among the k best.

    ``columns`` holds a dimension a row. After each block of dimensions a candidate's score lies within
    its partial sum plus or minus (rest of the query) x (rest of the candidate). Those whose upper end
    is below the k-th best lower end, or below ``limit``, go.
    """
    live, partial = np.arange(columns.shape[1]), np.zeros(columns.shape[1])
    with np.errstate(over="ignore", invalid="ignore"):  # infinite bounds sort out nothing
        error = 1e-12 * (q_rest[0] * rest[0])  # of sums that are no whole doubles
        for i, a in enumerate(range(0, len(columns), step)):
            part = columns[a : a + step]
            partial = partial + q[a : a + step] @ (part if len(live) == columns.shape[1] else part[:, live])
            if a + step >= len(columns):
                break
            slack = q_rest[i + 1] * rest[i + 1, live] * (1 + 1e-9) + 1e-3 + error[live]  # rounding of the roots
            low = np.nan_to_num(partial - slack, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            least = limit - 1e-12 * abs(limit) if np.isfinite(limit) else limit
            if len(live) > k:
                least = max(least, np.partition(low, len(live) - k)[len(live) - k])
            stay = ~(partial + slack < least)
            if not stay.all():
                live, partial = live[stay], partial[stay]
    return live, partial


#: Below this product of two vectors' lengths all sums of their products are whole doubles.
EXACT = float(1 << 52)
#: The ends of what a score can be.
MOST = (1 << 63) - 1


def exact_products(q: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers of any size; what is beyond a long counts as its end."""
    whole = [int(v) for v in q]
    return np.array([max(-MOST, min(MOST, sum(a * int(b) for a, b in zip(whole, column, strict=True)))) for column in columns.T], np.int64)


def top_products(embeddings: DataFrame, queries: DataFrame, *, k: int = 10, scale: int = 1024, step: int = STEP, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products of floor(scale * x), exactly.

    Tasks hold a block of queries and read the candidates in batches, turned to one row a dimension. Where the lengths of
    two vectors allow sums beyond 2^52, doubles only sort out what cannot be among the best, and the rest is summed in whole
    numbers; scores beyond a long's range count as its ends, -(2^63 - 1) and 2^63 - 1. Ties go to the smaller id.
    Lengths of vectors may differ; only equal lengths meet.

    Vectors that are null, empty or hold null or non-finite components, or ones that are not finite when scaled, take no part, as rows or as
    queries; zero vectors do. A query's own id is no candidate; a candidate's id that repeats counts once, with its best score, and a query's id that
    repeats asks with the vector that sorts first. Other columns are not read. An empty table gives no rows.
    """

    def rows(df: DataFrame) -> DataFrame:
        narrow = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return narrow.where(F.col("vec_id").isNotNull() & usable("vector") & ~F.exists("vector", lambda x: F.abs(x * scale) == float("inf")))

    def scan(block: pd.DataFrame) -> Callable:
        ids = block["vec_id"].to_numpy(np.int64)
        by_length = {}
        lengths = np.array([len(v) for v in block["vector"]], np.int64)
        for d in np.unique(lengths):
            own = np.flatnonzero(lengths == d)
            q = np.floor(scale * np.stack(block["vector"].iloc[own].to_numpy()).astype(np.float64))
            by_length[int(d)] = own, q, rest_mass(q.T, step).T

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(ids, k, descending=True, kind=np.int64)
            for batch in batches:
                vec_ids = batch["vec_id"].to_numpy()
                for at, x in matrix(batch["vector"]):
                    if x.shape[1] not in by_length:
                        continue
                    own, queries, rests = by_length[x.shape[1]]
                    columns = np.ascontiguousarray(np.floor(scale * x).T)
                    rest = rest_mass(columns, step)
                    apart = len(np.unique(vec_ids[at])) == len(at)
                    room = k + 1 if apart else len(at)  # one place for the query itself; with repeated ids all stay
                    for i, q in enumerate(queries):
                        live, scores = survivors(q, rests[i], columns, rest, room, best.limit(own[i]), step)
                        large = ~(rests[i][0] * rest[0, live] <= EXACT)
                        whole = np.where(large, 0, scores).astype(np.int64)
                        whole[large] = exact_products(q, columns[:, live[large]])
                        best.add(own[i], vec_ids[at[live]], whole)
            yield best.batch(pa.int64())

        return run

    return search(rows(embeddings), rows(queries), scan, k, descending=True, score_type="long")
