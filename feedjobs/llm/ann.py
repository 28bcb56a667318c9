"""Approximate nearest neighbours by cross-polytope hashing (Andoni et al., 2015)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedjobs.llm.shared import written
from feedjobs.llm.vectors import Best, matrix, search, usable

#: Tables, and the least number of signed axes that a query probes in each.
TABLES, PROBES = 12, 6
#: Least recall on a sample of so many queries, by which the probes of each width are chosen (two standard errors above 0.9).
RECALL, SAMPLE = 0.92, 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        pairs = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """A pseudo-rotation of the unit rows: three times random signs and a Hadamard transform."""
    wide = 1 << max(1, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - x.shape[1])))
    signs = np.random.default_rng((seed, table, wide)).choice((-1.0, 1.0), (3, wide))
    for s in signs:
        x = hadamard(x * s)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # else squares may overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows to ``q``. Where squares are beyond a double, or too small for one, the differences are scaled by the largest; a distance that is itself beyond a double is infinite."""
    with np.errstate(over="ignore", invalid="ignore"):
        gap = x - q
        squares = (gap**2).sum(1)
        out = np.sqrt(squares)
        odd = ~((squares > 1e-280) & (squares < np.inf))
        if odd.any():
            half = x[odd] / 2 - q / 2  # of which none is infinite
            largest = np.abs(half).max(1)
            scaled = half / np.where(largest > 0, largest, 1)[:, None]
            out[odd] = 2 * (largest * np.sqrt((scaled**2).sum(1)))
    return out


def code(y: np.ndarray) -> np.ndarray:
    """The nearest signed axis: 2 i for axis i, 2 i + 1 for its negative."""
    axis = np.abs(y).argmax(1)
    return 2 * axis + (y[np.arange(len(y)), axis] < 0)


def index(vectors: DataFrame, *, tables: int = TABLES, seed: int = 0) -> DataFrame:
    """vec_id, vector, codes: the bucket of every usable vector in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, tables), np.int16)
            for at, x in matrix(batch["vector"]):
                x = unit(x)
                for t in range(tables):
                    codes[at, t] = code(rotated(x, t, seed))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, tables), pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["vector"], lists], names=["vec_id", "vector", "codes"])

    return vectors.mapInArrow(run, "vec_id long, vector array<double>, codes array<short>")


def needed(ranks: np.ndarray, recall: float) -> int:
    """The least number of probes that meet a share of ``recall`` of the sample's neighbours. ranks: the place of each one's axis."""
    return int(np.sort(ranks)[max(0, int(np.ceil(recall * len(ranks))) - 1)]) + 1


def chosen(indexed: DataFrame, sample: DataFrame, best: DataFrame, *, tables: int, probes: int, recall: float, seed: int) -> dict[int, int]:
    """The probes that each width needs. ``best`` holds the exact nearest of the sample's queries.

    What a query meets is ranked exactly, so a true neighbour is found if and only if its axis is among the query's probes in some table.
    All axes are probed at most, which meets everything. A width that the sample lacks gets the most that any width needs, by its share of axes.
    """
    asked = sample.groupBy("vec_id").agg(F.min("vector").alias("_q")).withColumnRenamed("vec_id", "query_id")  # as vectors.blocks
    pairs = best.select("query_id", "vec_id").join(asked, "query_id")
    gap = F.aggregate(F.zip_with("vector", "_q", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, v: a + v)
    met = indexed.join(F.broadcast(pairs), "vec_id").where(F.size("vector") == F.size("_q"))
    found = met.groupBy("query_id", "vec_id").agg(F.min_by(F.struct("_q", "codes"), gap).alias("r")).select("r.*").toPandas()
    widths, ranks = np.array([len(q) for q in found["_q"]], np.int64), {}
    for d in np.unique(widths):
        own = widths == d
        x, codes = unit(np.stack(found["_q"][own].to_numpy()).astype(np.float64)), np.stack(found["codes"][own].to_numpy())
        place = np.full(len(x), np.iinfo(np.int64).max)
        for t in range(tables):
            y = rotated(x, t, seed)
            signed = np.stack((y, -y), axis=2).reshape(len(y), -1)
            place = np.minimum(place, (signed > signed[np.arange(len(y)), codes[:, t]][:, None]).sum(1))
        ranks[int(d)] = max(probes, needed(place, recall))
    return ranks


def nearest(embeddings: DataFrame, queries: DataFrame, *, k: int = 10, tables: int = TABLES, probes: int = PROBES, seed: int = 0, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by Euclidean distance among what its buckets hold.

    All vectors are indexed. Tasks hold a block of queries and read the index once per block: a candidate meets a query only
    if one of the query's ``probes`` best axes in some table is the candidate's own, and is then ranked by its
    exact distance in double precision. Buckets have no cap: each is read in batches, so a
    bucket of many equal vectors needs no more memory. Ties go to the smaller id. Lengths of vectors
    may differ; only equal lengths meet.

    ``probes`` is the least number. Recall is measured against the exact nearest of ``sample`` queries (all, if fewer; those whose ids hash lowest),
    and each width probes as many axes as reach ``recall`` on them, all if need be. Queries that found fewer
    than k are answered by an exact scan, so each query has k rows, or all its candidates.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, as rows or as queries. A
    query's own id is no candidate; a repeated id counts once. Other columns are not read.
    """

    def rows(df: DataFrame) -> DataFrame:
        narrow = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return narrow.where(F.col("vec_id").isNotNull() & usable("vector") & F.exists("vector", lambda x: x != 0))

    def scanner(counts: dict[int, int] | None) -> Callable:
        """A scan of what the probes of each width meet, or of everything."""

        def scan(block: pd.DataFrame) -> Callable:
            ids = block["vec_id"].to_numpy(np.int64)
            by_length: dict[int, tuple[np.ndarray, np.ndarray, list[list[np.ndarray]]]] = {}
            lengths = np.array([len(v) for v in block["vector"]], np.int64)
            for d in np.unique(lengths):
                own = np.flatnonzero(lengths == d)
                x = np.stack(block["vector"].iloc[own].to_numpy()).astype(np.float64)
                probing = []
                wide = 2 << max(1, int(d - 1).bit_length())
                share = max([probes / wide, *[n / (2 << max(1, (w - 1).bit_length())) for w, n in (counts or {}).items()]])
                many = 0 if counts is None else counts.get(int(d), int(np.ceil(share * wide)))
                for t in range(tables if 0 < many < wide else 0):
                    y = rotated(unit(x), t, seed)
                    signed = np.stack((y, -y), axis=2).reshape(len(y), -1)
                    top = np.argpartition(-signed, many, axis=1)[:, :many]
                    flat, who = top.ravel(), np.repeat(np.arange(len(y)), top.shape[1])
                    order = np.argsort(flat, kind="stable")
                    bounds = np.searchsorted(flat[order], np.arange(signed.shape[1] + 1))
                    probing.append([who[order[a:b]] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
                by_length[int(d)] = own, x, probing

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                best = Best(ids, k, descending=False)
                for batch in batches:
                    vec_ids, codes = batch["vec_id"].to_numpy(), np.array(batch["codes"].flatten()).reshape(-1, tables)
                    for at, x in matrix(batch["vector"]):
                        if x.shape[1] not in by_length:
                            continue
                        own, q, probing = by_length[x.shape[1]]
                        meets = np.full((len(q), len(at)), not probing)
                        for t in range(len(probing)):
                            order = np.argsort(codes[at, t], kind="stable")
                            named, first = np.unique(codes[at, t][order], return_index=True)
                            for c, a, b in zip(named, first, [*first[1:], len(order)], strict=True):
                                meets[np.ix_(probing[t][c], order[a:b])] = True
                        for i in range(len(q)):
                            some = np.flatnonzero(meets[i])
                            if len(some):
                                best.add(own[i], vec_ids[at[some]], distances(x[some], q[i]))
                yield best.batch(pa.float64())

            return run

        return scan

    def ranked(asked: DataFrame, counts: dict[int, int] | None) -> DataFrame:
        return search(indexed, asked, scanner(counts), k, descending=False, score_type="double")

    indexed, asked = written(index(rows(embeddings), tables=tables, seed=seed), "index"), written(rows(queries), "asked")
    ids = asked.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    some = written(asked.join(ids, "vec_id", "left_semi"), "sample")
    counts = chosen(indexed, some, written(ranked(some, None), "exact"), tables=tables, probes=probes, recall=recall, seed=seed)
    found = written(ranked(asked, counts), "near")
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k)
    short = written(asked.join(full, F.col("vec_id") == F.col("query_id"), "left_anti"), "short")
    if short.isEmpty():
        return found
    return found.join(full.select("query_id"), "query_id", "left_semi").select(found.columns).unionByName(ranked(short, None))
