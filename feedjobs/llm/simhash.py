"""SimHash fingerprints, and their links by exact comparison of tiles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedjobs.llm.near_dup import _blocks as blocks
from feedjobs.llm.shared import slices, written
from feedjobs.operators.graph import components

WORDS, RADIUS, SEED = 4, 4, 42
#: Fingerprints of a tile, and of the small tiles into which a task cuts the two tiles it compares.
TILE, SMALL = 8192, 256
#: Shingles whose bits are counted at once.
BITS = 1 << 18
#: Pairs of tiles that a task of the comparison gets.
PAIRS = 16
#: Parts of a fingerprint whose population counts bound a distance: all bits, halves, quarters, bytes.
LEVELS = (1, 2, 4, 8)


def shingle_hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of the shingles of a text (UTF-8), repeats included; of the whole sequence if it has fewer words."""
    split = text.lower().split()  # of bytes: A-Z only, and \x20 \x09-\x0D
    if not split:
        return []
    line = b" ".join(split)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(split) > words:
        starts, ends = starts[: len(split) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    return list(map(xxhash.xxh64_intdigest, map(line.__getitem__, map(slice, starts.tolist(), ends.tolist())), repeat(seed)))


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each stretch of hashes the bits that are set in over half of them; 0 for an empty stretch."""
    total = np.zeros((len(sizes), 64), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, len(hashes), BITS):
        own = owner[at : at + BITS]
        bits = np.unpackbits(hashes[at : at + BITS].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        total[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    over = (2 * total > sizes[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, *, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint (the 64 bits as a long): the bits set in over half of a text's shingle hashes. Null and wordless texts have 0."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
            for low, high in blocks(texts):
                found = [shingle_hashes(t, words) for t in texts[low:high]]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.fromiter(chain.from_iterable(found), np.uint64, sizes.sum())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(low, high - low), pa.array(majority(flat, sizes).view(np.int64))], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def populations(prints: np.ndarray) -> np.ndarray:
    """The population counts of all parts of all levels, a row a fingerprint: whole, halves, quarters, bytes."""
    whole = np.bitwise_count(prints.astype("<u8").view(np.uint8).reshape(-1, 8)).astype(np.int16)
    return np.concatenate([whole.reshape(len(prints), n, 8 // n).sum(2, dtype=np.int16) for n in LEVELS], axis=1)


_CUTS = np.cumsum((0, *LEVELS))


def apart(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray) -> np.ndarray:
    """A bound from below on the distance of any two fingerprints of two tiles, by the ranges of their population counts.

    The parts of a level are disjoint, so the distance is at least the sum of what their counts differ by.
    """
    gap = np.maximum(np.maximum(low2 - high, low - high2), 0)
    return np.max([gap[..., a:b].sum(-1) for a, b in zip(_CUTS[:-1], _CUTS[1:], strict=True)], axis=0)


class Forest:
    """Nodes that become one tree as links come in; only links that join two trees are kept."""

    def __init__(self, n: int) -> None:
        self.root, self.links = np.arange(n), []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        live = self.root[a] != self.root[b]
        a, b = a[live], b[live]
        while len(a):
            # every root takes the least root that a link leads to; what is still apart goes into another round
            x, y = self.root[a], self.root[b]
            high, low = np.maximum(x, y), np.minimum(x, y)
            order = np.lexsort((low, high))
            first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
            self.links += zip(a[first].tolist(), b[first].tolist(), strict=True)
            parent = np.arange(len(self.root))
            parent[high[first]] = low[first]
            while not np.array_equal(parent, up := parent[parent]):
                parent = up
            self.root = parent[self.root]
            live = self.root[a] != self.root[b]
            a, b = a[live], b[live]


def links_of(x: np.ndarray, y: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links within ``radius`` between two tiles, or inside one if ``y`` is None, less those that follow from others.

    Both tiles are cut into small ones. A pair of these whose population counts are too far apart is skipped, any other is compared
    by exclusive or and bit counts. A group of thousands of near copies leaves as a tree, not as all its pairs.
    """
    same = y is None
    y = x if same else y
    forest = Forest(len(x) if same else len(x) + len(y))

    def small(prints: np.ndarray):
        cuts = np.arange(0, len(prints), SMALL)
        counts = populations(prints)
        return cuts, np.minimum.reduceat(counts, cuts), np.maximum.reduceat(counts, cuts)

    (x_at, x_low, x_high), (y_at, y_low, y_high) = small(x), small(y)
    near = apart(x_low[:, None], x_high[:, None], y_low[None], y_high[None]) <= radius
    if same:
        near = np.triu(near)
    for i, j in zip(*np.nonzero(near), strict=True):
        a, b = x[x_at[i] : x_at[i] + SMALL], y[y_at[j] : y_at[j] + SMALL]
        hit = np.bitwise_count(a[:, None] ^ b) <= radius
        if same and i == j:
            hit = np.triu(hit, 1)
        if hit.any():
            p, q = np.nonzero(hit)
            forest.add(p + x_at[i], q + y_at[j] + (0 if same else len(x)))
    names = x if same else np.concatenate([x, y])
    return [(int(names[a]), int(names[b])) for a, b in forest.links]


def tiles(prints: DataFrame, size: int = TILE) -> DataFrame:
    """tile, low, high (the ranges of the population counts, see populations), data (the fingerprints, 8 bytes each).

    Distinct fingerprints are sorted by population counts, from those of all bits to those of single bytes, so that a tile's ranges are
    narrow; the more fingerprints there are, the narrower.
    """
    count = lambda first, bits: F.bit_count(F.shiftrightunsigned("fingerprint", first).bitwiseAND(F.lit((1 << bits) - 1)))
    order = [F.bit_count("fingerprint"), count(0, 32), count(0, 16), count(32, 16), *[count(i, 8) for i in (0, 16, 32, 48)], F.col("fingerprint")]
    n = -(-prints.count() // size)
    schema = "tile long, low array<int>, high array<int>, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rest, made = TaskContext.get().partitionId() << 32, np.zeros(0, np.uint64), 0
        for batch in [*batches, None]:
            if batch is not None:
                rest = np.r_[rest, batch["fingerprint"].to_numpy().view(np.uint64)]
            while len(rest) >= size or (batch is None and len(rest)):
                mine, rest = rest[:size], rest[size:]
                counts = populations(mine)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part + made], pa.int64()), *[pa.array([f(0).tolist()], pa.list_(pa.int32())) for f in (counts.min, counts.max)], pa.array([mine.astype("<u8").tobytes()], pa.binary())],
                    names=["tile", "low", "high", "data"],
                )
                made += 1

    return prints.select("fingerprint").repartitionByRange(max(1, n), *order).sortWithinPartitions(*order).mapInArrow(run, schema)


def tile_pairs(made: DataFrame, radius: int = RADIUS) -> DataFrame:
    """tile, tile2 (not less) of the tiles that may hold fingerprints within ``radius``.

    Tiles meet by the population count of all bits: a pair within reach is found once, under the greater of its two least counts. The finer counts sort out more.
    """
    rows = made.select("tile", "low", "high").withColumn("_k", F.explode(F.sequence(F.col("low")[0], F.col("high")[0] + radius)))
    other = rows.select(*[F.col(c).alias(f"{c}2") for c in ("tile", "low", "high")], "_k")
    met = rows.join(other, "_k").where((F.col("tile") <= F.col("tile2")) & (F.col("_k") == F.greatest(F.col("low")[0], F.col("low2")[0])))

    def bound(a: int, b: int) -> Column:
        return sum((F.greatest(F.col("low2")[i] - F.col("high")[i], F.col("low")[i] - F.col("high2")[i], F.lit(0)) for i in range(a, b)), F.lit(0))

    for a, b in zip(_CUTS[:-1].tolist(), _CUTS[1:].tolist(), strict=True):
        met = met.where(bound(a, b) <= radius)
    return met.select("tile", "tile2")


def links(prints: DataFrame, *, radius: int = RADIUS, size: int = TILE) -> DataFrame:
    """a, b: links between the distinct ``fingerprint`` values that reach as far as all pairs within ``radius`` do.

    Every pair of tiles that may hold a link is one row that a task compares exactly (links_of), so the work is that of the
    tile pairs that population counts can't sort out; it is quadratic in the distinct fingerprints of similar counts.
    """
    made = written(tiles(prints, size), "tiles")
    pairs = written(tile_pairs(made, radius), "tile-pairs")
    data = made.select("tile", "data")
    rows = pairs.join(data, "tile").join(data.select(F.col("tile").alias("tile2"), F.col("data").alias("data2")), "tile2")
    rows = rows.repartition(max(1, -(-pairs.count() // PAIRS)), "tile", "tile2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, t2, x, y in zip(*(batch[c].to_pylist() for c in ("tile", "tile2", "data", "data2")), strict=True):
                found = np.array(links_of(np.frombuffer(x, "<u8"), None if t == t2 else np.frombuffer(y, "<u8"), radius), np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return rows.select("tile", "tile2", "data", "data2").mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, *, words: int = WORDS, radius: int = RADIUS, size: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id: the least doc_id that chains of links within ``radius`` bits reach.

    Equal fingerprints are one node from the start, so copies cost one comparison. Null, empty and wordless texts have fingerprint 0 and link like any other;
    repeated rows are copies; whole texts are read, other columns are not. Rows without an id are linked like others and don't name a
    component, unless it has no id at all: then component_id is null. An empty table gives no rows.
    """
    marked = written(fingerprints(docs, words=words), "fingerprints")
    nodes = written(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    roots = written(components(links(nodes, radius=radius, size=size)), "roots")
    named = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    known = named.join(least, "root").select("fingerprint", "component_id")
    return marked.join(known, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
