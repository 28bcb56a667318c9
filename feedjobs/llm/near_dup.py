"""Near duplicates by ProbMinHash signatures, banding and verification.

Similarity is the probability Jaccard index of the counts of five-word shingles:
J(x, y) = sum over i of 1 / sum over j of max(x_j / x_i, y_j / y_i), over shingles i of both.
Where all counts are 1 it is the plain Jaccard index. A pair that reaches the limit by the plain index of the
distinct shingles is linked too: texts that repeat shingles have signatures of both kinds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedjobs.llm.shared import slices, written
from feedjobs.operators.graph import components

WORDS, SIMILARITY = 5, 0.8
#: Registers of a signature are BANDS x ROWS: a pair at 0.8 shares a band with probability 0.9999, one at 0.3 with 0.02.
BANDS, ROWS = 30, 6
#: Characters whose signatures are made at once (a longer text stands alone).
BLOCK = 1_500_000
#: Arrivals that are drawn at once, if fewer shingles than that are still in time.
DRAWS = 1 << 15
#: Bytes of shingles that stand apart and meet one task's share of the others.
CROSS_BYTES = 16_000_000
#: Nodes of a pivot whose links are checked pair by pair; more meet in blocks.
FEW = 16

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def shingles(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and count of the distinct shingles of each list of words. Fewer than WORDS words are one shingle."""
    sizes = np.array([max(len(w), WORDS) if w else 0 for w in texts], np.int64)
    flat = [w for words in texts for w in (words if len(words) >= WORDS or not words else [*words, *[""] * (WORDS - len(words))])]
    if not flat:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    h = word[: len(word) - WORDS + 1].copy()
    for i in range(1, WORDS):
        h = _mix(h * _A + word[i : len(word) - WORDS + 1 + i])
    doc = np.repeat(np.arange(len(texts)), sizes)
    start = np.flatnonzero(doc[: len(h)] == doc[WORDS - 1 :])
    doc, h = doc[start], h[start]
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16) if len(texts) <= 1 << 16 else doc[order], kind="stable")]  # short integers sort by radix
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])
    return doc[new], h[new], np.diff(np.r_[new, len(h)])


def signatures(texts: list[list[str]], registers: int) -> np.ndarray:
    """One row of element hashes a text; rows of texts without words are 0.

    A shingle with count w arrives at a Poisson process of rate w, and each arrival falls on a random
    register. A register keeps the element that arrived first, so two texts agree on it
    with probability J. All texts run at once: in each round a shingle that is still in time makes its next arrivals,
    and one that comes later than every register of its text stops for good.
    """
    return arrivals(*shingles(texts), len(texts), registers)


def arrivals(doc: np.ndarray, h: np.ndarray, count: np.ndarray, texts: int, registers: int) -> np.ndarray:
    first = np.full(texts * registers, np.inf)
    kept = np.zeros(texts * registers, np.uint64)
    at, live, n = np.zeros(len(h)), np.arange(len(h)), 0
    while len(live):
        many = min(max(1, DRAWS // len(live)), registers)  # a shingle's next arrivals; late ones change nothing
        turn = np.arange(n + 1, n + many + 1, dtype=np.uint64) * _A
        n += many
        draw = _mix(h[live] + turn[:, None])
        gap = np.log(((draw >> np.uint64(24)).astype(np.float64) + 0.5) / (1 << 40)) / -count[live]
        time = np.cumsum(np.concatenate([at[live][None], gap]), axis=0)[1:]
        at[live] = time[-1]
        slot = (doc[live] * registers) + ((draw & np.uint64(0xFFFFFF)) * np.uint64(registers) >> np.uint64(24)).astype(np.int64)
        soon = time < first[slot]
        owner, time, slot = np.broadcast_to(h[live], soon.shape)[soon], time[soon], slot[soon]
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        kept[slot[won]] = owner[won]
        live = live[at[live] < first.reshape(texts, registers).max(1)[doc[live]]]
    return kept.reshape(texts, registers)


def band_codes(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit code of each band, which depends on the band's number."""
    parts = signature.reshape(len(signature), bands, signature.shape[1] // bands)
    code = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _A, parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        code = _mix(code * _A + parts[:, :, i])
    return code.view(np.int64)


def _words(text: str) -> list[str]:
    return text.lower().split()


def _key(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > BLOCK:
            yield at, i
            at, size = i, 0
        size += len(t)
    if texts:
        yield at, len(texts)


def sign(docs: DataFrame, *, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, node (a key of the words in lower case; null for a null text) and codes (null without words).

    A text that repeats shingles has codes of its distinct shingles too. One without repeats has the same codes for both, so a
    pair that is similar by either index meets.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("node", T.BinaryType()), T.StructField("codes", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch["text"].to_pylist()
            for low, high in _blocks([t or "" for t in texts]):
                split = [_words(t or "") for t in texts[low:high]]
                doc, h, count = shingles(split)
                some, again = np.array([bool(w) for w in split]), np.unique(doc[count > 1])
                mine = np.isin(doc, again)
                both = [arrivals(doc, h, count, len(split), bands * rows)[some], arrivals(np.searchsorted(again, doc[mine]), h[mine], np.ones(mine.sum()), len(again), bands * rows)]
                owner = np.r_[np.flatnonzero(some), again]
                codes = band_codes(np.concatenate(both)[np.argsort(owner, kind="stable")], bands)
                bounds = pa.array(np.r_[0, np.cumsum(np.bincount(owner, minlength=len(split)) * bands)], pa.int32(), mask=np.r_[~some, False])
                nodes = [None if t is None else _key(w) for t, w in zip(texts[low:high], split, strict=True)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(low, high - low), pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(bounds, pa.array(codes.ravel()))], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def similarity(x: np.ndarray, x_n: np.ndarray, y: np.ndarray, y_n: np.ndarray) -> float:
    """The probability Jaccard index of two sorted lists of hashes with counts, or the plain one if that is higher."""
    at = np.searchsorted(y, x)
    both = at < len(y)
    both[both] = y[at[both]] == x[both]
    if not both.any():
        return 0.0
    a, b = x_n[both].astype(np.float64), y_n[at[both]].astype(np.float64)
    only_x, only_y = float(x_n.sum()) - a.sum(), float(y_n.sum()) - b.sum()
    ratio = b / a
    total = 0.0
    for r in np.unique(ratio):
        total += a[ratio == r].sum() / (only_x + only_y / r + np.maximum(a, b / r).sum())
    return max(float(total), both.sum() / (len(x) + len(y) - both.sum()))


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with _node, the key of their text's words as in sign()."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_node", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nodes = [None if t is None else _key(_words(t)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """node, hashes, counts of the distinct texts in ``needed`` (least, node).

    Rows are joined by the key of their text, as an id may be null or have several texts; with the id, so that of a node's copies only those of its least id are read.
    The join is a shuffle at every size: a broadcast would put two Python workers in each task.
    """
    rows = keyed(docs.select("doc_id", "text"))
    rows = rows.join(needed.hint("merge"), (F.col("_node") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("least"))).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch["text"].to_pylist()
            for low, high in _blocks(texts):
                doc, h, n = shingles([_words(t) for t in texts[low:high]])
                ends = np.searchsorted(doc, np.arange(high - low + 1))
                hashes = [h[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                counts = [n[a:b].astype(np.uint32).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["node"].slice(low, high - low), pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())], names=["node", "hashes", "counts"])

    found = rows.mapInArrow(run, "node binary, hashes binary, counts binary")
    return found.groupBy("node").agg(F.first("hashes").alias("hashes"), F.first("counts").alias("counts"))


def _verify(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, b) that are similar enough."""
    first = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ah"), F.col("counts").alias("ac"))
    second = sets.select(F.col("node").alias("b"), F.col("hashes").alias("bh"), F.col("counts").alias("bc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            columns = [batch[c].to_pylist() for c in ("ah", "ac", "bh", "bc")]
            for ah, ac, bh, bc in zip(*columns, strict=True):
                s = similarity(np.frombuffer(ah, np.uint64), np.frombuffer(ac, np.uint32), np.frombuffer(bh, np.uint64), np.frombuffer(bc, np.uint32))
                good.append(s >= least - 1e-12)
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(keep), batch["b"].filter(keep)], names=["a", "b"])

    return pairs.join(second, "b").join(first, "a").mapInArrow(run, "a binary, b binary")


def _cross(nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between nodes of one pivot and different roots, at least one of them ``apart``.

    nodes: pivot, node, root, apart. Pivots of few nodes give pairs, FEW a node at most. For the others, the nodes that stand
    apart and all nodes of the pivot are cut into blocks by bytes, and each block of the one meets each of the other in a
    task of its own. There all similarities come from one index of the block's shingles; only links leave the task,
    so a large group makes no rows of pairs. Nodes of different pivots never meet, so the work grows with the buckets and not with
    the square of the corpus.
    """
    counted = nodes.groupBy("pivot").agg(F.count(F.lit(1)).alias("_n"))
    few = nodes.join(counted.where(F.col("_n") <= FEW).select("pivot"), "pivot")
    other = few.select("pivot", F.col("node").alias("_node"), F.col("root").alias("_root"))
    pairs = few.where("apart").join(other, "pivot").where("root <> _root").select(F.greatest("node", "_node").alias("a"), F.least("node", "_node").alias("b")).distinct()

    many = nodes.join(counted.where(F.col("_n") > FEW).select("pivot"), "pivot")
    least_pivot = many.groupBy("node").agg(F.min("pivot").alias("_g"))
    merged = many.join(least_pivot, "node").groupBy("pivot").agg(F.min("_g").alias("_g"))  # pivots of one group share nodes: they meet once
    many = many.join(merged, "pivot").groupBy(F.col("_g").alias("pivot"), "node", "root").agg(F.max("apart").alias("apart"))
    full = written(many.join(sets, "node").withColumn("_bytes", F.octet_length("hashes").cast("long")), "cross")
    blocks = full.groupBy("pivot").agg(F.sum("_bytes").alias("_all"), F.coalesce(F.sum(F.when(F.col("apart"), F.col("_bytes"))), F.lit(0)).alias("_apart"))
    across = F.floor(F.col("_apart") / CROSS_BYTES) + 1
    down = F.greatest(F.least(F.lit(32), F.floor(F.col("_all") / (CROSS_BYTES // 32)) + 1), F.floor(F.col("_all") / (4 * CROSS_BYTES)) + 1)
    cut = blocks.select("pivot", across.cast("int").alias("_across"), down.cast("int").alias("_down"))
    columns = ["pivot", "node", "root", "hashes", "counts"]

    def dealt(df: DataFrame, own: str, n: str, other: str, m: str):
        place = F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
        return df.join(cut, "pivot").select(*[F.col(c).alias(c) for c in columns], place.alias(own), F.explode(F.sequence(F.lit(0), F.col(m) - 1)).alias(other)).groupBy("pivot", "x", "y")

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(x) and len(y):
            x_h, x_n = ([np.frombuffer(v, t) for v in x[c]] for c, t in (("hashes", np.uint64), ("counts", np.uint32)))
            sizes, plain = np.array([len(h) for h in x_h]), np.array([n.max() == 1 for n in x_n])
            names, _ = pd.factorize(pd.concat([x["root"], y["root"]]))
            x_root, y_root = names[: len(x)], names[len(x) :]
            owner, flat, mass = np.repeat(np.arange(len(x)), sizes), np.concatenate(x_h), np.concatenate(x_n)
            order = np.argsort(flat, kind="stable")
            owner, flat, mass = owner[order], flat[order], mass[order].astype(np.float64)
            x_mass = np.array([n.sum() for n in x_n], np.float64)
            for j, (node, h, n) in enumerate(zip(y["node"], y["hashes"], y["counts"], strict=True)):
                h, n = np.frombuffer(h, np.uint64), np.frombuffer(n, np.uint32)
                low, high = np.searchsorted(flat, h), np.searchsorted(flat, h, "right")
                common, of_x, of_y = np.zeros(len(x), np.int64), np.zeros(len(x)), np.zeros(len(x))
                exact = plain & (n.max() == 1)
                for part in range(0, len(h), 1024):
                    k = (high - low)[part : part + 1024]
                    at = np.repeat(low[part : part + 1024] - np.cumsum(k) + k, k) + np.arange(k.sum())
                    common += np.bincount(owner[at], minlength=len(x))
                    if not exact.all():
                        of_x += np.bincount(owner[at], mass[at], len(x))
                        of_y += np.bincount(owner[at], np.repeat(n[part : part + 1024], k), len(x))
                alike = common >= (least - 1e-12) * (sizes + len(h) - common)
                # no probability Jaccard index is above the share of either text that both have
                maybe = ~exact & (np.minimum(of_x / x_mass, of_y / n.sum()) >= least - 1e-9)
                for i in np.flatnonzero((common > 0) & (x_root != y_root[j]) & (alike | maybe)):
                    if alike[i] or similarity(x_h[i], x_n[i], h, n) >= least - 1e-12:
                        found.append((x["node"].iloc[i], node))
        return pd.DataFrame(found, columns=["a", "b"], dtype=object)

    left, right = dealt(full.where("apart"), "x", "_across", "y", "_down"), dealt(full, "y", "_down", "x", "_across")
    return _verify(pairs, sets, least).union(left.cogroup(right).applyInPandas(meet, "a binary, b binary"))


def near_duplicates(docs: DataFrame, *, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id, class_size, node, head: one row a document.

    Documents are in one class if a chain of pairs at ``similarity`` or more links them; class_id is
    the class's least doc_id. Copies (equal words but for case and blanks) are one node from the start, so a
    large group of copies costs one signature's buckets. In a bucket each node is compared to the
    least one. What that links becomes one component. In a bucket that still holds several components, the nodes outside
    its largest one are compared to the bucket's others; buckets with the same least node are one group for that, which is
    cut into blocks if it is large (see _cross). So a large group of near copies never meets all against all, and no
    link between nodes that share a bucket is lost.

    ``node`` is the key of the text's words and ``head`` tells the rows that stand for their class: those of its least id (null if it has no other) and
    of one text. Rows are told apart by text, not by id: texts without an id and several texts under one id are as many nodes, in the classes that
    their own texts give. Different classes may then have the same class_id, each with a class_size of its own.

    A null text is in a class of its own; texts without words are copies of each other; fewer than five words
    are one shingle. Repeated rows are copies, long texts are read whole, other columns are not read.
    An empty table gives no rows.
    """
    signed = written(sign(docs, bands=bands, rows=rows), "signed")
    nodes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.max("codes").alias("codes"))
    nodes = written(nodes, "nodes")
    buckets = nodes.where("codes is not null").select("node", F.explode(F.array_distinct("codes")).alias("code"))
    shared = buckets.groupBy("code").agg(F.min("node").alias("pivot"), F.max("node").alias("_last")).where("pivot <> _last").drop("_last")
    members = written(buckets.join(shared, "code"), "members")
    stars = written(members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "stars")

    needed = members.select("node").distinct().join(nodes, "node").select("least", "node")
    sets = written(_sets(docs, needed), "sets")
    linked = written(_verify(stars, sets, similarity), "linked")
    roots = components(linked)

    placed = members.select("code", "pivot", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counted = placed.groupBy("code", "root").agg(F.count(F.lit(1)).alias("_n"))
    mixed = counted.groupBy("code").agg(F.max(F.struct("_n", "root"))["root"].alias("_main"), F.count(F.lit(1)).alias("_roots")).where("_roots > 1")
    placed = placed.join(mixed, "code").select("pivot", "node", "root", (F.col("root") != F.col("_main")).alias("apart"))
    placed = written(placed.groupBy("pivot", "node", "root").agg(F.max("apart").alias("apart")), "mixed")
    roots = components(linked.union(_cross(placed, sets, similarity)))

    whole = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counted = signed.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("_rows"))
    named = whole.join(counted, "node").groupBy("root").agg(F.min(F.struct(F.isnull("least").alias("_none"), F.col("least"), F.col("node"))).alias("_head"), F.sum("_rows").alias("class_size"))
    known = whole.join(named, "root").select(F.col("node").alias("_node"), F.col("_head.least").alias("class_id"), F.col("_head.node").alias("_first"), "class_size")
    alone = F.col("node").isNull()
    found = signed.select("doc_id", "node").join(known, F.col("node") == F.col("_node"), "left")
    head = alone | ((F.col("node") == F.col("_first")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    return found.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"), "node", head.alias("head"))


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One document of each class, with all its columns: one of its head rows (see near_duplicates).

    An id that has one row names its document. Rows without an id, or of an id with several rows, are told apart by their text. Null texts
    stay, once an id; those without an id all stay.
    """
    ids = classes.where("doc_id is not null").groupBy(F.col("doc_id").alias("_class_head")).agg(F.count(F.lit(1)).alias("_class_rows"), F.max("head").alias("_class_any"))
    kept = docs.join(ids.where("_class_any"), F.col("doc_id") == F.col("_class_head"))
    once = kept.where("_class_rows = 1").select(docs.columns)
    again = keyed(kept.where("_class_rows > 1").select(docs.columns).unionByName(docs.where("doc_id is null")))
    heads = classes.where("head and node is not null").select(F.col("doc_id").alias("_class_head"), F.col("node").alias("_class_node")).distinct()
    texts = again.join(heads, (F.col("_node") == F.col("_class_node")) & F.col("doc_id").eqNullSafe(F.col("_class_head"))).dropDuplicates(["doc_id", "_node"])
    nulls = again.where("_node is null")
    parts = [texts, nulls.where("doc_id is not null").dropDuplicates(["doc_id"]), nulls.where("doc_id is null")]
    for part in parts:
        once = once.unionByName(part.select(docs.columns))
    return once
