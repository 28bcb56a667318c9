"""The prefix trie of conversations: sorted shards under a skeleton of the splitters' paths.

A conversation is a path of steps, a step a turn. Conversations are range-partitioned by (path, id). A node whose members lie in several shards is a
prefix of a splitter between them, so the trie of the splitters' paths (the skeleton) holds every such node. It is broadcast; each shard
finishes all other nodes alone, as it reads its rows in order, and the skeleton's nodes add up what the shards saw of them.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedjobs.llm.shared import written

#: Bytes of a step: MD5 of role and text, then the words of the text.
STEP = 20
#: Bytes of paths that a shard should hold, and that all splitters may hold: so the skeleton has at most SPLITTERS / STEP nodes.
SHARD, SPLITTERS = 16_000_000, 4_000_000
#: Sampled rows for each splitter, and bytes of the sample on the driver.
SAMPLE, SAMPLE_BYTES = 20, 32_000_000
#: Ids in a row of ends.
IDS = 10_000

WORD = r"[^\x20\x09-\x0D]+"


def step(role: Column, text: Column) -> Column:
    """A turn as 40 hexadecimal digits: equal for equal (role, text), null as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.concat(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)), F.lpad(F.lower(F.hex(F.regexp_count(text, F.lit(WORD)))), 8, "0"))


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, steps: the turns of each conversation in order of ``turn``, null first; ties stand in the order of their digests.

    Texts stay where they are: a turn is 40 digits from here on, and a conversation is one row. Rows without a conv_id belong to none.
    """
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", step(F.col("role"), F.col("text")).alias("step")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["step"]).alias("steps"))


def rebuilt(own: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first h turns taken from conversation c - c mod ``every``, then its own after its first h, if any; h = crc32(c) mod ``most``.

    A base that has fewer turns gives all it has, one that is absent none.
    """
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(every))
    heads = own.where(F.pmod("conv_id", F.lit(every)) == 0).select(F.col("conv_id").alias("_base"), F.slice("steps", 1, most - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    none = F.array().cast("array<string>")
    joined = own.withColumn("_b", base).join(heads, F.col("_b") == F.col("_base"), "left").withColumn("_h", h)
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")), F.slice("steps", F.col("_h") + 1, F.greatest(F.size("steps"), F.lit(1)))).alias("steps"))


class Skeleton:
    """The trie of the splitters' paths. Node 0 is the root; ``parent`` and ``words`` are those of its nodes."""

    def __init__(self, splitters: list[tuple[bytes, int]]) -> None:
        self.splitters = splitters
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.words = [-1], [0]
        for path, _ in splitters:
            node = 0
            for at in range(0, len(path), STEP):
                key = node, path[at : at + STEP]
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                    self.words.append(int.from_bytes(key[1][-4:]))
                node = self.child[key]


def splitters(paths: DataFrame, shards: int | None = None) -> list[tuple[bytes, int]]:
    """(path, conv_id) of rows that cut the order of (path, conv_id) into shards of about SHARD bytes, from a sample.

    They decide where rows go and nothing else. The sample is SAMPLE rows a splitter and at most about SAMPLE_BYTES; splitters are thinned
    until they hold SPLITTERS bytes, so long paths mean fewer, larger shards.
    """
    rows, size = paths.agg(F.count(F.lit(1)), F.sum(F.octet_length("path") + 8)).first()
    if not rows:
        return []
    shards = shards or max(paths.sparkSession.sparkContext.defaultParallelism, -(-size // SHARD))
    share = min(1.0, SAMPLE * shards / rows, SAMPLE_BYTES / size)
    found = sorted((bytes(p), c) for p, c in paths.sample(fraction=share, seed=1).select("path", "conv_id").collect())
    while True:
        step_by = max(1, len(found) // shards)
        cut = found[step_by::step_by]
        if sum(len(p) + 8 for p, _ in cut) <= SPLITTERS:
            return cut
        shards = shards // 2
        if not shards:
            return []


class Node:
    __slots__ = ("children", "ends", "leaves", "least", "members", "pending", "place", "saved", "words")

    def __init__(self, words: int, place: int | None) -> None:
        self.place, self.words = place, words  # place: in the skeleton, if it is there
        self.least, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.pending = array("q"), []


#: kind ``node``: finished; ``part``: what a shard saw of a skeleton node; ``ends``: ids that end at a node, in order of (shard, chunk).
RECORDS = "kind string, place long, conv_id long, depth long, parent_place long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, shard long, chunk long, ids array<long>"
_NAMES = [c.split(" ")[0] for c in RECORDS.split(", ")]


class Shard:
    """Reads one shard's rows in order and gives its records. It holds the nodes of the current path and their finished children, which wait for the least id of their parent."""

    def __init__(self, number: int, skeleton: Skeleton) -> None:
        self.number, self.skeleton = number, skeleton
        self.path, self.stack, self.out, self.chunks = b"", [Node(0, 0)], [], 0

    def _emit(self, kind: str, **values) -> None:
        self.out.append({"kind": kind, "shard": self.number} | values)

    def _ends(self, node: Node, depth: int) -> None:
        for at in range(0, len(node.ends), IDS):
            self._emit("ends", place=node.place, conv_id=node.least, depth=depth, chunk=self.chunks, ids=list(node.ends[at : at + IDS]))
            self.chunks += 1
        node.ends = array("q")

    def _close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        self._ends(node, depth)
        if node.place is not None:
            self._emit("part", place=node.place, conv_id=node.least, depth=depth, n_convs=node.members, n_children=node.children, n_leaves=node.leaves, saved_tokens=node.saved)
        else:
            node.leaves = node.leaves if node.children else 1
            node.saved += (node.members - 1) * node.words
        for values in node.pending:
            self._emit("node", parent_conv_id=node.least, **values)
        if self.stack:
            up = self.stack[-1]
            up.members += node.members
            up.least = node.least if up.least is None else min(up.least, node.least)
            if node.place is None:  # the skeleton adds up its own nodes
                up.children, up.leaves, up.saved = up.children + 1, up.leaves + node.leaves, up.saved + node.saved
                values = {"conv_id": node.least, "depth": depth, "n_convs": node.members, "n_children": node.children, "n_leaves": node.leaves, "saved_tokens": node.saved}
                if up.place is None:
                    up.pending.append(values)
                else:  # its least id is not known here; a join finds it
                    self._emit("node", parent_place=up.place, **values)

    def add(self, path: bytes, conv_id: int) -> None:
        depth, most = 0, min(len(path), len(self.path))
        if path == self.path:
            depth = len(path) // STEP
        else:
            while (depth + 1) * STEP <= most and path[depth * STEP : (depth + 1) * STEP] == self.path[depth * STEP : (depth + 1) * STEP]:
                depth += 1
        while len(self.stack) > depth + 1:
            self._close()
        for at in range(depth * STEP, len(path), STEP):
            one, up = path[at : at + STEP], self.stack[-1].place
            self.stack.append(Node(int.from_bytes(one[-4:]), None if up is None else self.skeleton.child.get((up, one))))
        self.path, top = path, self.stack[-1]
        top.members += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        top.ends.append(conv_id)
        if top.place is not None and len(top.ends) >= IDS:
            self._ends(top, len(self.stack) - 1)

    def finish(self) -> None:
        while self.stack:
            self._close()

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        kinds = {"kind": pa.string(), "ids": pa.list_(pa.int64())}
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.int64())) for n in _NAMES], names=_NAMES)


def records(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The shards' records (see RECORDS)."""
    trie = paths.sparkSession.sparkContext.broadcast(skeleton)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = trie.value.splitters
        for batch in batches:
            shard = [bisect_right(cuts, key) for key in zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), batch["path"], batch["conv_id"]], names=["shard", "path", "conv_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for number, path, conv_id in zip(*(batch[c].to_pylist() for c in ("shard", "path", "conv_id")), strict=True):
                if now is None or now.number != number:
                    if now is not None:
                        now.finish()
                        yield now.taken()
                    now = Shard(number, trie.value)
                now.add(path, conv_id)
                if len(now.out) >= IDS:
                    yield now.taken()
        if now is not None:
            now.finish()
            yield now.taken()

    placed = paths.select("path", "conv_id").mapInArrow(place, "shard long, path binary, conv_id long")
    return placed.repartition(len(skeleton.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(run, RECORDS)


def reduced(parts: DataFrame, skeleton: Skeleton, spark: SparkSession) -> DataFrame:
    """The skeleton's nodes, from the sums of what the shards saw of them: place and the columns of nodes.

    Shards' parts are added up in Spark, to a row a node: at most SPLITTERS / STEP rows. The driver then adds children to their parents, the deepest first.
    """
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    rows = parts.groupBy("place").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums).collect()
    by = {r["place"]: r.asDict() for r in rows}
    below = np.bincount(np.array(skeleton.parent[1:], np.int64), minlength=len(skeleton.parent)) if len(skeleton.parent) > 1 else [0]
    for p in sorted(by, reverse=True):  # a child's place is greater than its parent's
        node = by[p]
        node["n_children"] += int(below[p])
        node["n_leaves"] += 0 if node["n_children"] else 1
        node["saved_tokens"] += (node["n_convs"] - 1) * skeleton.words[p]
        if p:
            by[skeleton.parent[p]]["n_leaves"] += node["n_leaves"]
            by[skeleton.parent[p]]["saved_tokens"] += node["saved_tokens"]
    names = ["place", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    made = [[n[c] if c != "parent_conv_id" else (by[skeleton.parent[n["place"]]]["conv_id"] if n["place"] else None) for c in names] for n in by.values()]
    return spark.createDataFrame(made, ", ".join(f"{c} long" for c in names))


def prefix_trie(convs: DataFrame, *, shards: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of ``convs`` (conv_id, steps; see conversations, rebuilt).

    nodes: conv_id (the node's least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes below it or itself),
    saved_tokens (over the node and all below it, (n_convs - 1) times the words of its last text). ends: conv_id, depth, shard, chunk, ids: the
    members whose last turn is the node's, ascending in the order of (shard, chunk), IDS a row at most, so a node where a third of all conversations end is many rows.

    Conversations without turns are members of the root only. Null roles and texts are empty. An empty table has no root and gives no rows. A
    conversation's path is one value of STEP bytes a turn; texts of any length are hashed where they stand.
    """
    spark = convs.sparkSession
    paths = written(convs.select("conv_id", F.unhex(F.array_join("steps", "")).alias("path")), "paths")
    skeleton = Skeleton(splitters(paths, shards))
    found = written(records(paths, skeleton), "trie")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    top = reduced(found.where("kind = 'part'"), skeleton, spark)
    known = F.broadcast(top.select(F.col("place").alias("_place"), F.col("conv_id").alias("_least")))  # at most SPLITTERS / STEP rows
    below = found.where("kind = 'node'").join(known, F.col("parent_place") == F.col("_place"), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_least"))
    ends = found.where("kind = 'ends'").join(known, F.col("place") == F.col("_place"), "left")
    return below.select(names).union(top.select(names)), ends.select(F.coalesce("_least", "conv_id").alias("conv_id"), "depth", "shard", "chunk", "ids")


def ends_digest(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256: SHA-256 of the decimal ids that end at a node, ascending and comma-joined.

    A digest reads its text in order, so the ids of one node go through one task: as a stream, in rows of IDS ids, and never as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for batch in batches:
            for c, d, ids in zip(*(batch[n].to_pylist() for n in ("conv_id", "depth", "ids")), strict=True):
                if node != (c, d):
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (c, d), hashlib.sha256(b"")
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, ids)).encode())
            yield _rows(out)
            out = []
        if node:
            yield _rows([(*node, digest.hexdigest())])

    order = ["conv_id", "depth", "shard", "chunk"]
    return ends.repartition("conv_id", "depth").sortWithinPartitions(*order).select(*order, "ids").mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def _rows(out: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "ends_sha256"])
