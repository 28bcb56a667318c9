"""Two tokenizers' tokens over the same bytes: groups between common ends, and how often ids are linked.

A is a byte-level BPE vocabulary that sees a blank and the text, B a piece BPE vocabulary that sees the text and adds the blank. Neither has a token
that spans the place between a character and a blank after it, so both give a text's stretches (a blank and what stands up to the next one)
their tokens one by one, and all groups lie inside stretches. A block of texts is tokenized and aligned by its distinct stretches.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedjobs.llm.shared import kept, release, written

#: Bytes of text that are aligned at once (a longer text stands alone).
BLOCK = 4_000_000
#: Distinct stretches that are tokenized as one text.
JOINED = 2000
#: Strides of the walk over the shorter list of ends.
STRIDES = (256, 16, 1)
#: Pairs of a group that are written out one by one; a group of more is counted by its distinct ids.
PAIRS = 4096

# White space as Unicode has it, and the blank of the piece vocabulary.
WHITE = "\t-\r \x85\xa0  -     　"
LOWER_BLOCK = "▁"
#: How byte-level BPE splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_CUT = re.compile(f"(?<=[^{WHITE}])(?= )")


def gallop(x: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Where each of ``x`` stands, or would stand, in the sorted ``y``, which is at ``start`` or later.

    Steps double until they reach past the value, then the last step is halved down; all values walk at once.
    """
    if not len(y):
        return np.zeros(len(x), np.int64)
    low, step, live = start.astype(np.int64) - 1, np.ones(len(x), np.int64), np.arange(len(x))  # y[low] < x
    high = low + 1
    while len(live):
        at = high[live]
        live = live[(at < len(y)) & (y[np.minimum(at, len(y) - 1)] < x[live])]
        low[live] = high[live]
        step[live] *= 2
        high[live] = low[live] + step[live]
    high = np.minimum(high, len(y))
    live = np.flatnonzero(high - low > 1)
    while len(live):
        mid = (low[live] + high[live]) >> 1
        less = y[mid] < x[live]
        low[live[less]], high[live[~less]] = mid[less], mid[~less]
        live = live[high[live] - low[live] > 1]
    return high


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both sorted lists hold. The shorter one drives the search in the longer.

    Every 256th value is looked for from the place of the one before it, then every 16th between those, then all.
    """
    if len(a) > len(b):
        j, i = common_ends(b, a)
        return i, j
    found = np.zeros(len(a), np.int64)
    for k, stride in enumerate(STRIDES):
        these = np.arange(0, len(a), stride)
        # the first walk starts where the value would stand if both lists were even, if that is not past it
        start = found[these - these % STRIDES[k - 1]] if k else np.maximum.accumulate(_even(a[these], b))
        found[these] = gallop(a[these], b, start)
    some = found < len(b)
    some[some] = b[found[some]] == a[some]
    return np.flatnonzero(some), found[some]


def _even(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    guess = (x * (len(y) / max(1, int(y[-1]) if len(y) else 1)) * 0.9).astype(np.int64).clip(0, max(0, len(y) - 1))
    return np.where((guess > 0) & (y[np.maximum(guess - 1, 0)] < x), guess, 0) if len(y) else guess


class Vocabularies:
    """Both tokenizers in a Python worker, and the bytes of their tokens."""

    def __init__(self, a: str, b: str) -> None:
        import sentencepiece
        import tiktoken

        with open(a, encoding="utf-8") as f:
            model = json.load(f)["model"]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(c): c for c in visible} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in visible)}
        self.a = {i: bytes(map(shown.__getitem__, token)) for token, i in model["vocab"].items() if all(c in shown for c in token)}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if [model["vocab"][m] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("the ids of the byte-level vocabulary are not the order of its merges")
        ranks = {t: i for i, t in self.a.items() if i < 256 + len(merges)}
        self.of_a = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        self.of_b = pieces.encode
        self.b = {i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace(LOWER_BLOCK, " ").encode() for i in range(pieces.vocab_size())}
        spanning = [i for i in range(pieces.vocab_size()) if re.search(f"[^{LOWER_BLOCK}]{LOWER_BLOCK}", pieces.id_to_piece(i))]
        if spanning:
            raise ValueError("the piece vocabulary has tokens that span a blank")
        self.sizes = tuple(np.array([len(t.get(i, b"")) for i in range(max(t) + 1)], np.int64) for t in (self.a, self.b))
        self.digits = np.array([f"{i:<9}".encode() for i in range(max(map(len, self.sizes)))], "S9").view(np.uint8).reshape(-1, 9)
        self.width = (self.digits != 32).sum(1)

    def tokens(self, words: list[str], plain: np.ndarray) -> tuple[np.ndarray, ...]:
        """The order in which the words (what stands after the blank of each stretch) are taken; then, in this order, all ids by A, how many each
        word has, the same by B, and whether the bytes of both are the stretch's.

        Words that are ``plain`` (no white space at either end) are tokenized together; the others one by one, in both cases with the blank.
        """
        alone, order, good = np.flatnonzero(~plain).tolist(), [], []
        sides: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]

        def take(some: list[int], *made: np.ndarray, ok: bool = True) -> None:
            order.extend(some)
            good.extend([ok] * len(some))
            for side, part in zip(sides, made, strict=True):
                side.append(part)

        plain_ones = np.flatnonzero(plain).tolist()
        for at in range(0, len(plain_ones), JOINED):
            some = plain_ones[at : at + JOINED]
            text = " ".join([words[i] for i in some])
            ends = np.cumsum([len(words[i].encode()) + 1 for i in some])
            whole, made = b" " + text.encode(), []
            for ids, size, table in ((self.of_a(" " + text), self.sizes[0], self.a), (self.of_b(text), self.sizes[1], self.b)):
                if b"".join(map(table.__getitem__, ids)) == whole:
                    ids = np.array(ids, np.int64)
                    made += [ids, np.diff(np.searchsorted(np.cumsum(size[ids]), ends) + 1, prepend=0)]
            if len(made) == 4:
                take(some, *made)
            else:
                alone += some
        for i in alone:
            stretch = " " + words[i]
            a, b = self.of_a(stretch), self.of_b("\n" + stretch)[2:]  # after a line end B adds no blank of its own
            ok = b"".join(map(self.a.__getitem__, a)) == b"".join(map(self.b.__getitem__, b)) == stretch.encode()
            a, b = (a, b) if ok else ([], [])
            take([i], *(np.array(x, np.int64) for x in (a, [len(a)], b, [len(b)])), ok=ok)
        return np.array(order, np.int64), *map(np.concatenate, sides), np.array(good, bool)


def vocabularies(a: str, b: str) -> Vocabularies:
    return kept((a, b), lambda: Vocabularies(a, b))


class Stretches:
    """Distinct stretches of a block, aligned: for each the sizes, its groups as text, and its linked id pairs."""

    def __init__(self, words: pa.Array, vocab: Vocabularies) -> None:
        names = words.to_pylist()
        plain = pc.invert(pc.match_substring_regex(words, f"^[{WHITE}]|[{WHITE}]$|^$")).to_numpy(zero_copy_only=False)
        order, a, self.a_n, b, self.b_n, self.good = vocab.tokens(names, plain)
        n = len(names)
        self.place = np.empty(n, np.int64)  # from a word to its stretch
        self.place[order] = np.arange(n)
        a_end, b_end = np.cumsum(vocab.sizes[0][a]), np.cumsum(vocab.sizes[1][b])
        i, j = common_ends(a_end, b_end)
        na, nb = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        a_of = np.repeat(np.arange(n), self.a_n)
        owner = a_of[i]  # the stretch of each group
        self.groups = np.bincount(owner, minlength=n)
        self.links = np.bincount(owner, na * nb, n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)
        self.text = self._text(vocab, a, b, i, j, na, nb)
        self._pairs(a, b, i - na + 1, j - nb + 1, na, nb, owner, len(vocab.sizes[1]))

    def _text(self, vocab: Vocabularies, a, b, i, j, na, nb) -> list[bytes]:
        """The groups of each stretch: ``a1,a2|b1;a3|b2,b3``."""
        total = len(a) + len(b)
        group_a, group_b = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
        place_a = np.arange(len(a)) + (j - nb + 1)[group_a]  # after the B tokens of earlier groups
        place_b = np.arange(len(b)) + (i + 1)[group_b]
        ids, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[i]], mark[place_b[j]] = ord("|"), ord(";")
        width = vocab.width[ids]
        ends = np.cumsum(width + 1)
        out = np.empty(ends[-1] if total else 0, np.uint8)
        start = ends - width - 1
        for k in range(int(width.max(initial=0))):
            some = width > k
            out[start[some] + k] = vocab.digits[ids[some], k]
        out[ends - 1] = mark
        whole, cuts = out.tobytes(), np.r_[0, ends][np.cumsum(np.r_[0, self.a_n + self.b_n])].tolist()
        return [whole[x : y - 1] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]

    def _pairs(self, a, b, a_at, b_at, na, nb, owner, many: int) -> None:
        """Sets pairs (distinct ids ``a * many + b``, sorted) and, by stretch, entries: pair (its place) and times, with their bounds."""
        small = na * nb <= PAIRS
        x, y, of, p, q = na[small], nb[small], owner[small], a_at[small], b_at[small]
        n = x * y
        group = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        pair = a[p[group] + nth // y[group]] * many + b[q[group] + nth % y[group]]
        parts = [(of[group], pair, np.ones(len(pair), np.int64))]
        for g in np.flatnonzero(~small):
            (u, cu), (v, cv) = (np.unique(s[at[g] : at[g] + k[g]], return_counts=True) for s, at, k in ((a, a_at, na), (b, b_at, nb)))
            parts.append((np.full(len(u) * len(v), owner[g]), (u[:, None] * many + v).ravel(), (cu[:, None] * cv).ravel()))
        of, pair, times = (np.concatenate(c) for c in zip(*parts, strict=True))
        if len(parts) > 1:
            order = np.argsort(of, kind="stable")
            of, pair, times = of[order], pair[order], times[order]
        self.pairs, self.entry = np.unique(pair, return_inverse=True)
        self.times = times
        self.bounds = np.searchsorted(of, np.arange(len(self.a_n) + 1))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of the stretches that begin at ``first``, one after another."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _cut_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The order in which texts are taken, their words (what stands after the blank of each stretch), and how many each has."""
    odd = pc.match_substring_regex(texts, f"^ |[{WHITE}] ").to_numpy(zero_copy_only=False)
    easy, hard = np.flatnonzero(~odd), np.flatnonzero(odd)
    split = pc.split_pattern(texts.take(pa.array(easy)), " ")
    cut = [[s[1:] for s in _CUT.split(" " + t)] for t in texts.take(pa.array(hard)).to_pylist()]
    words = pa.concat_arrays([split.flatten(), pa.array([w for c in cut for w in c], texts.type)])
    return np.r_[easy, hard], words, np.r_[np.diff(split.offsets.to_numpy()).astype(np.int64), np.array([len(c) for c in cut], np.int64)]


_SIZES = ["n_a", "n_b", "n_groups", "n_links"]


def _align_block(texts: pa.Array, vocab: Vocabularies, digest: bool) -> tuple[np.ndarray, dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts that are neither null nor empty: their order, sizes, groups; the block's pairs, in how many texts each is linked, and which text
    links which pair how often: numbers (text * pairs + pair), sorted, and times."""
    order, words, count = _cut_words(texts)
    coded = words.dictionary_encode()
    known = Stretches(coded.dictionary, vocab)
    code = known.place[coded.indices.to_numpy()]
    first = np.cumsum(count) - count
    good = np.logical_and.reduceat(known.good[code], first)
    add = lambda values: np.where(good, np.add.reduceat(values[code], first), 0)
    sizes = dict(zip(_SIZES, map(add, (known.a_n, known.b_n, known.groups, known.links)), strict=True))
    groups = []
    for ok, at, n in zip(good, first, count, strict=True):
        text = b";".join(map(known.text.__getitem__, code[at : at + n].tolist())) if ok else b""
        groups.append((hashlib.sha256(text).hexdigest() if digest else text.decode()) if ok else "")

    many, doc = len(known.pairs), np.repeat(np.arange(len(count)), count)
    live = good[doc]
    code, doc = code[live], doc[live]
    n = np.diff(known.bounds)[code]
    entry = _spread(known.bounds[code], n)
    key, times = np.repeat(doc, n) * many + known.entry[entry], known.times[entry]
    one = times == 1
    keys, counts = np.unique(key[one], return_counts=True)
    if not one.all():
        keys, back = np.unique(np.r_[keys, key[~one]], return_inverse=True)
        counts = np.bincount(back, np.r_[counts, times[~one]], len(keys)).astype(np.int64)
    texts_with = np.bincount(keys % many, minlength=many) if many else np.zeros(0, np.int64)
    return order, sizes, groups, known.pairs, texts_with, keys, counts


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers in few bytes; _unpacked gives them back."""
    raw = b"".join([np.array([len(x) for x in arrays], "<i8").tobytes(), *[x.astype("<i8").tobytes() for x in arrays]])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True), "<i8")
    return np.split(raw[n:], np.cumsum(raw[:n])[:-1])


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    ends, at = np.r_[0, np.cumsum(sizes)], 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, "right")) - 1)
        yield at, to
        at = to


def blocks(docs: DataFrame, a: str, b: str, *, digest: bool = False) -> DataFrame:
    """Blocks of texts, each a row: block, docs (an array: doc_id, the sizes, groups), linked (who links what, packed), pairs and documents (how many of the block link each pair)."""
    own = docs.schema["doc_id"].dataType
    kinds = [T.StructField("doc_id", own), *[T.StructField(c, T.LongType()) for c in _SIZES], T.StructField("groups", T.StringType())]
    schema = T.StructType([T.StructField("block", T.LongType()), *[T.StructField(f.name, T.ArrayType(f.dataType)) for f in kinds], T.StructField("linked", T.BinaryType()), T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("documents", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, number = vocabularies(a, b), TaskContext.get().partitionId() << 32
        for batch in batches:
            text = batch["text"].fill_null("")
            for low, high in _blocks(pc.binary_length(text).to_numpy()):
                texts, ids = text.slice(low, high - low), batch["doc_id"].slice(low, high - low)
                some = np.flatnonzero(pc.binary_length(texts).to_numpy() > 0)
                rest = np.setdiff1d(np.arange(len(texts)), some)
                sizes, groups, pairs, documents, keys, counts, order = {c: np.zeros(0, np.int64) for c in _SIZES}, [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                if len(some):
                    order, sizes, groups, pairs, documents, keys, counts = _align_block(texts.take(pa.array(some)), vocab, digest)
                none = np.zeros(len(rest), np.int64)
                columns = [ids.take(pa.array(np.r_[some[order], rest].astype(np.int64))), *[pa.array(np.r_[sizes[c], none]) for c in _SIZES], pa.array([*groups, *[""] * len(rest)], pa.string())]
                linked = _packed(np.diff(keys, prepend=0), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), *[pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), c) for c in columns], pa.array([linked], pa.binary()), *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in (pairs, documents)]],
                    names=schema.names,
                )
                number += 1
        release()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(made: DataFrame, many: int) -> DataFrame:
    """pair (A id * many + B id), count (documents of the corpus that link it), best (no other pair of its A id has more), from blocks()."""
    rows = made.select(F.explode(F.arrays_zip("pairs", "documents")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.documents").alias("n"))
    counts = rows.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.floor(F.col("pair") / many))
    top = counts.groupBy("a").agg(F.max("count").alias("_top"))
    return counts.join(top, "a").select("pair", "a", (F.col("pair") % many).alias("b"), "count", (F.col("count") == F.col("_top")).alias("best"))


def vocabulary_size(path: str) -> int:
    """Of a piece vocabulary."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).vocab_size()


def align(docs: DataFrame, a: str, b: str, *, digest: bool = False) -> DataFrame:
    """One row a document: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair is best for its A id), count_sum (of all links' counts), groups.

    groups is the text ``a1,a2|b1;a3|b2,b3`` of A and B ids, or with ``digest`` its SHA-256. A pair's count is the number of documents that link it, so
    repeated rows count as often as they stand. Texts that are null or empty, or whose tokens' bytes are not a blank and the text, have zeros
    and '', and link nothing. Texts of any length are read whole; other columns are not read. An empty table gives no rows.

    Counts are added up a block of texts at a time, and go back to blocks, not to documents or links: what moves is one row for each
    distinct pair of a block.
    """
    made = written(blocks(docs, a, b, digest=digest), "blocks")
    many = vocabulary_size(b)
    counts = written(pair_counts(made, many).select("pair", "count", "best"), "pairs")
    rows = made.select("block", F.posexplode("pairs").alias("place", "pair"))
    back = rows.join(counts, "pair").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("found"))
    names = ["doc_id", *_SIZES, "groups"]
    joined = made.select("block", *names, "linked").join(back, "block", "left").select(*names, "linked", F.col("found.count").alias("counts"), F.col("found.best").alias("best"))
    fields = [T.StructField(f.name, f.dataType.elementType) for f in made.schema.fields if f.name in names]
    schema = T.StructType([*fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                columns = [row[c].flatten() for c in names]
                n, sums = len(columns[0]), [np.zeros(len(columns[0]), np.int64)] * 2
                step, times = _unpacked(row["linked"][0].as_py(), 2)
                if len(step):
                    count, best = (row[c].flatten().to_numpy(zero_copy_only=False) for c in ("counts", "best"))
                    key = np.cumsum(step)
                    pair, cuts = key % len(count), np.searchsorted(key, np.arange(n + 1) * len(count))
                    sums = [np.diff(np.r_[0, np.cumsum(times * v[pair])][cuts]) for v in (best.astype(np.int64), count)]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, sums)], names=schema.names)

    return joined.mapInArrow(run, schema)
