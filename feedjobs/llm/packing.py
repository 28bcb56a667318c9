"""Mixture-controlled packing: deficit round-robin over source queues."""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedjobs.llm.shared import kept, release, written

#: Queues that the sources too small for one of their own share, by a hash of their name.
SHARED_QUEUES = 128
#: Pieces and rare words that a worker remembers in each of two generations; one that is met again stays.
MAX_WORDS = 150_000
#: Bytes of text that are split into words at once (a longer text stands alone), and words whose ids are put out at once.
BLOCK, WORDS = 8_000_000, 250_000
#: Most rows of the table of partition totals that are broadcast; a larger table is joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Fractional bits of a quantum.
BITS = 16
#: Ids of a queue whose number still has room for these bits and a quantum's.
MOST = 1 << 45

# How this vocabulary's file splits lower-case text; what its special tokens begin with.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\pL]+|[\pN]|[^\s\pL\pN]+"
SPECIAL = "<\\|"
#: Separators to Arrow that the vocabulary's file does not take for white space.
NO_SPACE = "[\x1c-\x1f]"
#: Words that go through the whole tokenizer: letters that Arrow may compose or lower in another way, and special tokens.
RARE = f"[^!-~¡-ɏ]|İ|{SPECIAL}"


def _gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``first``, one after another."""
    ends = np.cumsum(size)
    return flat[np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class WordIds:
    """Ids of whole texts, by way of their distinct words and the distinct pieces of these.

    The vocabulary's normalizer and splitter never look across white space, so a text's ids are its words' ids in
    turn, and a word's are those of the pieces that the vocabulary's pattern cuts it into. Arrow splits a block of texts and
    finds its distinct words and pieces; only the pieces are looked up here, one by one, and the BPE model is asked
    for those that are not known. Rare words go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level BPE writes these bytes as themselves
        hidden = [b for b in range(256) if b not in visible]
        self.shown = {b: chr(256 + i) for i, b in enumerate(hidden)}

    def _of_piece(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.shown))]

    def _of_word(self, word: str) -> list[int]:
        return self.whole.encode(word, add_special_tokens=False).ids

    def _known(self, words: pa.Array, make: Callable[[str], list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of these words or pieces, and where each one's begin and how many they are."""
        names = words.to_numpy(zero_copy_only=False)
        found = list(map(self.new.get, names))
        for i in [i for i, f in enumerate(found) if f is None]:
            name = names[i]
            found[i] = self.old.get(name)
            if found[i] is None:
                found[i] = array("I", make(name)).tobytes()
            if len(self.new) >= MAX_WORDS:
                self.old, self.new = self.new, {}
            self.new[name] = found[i]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size, size

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As _known, by way of the words' pieces."""
        rare = pc.match_substring_regex(words, RARE)
        low = pc.utf8_lower(pc.if_else(rare, "", words))
        pieces = pc.utf8_split_whitespace(pc.replace_substring_regex(low, PIECE, r"\0 "))
        coded = pieces.flatten().dictionary_encode()
        flat, first, size = self._known(coded.dictionary, self._of_piece)
        at = coded.indices.to_numpy()
        flat, ends = _gather(flat, first[at], size[at]), np.r_[0, np.cumsum(size[at])]
        ends = ends[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()]
        first, size = ends[:-1], np.diff(ends)
        odd = np.flatnonzero(rare.to_numpy(zero_copy_only=False))
        more, begin, size[odd] = self._known(words.take(pa.array(odd)), self._of_word)
        first[odd] = begin + len(flat)
        return np.concatenate([flat, more]), first, size

    def of_texts(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text with ``end`` after each, and how many each text has."""
        odd = pc.match_substring_regex(texts, NO_SPACE)
        words = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        coded = words.flatten().dictionary_encode()
        flat, first, size = self._of_words(coded.dictionary)
        at = coded.indices.to_numpy()
        ids = [_gather(flat, first[some], size[some]) for some in (at[i : i + WORDS] for i in range(0, len(at), WORDS))]
        before = np.r_[0, np.cumsum(size[at])][words.offsets.to_numpy() - words.offsets[0].as_py()]
        count = np.diff(before) + 1
        out = np.full(count.sum(), end, "<u4")
        place = np.ones(len(out), bool)
        place[np.cumsum(count) - 1] = False
        out[place] = np.concatenate([np.zeros(0, "<u4"), *ids])
        if not pc.any(odd).as_py():
            return out, count
        parts = np.split(out, np.cumsum(count)[:-1])
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            parts[i] = np.array([*self._of_word(texts[int(i)].as_py()), end], "<u4")
        return np.concatenate(parts), np.array([len(p) for p in parts])


def word_ids(path: str) -> WordIds:
    """One per Python worker, which Spark uses for many tasks."""
    return kept(path, lambda: WordIds(path))


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    ends, at = np.r_[0, np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, "right")) - 1)
        yield at, to
        at = to


def queues(docs: DataFrame, source: str, *, window: int, grain: int, named: tuple[str | None, ...] = ()) -> tuple[Callable[[str | None], int], int]:
    """From a source to its queue's number, and the number of queues.

    A source that holds ``grain / window`` of all bytes or more, so that it can give each window a grain, has a queue of its own, as have
    those of ``named``: that many at most. All smaller ones share SHARED_QUEUES by a hash of their name. Own
    queues stand by code point, null last.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    sizes = written(docs.select(F.col(source).alias("source"), size.alias("size")).groupBy("source").agg(F.sum("size").alias("size")), "sources")
    whole = sizes.agg(F.sum("size")).first()[0] or 0
    large = [r[0] for r in sizes.where(F.col("size") >= -(-whole * grain // window)).select("source").collect()]  # window / grain at most
    own = {name: i for i, name in enumerate(sorted({*large, *named}, key=lambda s: (s is None, s or "")))}
    return lambda name: own[name] if name in own else len(own) + zlib.crc32((name or "").encode()) % SHARED_QUEUES, len(own) + SHARED_QUEUES


def tokenize(docs: DataFrame, path: str, queue: Callable[[str | None], int], *, end_id: int, source: str = "source", extra: list[str] | None = None) -> DataFrame:
    """Ids of each whole text, then ``end_id``; a null text counts as empty.

    Returns doc_id, queue, part, before (ids of this queue that this partition had before),
    doc_tokens, ids (little-endian unsigned 32 bit) and the columns of ``extra``.
    """
    extra = extra or []
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col(source).alias("_source"), *extra)
    own = [rows.schema["doc_id"], *[rows.schema[c] for c in extra]]
    schema = T.StructType([*own, T.StructField("queue", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, done = word_ids(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for low, high in _blocks(batch["text"]):
                some = batch.slice(low, high - low)
                ids, sizes = cache.of_texts(some["text"], end_id)
                numbers, before = [queue(s) for s in some["_source"].to_pylist()], []
                for q, n in zip(numbers, sizes.tolist(), strict=True):
                    before.append(done[q])
                    done[q] += n
                bounds = pa.py_buffer(np.r_[0, np.cumsum(sizes * 4)].astype(np.int32))
                column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, bounds, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [*[some[f.name] for f in own], pa.array(numbers, pa.int32()), pa.array([part] * len(sizes), pa.int32()), pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), column],
                    names=schema.names,
                )
        release()

    return rows.mapInArrow(run, schema)


def quanta(totals: np.ndarray, window: int, shares: np.ndarray | None = None) -> np.ndarray:
    """Ids that each queue may give a window, in fixed point with BITS fractional bits."""
    shares = totals if shares is None else shares
    whole = sum(map(int, shares)) or 1
    return np.array([max(1, int(s) * (window << BITS) // whole) for s in shares], np.int64)


def cut(first: np.ndarray, last: np.ndarray, queue: np.ndarray, totals: np.ndarray, quantum: np.ndarray, grain: int, window: int) -> tuple[np.ndarray, ...]:
    """Cut the documents that hold ids ``first`` to ``last`` (excluded) of their queue into pieces.

    In round r a queue's deficit has grown to ``r * quantum`` less what it has given. It gives
    all whole grains of that and carries the rest, so after r rounds it
    has given ``given(r) = min(total, floor(r * quantum / grain) * grain)``. The rounds,
    one after another, make one stream, and each window takes the next ``window`` ids of it. As
    given(r) needs no earlier round, any task can place any piece, and deficits pass
    across windows and partitions.

    Returns per piece: document (its place in the input), first id, length, window, offset.
    """
    if len(totals) and totals.max() >= MOST:
        raise ValueError(f"a queue holds {totals.max()} ids; more than {MOST} need a smaller BITS")
    low, high = first // grain, (last - 1) // grain
    count = high - low + 1
    doc = np.repeat(np.arange(len(first)), count)
    unit = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[doc]
    rounds = -((-((unit + 1) * grain << BITS)) // quantum[queue[doc]]) - 1
    head = np.r_[True, (doc[1:] != doc[:-1]) | (rounds[1:] != rounds[:-1])][: len(doc)]
    doc, rounds = doc[head], rounds[head]
    start = np.maximum(first[doc], unit[head] * grain)
    ends = np.r_[start[1:], 0][: len(doc)]
    final = np.r_[doc[1:] != doc[:-1], True][: len(doc)]
    length = np.where(final, last[doc], ends) - start
    own, place, number = queue[doc], start.copy(), np.arange(len(totals))
    some = max(1, (1 << 20) // max(1, len(totals)))
    rounds_of = -((-(-(-totals // grain) * grain) << BITS) // quantum)  # by then a queue has given all it has, so no product is above that and a quantum
    for a in range(0, len(doc), some):  # what all other queues have given by then: those before this one a round more
        turn = np.minimum(rounds[a : a + some, None] + (number < own[a : a + some, None]), rounds_of)
        given = np.minimum((turn * quantum >> BITS) // grain * grain, totals)
        given[np.arange(len(given)), own[a : a + some]] = 0
        place[a : a + some] += given.sum(1)
    pieces = (place + length - 1) // window - place // window + 1
    doc, start, place, length = (np.repeat(x, pieces) for x in (doc, start, place, length))
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.where(nth > 0, (place // window + nth) * window, place)
    stop = np.minimum((place // window + nth + 1) * window, place + length)
    return doc, start + begin - place, stop - begin, begin // window, begin % window


def pack(docs: DataFrame, path: str, *, window: int = 2048, end_id: int = 1, grain: int = 16, shares: dict[str, float] | None = None, source: str = "source", extra: list[str] | None = None) -> DataFrame:
    """Pack all documents into windows of ``window`` ids; one row a piece.

    Returns doc_id, start, length, ids, doc_tokens, sequence_id, offset, and the columns of
    ``extra``. Every id lies in one piece; all windows but the last are full. A window's ids come from
    the sources in proportion to ``shares`` (the default: to all their ids, so that all queues end
    together), but for less than a grain a source. A source that ends
    leaves its share to the others. A source that ``shares`` leaves out gives next to nothing (1 / 2**16 of an id a window) until the others end. Sources too small to give each window a grain share queues (see queues).

    Null and empty texts are one ``end_id``; null sources are one queue; repeated rows are
    packed as often as they stand. Texts of any length are cut over as many windows as they
    need. An empty table gives no rows.
    """
    extra = extra or []
    queue, many = queues(docs, source, window=window, grain=grain, named=tuple(shares or ()))
    tokens = written(tokenize(docs, path, queue, end_id=end_id, source=source, extra=extra), "ids")
    parts = written(tokens.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("_n")), "parts")
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(F.col("queue").alias("_q"), F.col("part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    totals = np.zeros(many, np.int64)
    for q, n in parts.groupBy("queue").agg(F.sum("_n")).collect():  # a row a queue
        totals[q] = n
    wanted = None
    if shares is not None:
        wanted = np.zeros(many)
        for name, share in shares.items():
            wanted[queue(name)] += share
        wanted = (wanted * (1 << 20)).astype(np.int64)
    some = totals > 0
    rank, quantum, totals = np.cumsum(some) - 1, quanta(totals, window, wanted)[some], totals[some]
    if parts.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = tokens.join(bases, (F.col("queue") == F.col("_q")) & (F.col("part") == F.col("_p"))).select("doc_id", *extra, "queue", (F.col("_base") + F.col("before")).alias("first"), "doc_tokens", "ids")
    own = [placed.schema["doc_id"], *[placed.schema[c] for c in extra]]
    schema = T.StructType([*own, *[T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")], T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                first, n = (batch[c].to_numpy() for c in ("first", "doc_tokens"))
                doc, start, length, sequence, offset = cut(first, first + n, rank[batch["queue"].to_numpy()], totals, quantum, grain, window)
                data = pa.py_buffer(b"".join(batch["ids"].to_pylist()))
                bounds = pa.py_buffer(np.r_[0, np.cumsum(length * 4)].astype(np.int32))  # pieces follow one another as the ids do
                ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, bounds, data])
                numbers = [pa.array(x.astype(np.int64)) for x in (start - first[doc], length, n[doc], sequence, offset)]
                yield pa.RecordBatch.from_arrays([*[batch[f.name].take(pa.array(doc)) for f in own], *numbers, ids], names=schema.names)
        release()

    return placed.mapInArrow(run, schema)


def sequences(pieces: DataFrame, *, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids (as bytes), tokens: the windows put together, padded unless their length is a power of two."""
    full = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"), F.sum("length").alias("tokens"))
    ids = F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    even = F.bit_count("tokens") == 1
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), F.when(even, 0).otherwise(window - F.col("tokens")).cast("int")))
    return full.select("sequence_id", F.concat(ids, pad).alias("ids"), "tokens")
