"""Language identification by bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedjobs.llm.shared import slices, written

#: Lengths of n-grams. A word's ends count as a blank.
SIZES = (1, 2, 3, 4)
#: Documents of each language that the filters are learned from, about (those whose ids hash lowest; all, if there are fewer).
SAMPLE = 600
#: A language holds an n-gram if it uses it at least so often, against the language that uses it most.
SHARE = 0.35
#: Slots of the filter (a power of two), and probes of each n-gram.
SLOTS, PROBES = 1 << 18, 2
#: Characters that are worked on at once.
BLOCK = 500_000


def held_out(doc_id: Column) -> Column:
    """False for a null id, from which nothing is learned either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@functools.cache
def _letters() -> np.ndarray:
    """From a code point to its lower-case letter, or 0 if it is none."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            table[c] = ord(s.lower()[0])
    return table


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts with one 0 wherever others stood, and where each text begins. A text starts and ends with 0."""
    joined = "\0" + "\0\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 2 for t in texts])
    begins = np.cumsum(sizes) - sizes
    letters = _letters()[points]
    keep = letters > 0
    keep[1:] |= letters[:-1] > 0
    keep[begins] = True
    before = np.cumsum(keep) - keep
    return letters[keep], before[begins]


def _hashes(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each n-gram that ends at a place, and whether it counts: a blank stands at its ends only, and not alone."""
    h = np.full(len(codes), n, np.uint64)
    fine = np.ones(len(codes), bool)
    fine[: n - 1] = False
    blank = codes == 0
    for i in range(n):
        h[n - 1 :] = (h[n - 1 :] ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        if n < 3 or 0 < i < n - 1:
            fine[n - 1 :] &= ~blank[i : len(codes) - n + 1 + i] if n != 2 else True
    if n == 2:
        fine[1:] &= ~(blank[1:] & blank[:-1])
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h, fine


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about BLOCK characters; a longer text stands alone."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > BLOCK:
            yield at, i
            at, size = i, 0
        size += len(t)
    if texts:
        yield at, len(texts)


@dataclass
class Filters:
    """The languages (bit 0 first), the slots' bitmasks and each language's share of slots with its bit."""

    languages: list[str]
    slots: np.ndarray
    filled: np.ndarray

    def masks(self, h: np.ndarray) -> np.ndarray:
        """All languages that hold each n-gram (and some false ones)."""
        found = self.slots[(h >> np.uint64(40)) % np.uint64(SLOTS)]
        for i in range(1, PROBES):
            found &= self.slots[((h >> np.uint64(40 - 20 * i)) ^ (h << np.uint64(7))) % np.uint64(SLOTS)]
        return found

    def scores(self, texts: list[str]) -> np.ndarray:
        """For each text and language the share of n-grams that it holds, corrected for false positives; -1 without letters."""
        out = np.full((len(texts), max(1, len(self.languages))), -1.0)
        for low, high in _blocks(texts):
            codes, begins = _codes(texts[low:high])
            hits, count = np.zeros((high - low, len(self.languages))), np.zeros(high - low)
            for n in SIZES:
                h, fine = _hashes(codes, n)
                fine_n = np.add.reduceat(fine, begins, dtype=np.int64)
                count += fine_n
                masks = self.masks(h)
                masks[~fine] = 0
                for word in range(self.slots.shape[1]):
                    mask = masks[:, word]
                    for bit, i in enumerate(range(word * 64, min(len(self.languages), word * 64 + 64))):
                        hits[:, i] += np.add.reduceat((mask >> mask.dtype.type(bit)) & mask.dtype.type(1), begins, dtype=np.int64)
            some = count > 0
            if self.languages:
                share, false = hits[some] / count[some, None], self.filled**PROBES
                out[low:high][some] = np.clip((share - false) / np.maximum(1 - false, 1e-9), 0, 1)
            else:
                out[low:high][some] = 0
        return out


def _counts(rows: DataFrame) -> DataFrame:
    """lang, gram, n over (text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.to_pandas()
            for lang, texts in table.groupby("lang")["text"]:
                texts = texts.tolist()
                for low, high in _blocks(texts):
                    codes, _ = _codes(texts[low:high])
                    grams = [h[fine] for h, fine in (_hashes(codes, n) for n in SIZES)]
                    gram, n = np.unique(np.concatenate(grams), return_counts=True)
                    columns = [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n, pa.int64())]  # typed, as texts without letters give no rows
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    found = rows.mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def sample_of(docs: DataFrame, sample: int) -> DataFrame:
    """lang, text of about ``sample`` documents a language: those whose ids hash below the share that gives so many.

    One count a language decides, so no language is ranked in one task. Rows that share an id and language count once, by the text that sorts first.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = usable.select("lang", "doc_id").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("_ids"))
    bound = ids.select(F.col("lang").alias("_lang"), (F.lit(float(sample) * (1 << 31)) / F.col("_ids")).alias("_below"))  # a row a language
    some = usable.select("doc_id", "lang", "text").join(F.broadcast(bound), F.col("lang") == F.col("_lang")).where(place < F.col("_below"))
    return some.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")


def learn(docs: DataFrame, *, sample: int = SAMPLE) -> Filters:
    """Filters from text and non-null lang of documents that are not held out.

    Per language about ``sample`` documents count. All their n-grams that occur more than once are weighed; Spark sets the slots' bits, and only the
    slots come to the driver: SLOTS short rows at most for every 64 languages, whatever the corpus.
    """
    counts = written(_counts(sample_of(docs, sample)).where("n > 1"), "grams")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("_sum"))
    languages = sorted(r[0] for r in sums.select("lang").collect())
    number = F.array_position(F.lit(languages) if languages else F.array().cast("array<string>"), F.col("lang")) - 1
    used = counts.join(F.broadcast(sums), "lang").select("gram", number.alias("i"), (F.col("n") / F.col("_sum")).alias("use"))
    most = used.groupBy("gram").agg(F.max("use").alias("most"))
    bit = F.expr("shiftleft(1L, CAST(i % 64 AS INT))")
    slot = F.array(*[F.expr(f"(shiftrightunsigned(gram, {40 - 20 * p}) ^ {'0L' if p == 0 else 'shiftleft(gram, 7)'}) & {SLOTS - 1}L") for p in range(PROBES)])
    kept = used.join(most, "gram").where(F.col("use") >= SHARE * F.col("most"))
    bits = kept.select(F.explode(slot).alias("slot"), (F.col("i") / 64).cast("int").alias("word"), bit.alias("bit"))
    return _filters(languages, bits.groupBy("slot", "word").agg(F.bit_or("bit").alias("mask")).toPandas())


def _filters(languages: list[str], table: pd.DataFrame) -> Filters:
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    slots = np.zeros((SLOTS, max(1, -(-len(languages) // 64))), kind)
    slots[table["slot"].to_numpy(np.int64), table["word"].to_numpy(np.int64)] = table["mask"].to_numpy(np.int64).view(np.uint64).astype(kind)
    filled = np.array([((slots[:, i // 64] >> kind(i % 64)) & kind(1)).mean() for i in range(len(languages))])
    return Filters(languages, slots, filled)


def predict(docs: DataFrame, filters: Filters, *, keep: list[str] | None = None, out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """lang_pred and score (named as ``out`` says) for every whole text, beside the columns of ``keep`` (default: doc_id).

    ``score`` is the share of the text's n-grams that the language holds, corrected for false
    positives; ties go to the language that sorts first. A null text or one without letters
    is ``und`` with score 0, as is every text if no language was learned. Very long texts are read
    whole; repeated rows are judged alike; lang and source are not read.
    """
    keep = keep or ["doc_id"]
    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # SLOTS words, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        names = np.array([*filters.languages, "und"], object)
        for batch in slices(batches):
            scores = filters.scores([t or "" for t in batch["_text"].to_pylist()])
            best = scores.argmax(1)
            score = scores[np.arange(len(best)), best]
            best[(score < 0) | (not filters.languages)] = len(filters.languages)
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], pa.array(names[best], pa.string()), pa.array(np.maximum(score, 0.0))], names=schema.names)

    return rows.mapInArrow(run, schema)
