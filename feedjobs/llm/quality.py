"""Quality scores by Bradley-Terry ranking of document pairs."""

from __future__ import annotations

import functools
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedjobs.llm.language import held_out
from feedjobs.llm.shared import slices

#: Labelled documents that scores are learned from, at most (smallest hash of the id first).
SAMPLE = 6_000
#: Preference pairs made from them, at most.
PAIRS = 60_000
#: A score from here on predicts label 1.
THRESHOLD = 0.7

#: Buckets of hashed n-grams: of characters (by threes), then of words.
CHARS, WORDS = 256, 256
#: Penalty of a weight, and of an n-gram's.
PENALTY, GRAM_PENALTY = 1e-3, 1e-2
#: Steps of the fit.
STEPS = 150

#: Kinds of characters that are counted.
KINDS = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "bracket", "other")
COUNTS = (*(f"share_{k}" for k in KINDS), "log_words", "word_length", "repeated_next", "distinct", "commonest", "repeated_lines", "marked_words", "shouted_words")
SIZE = len(COUNTS) + CHARS + WORDS
#: Characters whose n-grams are hashed at once.
BLOCK = 100_000


@functools.cache
def _kinds() -> np.ndarray:
    table = np.full(0x110000, KINDS.index("other"), np.uint8)
    for c in range(0x110000):
        s = chr(c)
        if s.isupper():
            table[c] = 1
        elif s.isalpha():
            table[c] = 0
        elif s.isdigit():
            table[c] = 2
        elif s == "\n":
            table[c] = 4
        elif s.isspace():
            table[c] = 3
    for kind, chars in (("stop", ".,;:'\"-"), ("mark", "!?#$%&*@~^_=+|\\"), ("bracket", "<>{}[]()/")):
        table[[ord(c) for c in chars]] = KINDS.index(kind)
    return table


def _char_grams(points: np.ndarray) -> np.ndarray:
    """How often each bucket of hashed character trigrams occurs."""
    found = np.zeros(CHARS)
    for at in range(0, max(1, len(points) - 2), BLOCK):
        some = points[at : at + BLOCK + 2].astype(np.uint64)
        if len(some) > 2:
            h = ((some[:-2] * np.uint64(0x9E3779B1) ^ some[1:-1]) * np.uint64(0x85EBCA77) ^ some[2:]) * np.uint64(0xC2B2AE3D27D4EB4F)
            found += np.bincount(h >> np.uint64(56), minlength=CHARS)
    return found


def features(texts: list[str | None]) -> np.ndarray:
    """One row a text, from the whole text: COUNTS, then the roots of the shares of hashed n-grams. Null counts as empty, whose features are all 0."""
    out = np.zeros((len(texts), SIZE), np.float32)
    table, wide, counts = _kinds(), len(KINDS), len(COUNTS)
    for row, text in zip(out, texts, strict=True):
        if not text:
            continue
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        row[:wide] = np.bincount(table[points], minlength=wide) / len(text)
        row[counts : counts + CHARS] = np.sqrt(_char_grams(points) / len(text))
        words = text.split()
        n = len(words)
        if not n:
            continue
        seen = Counter(words)
        lines = [x for x in text.split("\n") if x]
        row[wide:counts] = (
            np.log1p(n), min(30.0, len(text) / n) / 10, sum(map(operator.eq, words, words[1:])) / n,
            np.log1p(len(seen)) / np.log1p(n), max(seen.values()) / n, 1 - len(set(lines)) / max(1, len(lines)),
            sum(k for w, k in seen.items() if w[-1] in "!#$%&*|") / n, sum(k for w, k in seen.items() if w.isupper()) / n,
        )
        bucket = np.array([crc32(w.encode("utf-8", "surrogatepass")) for w in seen]) % WORDS
        row[counts + CHARS :] = np.sqrt(np.bincount(bucket, np.fromiter(seen.values(), np.float64, len(seen)), WORDS) / n)
    return out


@dataclass
class Ranking:
    """score = 1 / (1 + exp(-(x . weights - cut) - shift)); the cut scores THRESHOLD."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - self.mean) / self.scale) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(raw + np.log(THRESHOLD / (1 - THRESHOLD)), -500, 500)))


def bradley_terry(x: np.ndarray, better: np.ndarray, worse: np.ndarray, penalty: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights under which better rows beat worse ones: accelerated descent on the logistic loss of differences, plus penalty * weight^2 / 2.

    better, worse: places of the pairs' rows in x. A pair's pull acts on its two rows, so no differences are stored.
    """
    w = look = np.zeros(x.shape[1])
    largest = np.linalg.norm((x[better[:2000]] - x[worse[:2000]]).astype(np.float64), axis=1).max(initial=1.0)
    rate = 1 / (largest**2 / 4 + penalty.max())
    for i in range(steps):
        s = x @ look.astype(np.float32)  # no copy of x in doubles
        p = 1 / (1 + np.exp(np.clip(s[better] - s[worse], -30, 30))) / len(better)
        pull = np.bincount(better, p, len(x)) - np.bincount(worse, p, len(x))
        w, before = look + rate * (x.T @ pull.astype(np.float32) - penalty * look), w
        look = w + i / (i + 3) * (w - before)
    return w


def fit(x: np.ndarray, y: np.ndarray, *, pairs: int = PAIRS, seed: int = 0) -> Ranking:
    """Learn from features and labels. Without both labels all documents score THRESHOLD.

    Each document of one label meets documents of the other; the threshold is the score quantile
    at label 0's share of the sample.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(SIZE), np.ones(SIZE), np.zeros(SIZE), 0.0)
    mean, scale = x.mean(0, dtype=np.float64).astype(np.float32), np.maximum(x.std(0), 1e-6)
    scale[len(COUNTS) :] = max(1e-6, float(scale[len(COUNTS) :].mean()) * 8)  # all n-grams alike, so that rare ones do not grow
    x = ((x - mean) / scale).astype(np.float32)
    rng, n = np.random.default_rng(seed), min(pairs, 20 * max(len(good), len(bad)))
    penalty = np.where(np.arange(SIZE) < len(COUNTS), PENALTY, GRAM_PENALTY)
    w = bradley_terry(x, good[rng.integers(len(good), size=n)], bad[rng.integers(len(bad), size=n)], penalty)
    raw = np.sort(x @ w)
    at = len(bad)
    return Ranking(mean, scale, w, float((raw[at - 1] + raw[at]) / 2))


def with_features(docs: DataFrame, keep: list[str], out: str) -> DataFrame:
    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = features(batch["_text"].to_pylist())
            flat = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], flat], names=schema.names)

    return rows.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Ranking:
    """Fit on labelled documents that are not held out, at most ``sample`` of them at every size of the corpus.

    An id with several labels counts with its highest, one with several texts with the features that sort first.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = usable.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
    rows = with_features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), ["doc_id", "quality"], "x")
    table = rows.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).orderBy("doc_id").toPandas()
    x = np.frombuffer(b"".join(table["x"]), np.float32).reshape(-1, SIZE)
    return fit(x, table["quality"].to_numpy())


def score(docs: DataFrame, ranking: Ranking, *, keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """The score (named ``out``) of every whole text beside the columns of ``keep`` (default: doc_id).

    Null and empty texts are scored by features that are all 0. Very long texts are read whole;
    repeated rows score alike; labels, lang and source are not read.
    """
    keep = keep or ["doc_id"]
    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = ranking(features(batch["_text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], pa.array(found)], names=schema.names)

    return rows.mapInArrow(run, schema)
