"""Quality classifier on learned subword embeddings.

A text is the mean of the vectors of its words, of their character n-grams, and of the pairs of a
word with itself (one feature, whatever the word), hashed into a fixed number of rows; a softmax over two classes stands on top. Vectors and weights are learned together
by stochastic gradient descent in numpy, in one task, on at most ``max_rows`` labelled documents
(those with the smallest hash of their id). As the softmax is linear in the mean, scoring needs one
number for each row of the table: that is what goes to the tasks, of fixed size.

Null texts are empty, and a text without words gets the score of the classes' shares alone. Rows
of ``labels`` without id or with a label that is neither 0 nor 1 are not used; of several labels of a
document the larger counts. With no label at all every score is one half. Repeated rows and other
columns are kept; a column named like the score is an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgate.llm.common import WORD, by_bytes, free, kept, texts_of, unseen

# What is kept of words in a worker, in each of two generations, and of character n-grams.
CACHED_WORDS = 150_000
CACHED_BYTES = 8 << 20
CACHED_GRAMS = 200_000
DOUBLED = 0  # the row of pairs of a word with itself
_WORDS = re.compile(WORD)


@dataclass(frozen=True)
class Settings:
    """``max_rows`` bounds the labelled sample; the rest is the usual."""

    max_rows: int = 3000
    buckets: int = 1 << 16
    dim: int = 8
    shortest: int = 2
    longest: int = 4
    epochs: int = 5
    batch: int = 32
    rate: float = 60.0
    seed: int = 1


def row(gram: str, s: Settings) -> int:
    return crc32(gram.encode()) % s.buckets


def grams(word: str, s: Settings) -> list[str]:
    """Character n-grams of a word; its ends are marked."""
    marked, n = f"<{word}>", len(word) + 2
    return [
        marked[i : i + width]
        for width in range(s.shortest, min(s.longest, n) + 1)
        for i in range(n - width + 1)
    ]


def features(word: str, s: Settings) -> list[int]:
    """Rows of a word and of its character n-grams."""
    return [row(gram, s) for gram in [f"={word}", *grams(word, s)]]


def doubled(words: list[str]) -> int:
    """Words that equal the one before them."""
    return sum(map(eq, words, words[1:]))


def _matrix(texts: list[str], s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its rows, and their shares in the mean."""
    known: dict[str, np.ndarray] = {}
    found = []
    for text in texts:
        sequence = _WORDS.findall(text)
        words = Counter(sequence)
        for word in unseen(words, known):
            known[word] = np.array(features(word, s), np.int64)
        if not words:
            found.append((np.zeros(0, np.int64), np.zeros(0)))
            continue
        rows = np.concatenate([[DOUBLED], *(known[w] for w in words)])
        weights = np.repeat(
            [doubled(sequence), *map(float, words.values())], [1, *(len(known[w]) for w in words)]
        )
        rows, place = np.unique(rows, return_inverse=True)
        summed = np.bincount(place, weights)
        found.append((rows, summed / summed.sum()))
    return found


def train(texts: list[str], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """What each row adds to the log-odds of class 1, and their constant part."""
    if len(labels) == 0:
        return np.zeros(s.buckets), 0.0
    random = np.random.default_rng(s.seed)
    vectors = random.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim))
    weights, bias = np.zeros((s.dim, 2)), np.log(np.bincount(labels, minlength=2) + 1.0)
    bias -= bias.mean()
    docs = _matrix(texts, s)
    steps = s.epochs * -(-len(docs) // s.batch)
    done = 0
    for _ in range(s.epochs):
        order = random.permutation(len(docs))
        for start in range(0, len(order), s.batch):
            own = order[start : start + s.batch]
            rate = s.rate * (1 - done / steps)
            done += 1
            means = np.stack([share @ vectors[rows] for rows, share in (docs[i] for i in own)])
            logits = means @ weights + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(own)), labels[own]] -= 1
            error /= len(own)
            back = error @ weights.T
            weights -= rate * (means.T @ error)
            bias -= 0.01 * rate * error.sum(axis=0)
            for i, direction in zip(own, back):
                rows, share = docs[i]
                vectors[rows] -= rate * np.outer(share, direction)
    return vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0])


def held_out(doc_id: str = "doc_id"):
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Learn from the labelled documents outside the held-out fold."""
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(s.max_rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            (i, t, q)
            for batch in batches
            for i, t, q in zip(
                batch.column("doc_id").to_pylist(), texts_of(batch), batch.column("quality").to_pylist()
            )
        )
        gains, constant = train([t for _, t, _ in rows], np.array([q for *_, q in rows], int), s)
        yield pa.RecordBatch.from_pydict(
            {"gains": pa.array([gains.astype("<f4").tobytes()]), "constant": pa.array([constant])}
        )

    model = sample.repartition(1).mapInArrow(run, "gains binary, constant double").first()
    if model is None:
        return np.zeros(s.buckets), 0.0
    return np.frombuffer(model["gains"], "<f4").astype(float), model["constant"]


class _Gains(dict):
    """What a character n-gram adds; hashed when it is first asked for."""

    def __init__(self, gains: list[float], s: Settings) -> None:
        super().__init__()
        self.gains, self.settings = gains, s

    def __missing__(self, gram: str) -> float:
        found = self[gram] = self.gains[row(gram, self.settings)]
        return found


class _Known:
    """What words add, and the number of their features, in two generations: when the younger is full
    it becomes the older, and words that are not used again go with the one before."""

    def __init__(self, gains: list[float], s: Settings) -> None:
        self.young: dict[str, complex] = {}
        self.old: dict[str, complex] = {}
        self.size = 0
        self.gains = _Gains(gains, s)

    def learned(self, word: str) -> complex:
        s = self.gains.settings
        own = grams(word, s)
        first = self.gains.gains[row(f"={word}", s)]
        return complex(sum(map(self.gains.__getitem__, own), first), 1 + len(own))

    def of(self, words: list[str]) -> dict[str, complex]:
        """A dictionary that has all of a text's words."""
        if len(self.young) >= CACHED_WORDS or self.size >= CACHED_BYTES:
            self.old, self.young, self.size = self.young, {}, 0
        if len(self.gains) >= CACHED_GRAMS:
            self.gains.clear()
        for word in unseen(words, self.young):
            found = self.old.get(word)
            self.young[word] = self.learned(word) if found is None else found
            self.size += len(word)
        return self.young


def score(
    docs: DataFrame, model: tuple[np.ndarray, float], s: Settings = Settings(), text: str = "text",
    name: str = "score",
) -> DataFrame:
    """Append the probability of class 1."""
    free(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name_of_model = blake2b(model[0].tobytes(), digest_size=16).digest() + repr((model[1], s)).encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains, constant = shared.value
        words_known = kept(name_of_model, lambda: _Known(gains.tolist(), s))
        for batch in by_bytes(batches, text):
            odds = []
            for t in texts_of(batch, text):
                words = _WORDS.findall(t)
                known = words_known.of(words)
                pairs = doubled(words)
                total = sum(map(known.__getitem__, words), complex(pairs * gains[DOUBLED], pairs))
                odds.append(constant + (total.real / total.imag if words else 0.0))
            scores = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(run, schema)
