"""BM25 scores of whole chunks, for a table of questions small enough to broadcast.

A chunk comes as one row with its counted words, so the shares of a question are added up where the
chunk is: a task holds the scores of a few chunks and the first k of every question, whatever the
size of its input. Nothing is grouped, sorted or spilled for pairs of question and chunk.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BM25_K1 = 1.2
BM25_B = 0.75
# Shares of a score are added up as whole multiples of this, so that their order is of no account.
UNIT = 1e-12
_DIGIT = 1_000_000  # units in the last digit of a score
_PAIRS = 1 << 19  # scores held at once


class _Asked:
    """Questions by word: the word at ``n`` stands in ``questions[starts[n]:starts[n + 1]]``."""

    def __init__(self, weighted: pa.Table):
        by_id = weighted.column("question_id").combine_chunks().dictionary_encode("encode")
        by_term = weighted.column("term").combine_chunks().dictionary_encode()
        self.ids, self.terms = by_id.dictionary, by_term.dictionary
        at = by_term.indices.to_numpy()
        order = np.argsort(at, kind="stable")
        self.questions = by_id.indices.to_numpy().astype(np.int64)[order]
        self.starts = np.searchsorted(at[order], np.arange(len(self.terms) + 1))
        self.idf = np.zeros(len(self.terms))
        self.idf[at] = weighted.column("idf").to_numpy()


def _last_digit(totals: np.ndarray) -> np.ndarray:
    """Scores in whole last digits, rounded as Spark rounds them."""
    rounded = (totals + _DIGIT // 2) // _DIGIT
    for at in zip(*np.nonzero(totals % _DIGIT == _DIGIT // 2)):  # halves, as a double shows them
        digits = Decimal(repr(float(totals[at]) * UNIT)).scaleb(6)
        rounded[at] = int(digits.quantize(Decimal(1), ROUND_HALF_UP))
    return rounded


def _totals(asked: _Asked, rows: pa.RecordBatch, mean_length: float) -> tuple[np.ndarray, np.ndarray]:
    """Score in units of each row (down) for each question (across), and whether they share a word."""
    words = pc.index_in(rows.column("terms").flatten(), value_set=asked.terms)
    row = np.repeat(np.arange(rows.num_rows), pc.list_value_length(rows.column("terms")).to_numpy())
    met = words.is_valid().to_numpy(zero_copy_only=False)
    word, row = words.drop_null().to_numpy(), row[met]
    tf = rows.column("tfs").flatten().to_numpy()[met].astype(np.float64)
    length = rows.column("length").to_numpy()[row].astype(np.float64)
    damping = BM25_K1 * ((1 - BM25_B) + BM25_B * length / mean_length)
    share = np.floor(asked.idf[word] * tf * (BM25_K1 + 1) / (tf + damping) / UNIT + 0.5).astype(np.int64)
    # One pair for each question that a met word stands in.
    first, times = asked.starts[word], asked.starts[word + 1] - asked.starts[word]
    ends = np.cumsum(times)
    total = int(ends[-1]) if len(ends) else 0
    question = asked.questions[np.arange(total) + np.repeat(first - (ends - times), times)]
    at = np.repeat(row, times) * len(asked.ids) + question
    totals = np.zeros(rows.num_rows * len(asked.ids), np.int64)
    np.add.at(totals, at, np.repeat(share, times))
    shared = np.zeros(len(totals), bool)
    shared[at] = True
    shape = (rows.num_rows, len(asked.ids))
    return totals.reshape(shape), shared.reshape(shape)


def best(counted: DataFrame, weighted: DataFrame, mean_length: float, top_k: int) -> DataFrame:
    """The ``top_k`` best chunks of a task for every question: ``question_id``, the chunk's key,
    ``copies`` and ``total``, the score in units.

    ``counted`` is ``search.counted_words``; ``weighted`` has ``question_id, term, idf`` and is
    broadcast, so it has to be measured before. Chunks of equal score are taken in key order.
    """
    spark = counted.sparkSession
    asked = spark.sparkContext.broadcast(_Asked(weighted.toArrow()))
    key = ("doc_id", "chunk_no", "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = asked.value
        n = len(of.ids)
        found = [[] for _ in range(n)]  # of every question the best so far, the best first
        least = np.zeros(n, np.int64)  # what a chunk needs to be among them
        some = max(1, _PAIRS // max(1, n))
        for batch in batches if n else ():
            for start in range(0, batch.num_rows, some):
                rows = batch.slice(start, some)
                totals, shared = _totals(of, rows, mean_length)
                scores = np.where(shared, _last_digit(totals), -1)
                if len(scores) > top_k:
                    place = len(scores) - top_k
                    least = np.maximum(least, np.partition(scores, place, axis=0)[place])
                keys = [rows.column(c).to_pylist() for c in (*key, "copies")] if len(scores) else []
                for at, q in zip(*(x.tolist() for x in np.nonzero(scores >= least))):
                    doc_id, chunk_no, ident, copies = (c[at] for c in keys)
                    order = (
                        -int(scores[at, q]), doc_id is not None, doc_id, chunk_no is not None, chunk_no, ident
                    )
                    insort(found[q], (order, copies, int(totals[at, q])), key=lambda x: x[0])
                    if len(found[q]) >= top_k:
                        del found[q][top_k:]
                        least[q] = max(least[q], -found[q][-1][0][0])
        for q, hits in enumerate(found):
            if hits:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(of.ids[q], len(hits)),
                        *(pa.array([h[0][n] for h in hits], batch.schema.field(c).type) for n, c in zip((2, 4, 5), key)),
                        pa.array([h[1] for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.int64()),
                    ],
                    names=["question_id", *key, "copies", "total"],
                )

    kinds = [weighted.schema["question_id"], *(counted.schema[c] for c in key)]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in kinds]
        + [T.StructField("copies", T.LongType()), T.StructField("total", T.LongType())]
    )
    return counted.select(*key, "copies", "length", "terms", "tfs").mapInArrow(run, schema)
