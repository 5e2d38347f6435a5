"""Line-first quality rules.

Every line is judged on its own: by its punctuation (symbols stuck to words, shouted sentences),
as navigation (a row of cells or links), and as boilerplate (a sentence that occurs twice or more
in the same document, or a licence or cookie notice). Lines that fail are removed. A document is
rejected if it then has lost more than ``MAX_LOST`` percent of its word characters, or has no word
left, or fails the base rules on its whole text.

Null texts have no words: they fail the base rules. Repeated rows are judged one by one; other
columns are kept; one named like an appended column is an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docgate.llm.common import WORD, by_bytes, free, texts_of

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST = 50
LINE_PERCENT = 30

# Signs of notices that are no content.
NOTICES = ("licensed under", "all rights reserved", "cookie", "terms of use", "privacy policy")

_WORDS = re.compile(WORD)
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MARKED = re.compile(r"[#*$%&<>]|!!")


@dataclass
class Judged:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    lost_chars: int
    cleaned: str


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words in windows that are found twice or more. Equality of windows is exact: numbers of
    shorter windows are paired and numbered anew until the window is long enough."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    width, grams = 1, ids
    while width < window:
        step = min(width, window - width)
        pairs = grams[: len(grams) - step] * (grams.max() + 1) + grams[step:]
        _, grams = np.unique(pairs, return_inverse=True)
        width += step
    twice = np.bincount(grams)[grams] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def line_fails(line: str, words: list[str], occurrences: int) -> bool:
    """Whether a line with these words is removed."""
    marked = sum(1 for w in words if _MARKED.search(w))
    shouted = len(words) >= 3 and line.isupper()
    cells = sum(1 for w in words if w in ("|", ">", "»", "·"))
    lower = line.lower()
    return (
        marked * 100 > len(words) * LINE_PERCENT
        or shouted
        or cells * 100 > len(words) * LINE_PERCENT
        or occurrences > 1
        or any(notice in lower for notice in NOTICES)
    )


def judge(text: str) -> Judged:
    lines = text.split("\n")
    worded = [line for line in lines if _WORDS.search(line)]
    seen = Counter(worded)
    words = _WORDS.findall(text)
    chars = sum(map(len, words))
    repeated = repeat_words(words)
    lost, kept_lines, kept_words = 0, [], 0
    for line in lines:
        own = _WORDS.findall(line)
        if own and line_fails(line, own, seen[line]):
            lost += sum(map(len, own))
        else:
            kept_lines.append(line)
            kept_words += len(own)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    kept = not failed and kept_words > 0 and 100 * lost <= MAX_LOST * chars
    return Judged(
        n_words=len(words),
        word_chars=chars,
        n_symbols=len(_SYMBOLS.findall(text)),
        n_dup_lines=len(worded) - len(seen),
        n_repeat_words=repeated,
        base_failed=failed,
        kept=kept,
        lost_chars=lost,
        cleaned="\n".join(kept_lines),
    )


_TYPES = {"int": (pa.int64(), T.LongType()), "bool": (pa.bool_(), T.BooleanType()), "str": (pa.string(), T.StringType())}


def clean_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append measures, verdict and cleaned text of every document; the given text is dropped."""
    free(docs.drop(text), *(f.name for f in fields(Judged)))
    kept = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text):
            judged = zip(*(astuple(judge(t)) for t in texts_of(batch, text)))
            new = [pa.array(values, _TYPES[f.type][0]) for f, values in zip(fields(Judged), judged)]
            names = [*(f.name for f in kept), *(f.name for f in fields(Judged))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *new], names)

    added = [T.StructField(f.name, _TYPES[f.type][1]) for f in fields(Judged)]
    return docs.mapInArrow(run, T.StructType([*kept, *added]))
