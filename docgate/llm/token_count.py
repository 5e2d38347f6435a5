"""Token counts: lengths only, in Arrow batches.

Work is balanced by bytes: batches are cut by bytes, and longer texts are cut at safe boundaries,
so that no call of the tokenizer gets more than a set number of bytes. Safe is ASCII white space:
the tokenizer drops it, neither its normaliser nor its word pattern reaches across it, and its
special strings hold none. Words repeat a lot, so each task keeps the lengths of those it has met.

Null texts are empty; a text without words has no tokens. Rows and other columns are kept as they
are, repeated rows too; columns named like the appended ones are an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from docgate.llm.common import WORD, by_bytes, free, kept, texts_of, unseen

CACHED_WORDS = 400_000
PIECE_CHARS = 1 << 20
_WORDS = re.compile(WORD)


class Counter:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def lengths(self, parts: list[list[str]]) -> list[int]:
        """Tokens of lists of words; new words are encoded in one batch."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = unseen(chain.from_iterable(parts), self.known)
        done = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.known.update(zip(new, map(len, done)))
        return [sum(map(self.known.__getitem__, words)) for words in parts]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of every text, a bounded number of characters at a time."""
        counts, owners, parts, held = [0] * len(texts), [], [], 0
        for owner, piece in chain(
            ((n, p) for n, text in enumerate(texts) for p in pieces(text)), [(None, "")]
        ):
            if owner is None or held + len(piece) > 2 * PIECE_CHARS:
                for n, length in zip(owners, self.lengths(parts)):
                    counts[n] += length
                owners, parts, held = [], [], 0
            owners.append(owner)
            parts.append(_WORDS.findall(piece))
            held += len(piece)
        return counts


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text after white space into pieces of about ``limit`` characters. A word longer than
    that stays whole."""
    start = 0
    space = re.compile(r"[\x20\x09-\x0D]")
    while len(text) - start > limit:
        cut = space.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", n_bytes: str = "n_bytes", n_tokens: str = "n_tokens"
) -> DataFrame:
    """Append UTF-8 bytes and tokens of a text column, and drop the texts themselves."""
    others = [f for f in docs.schema.fields if f.name != text]
    free(docs.drop(text), n_bytes, n_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text):
            sizes = pc.binary_length(batch.column(text)).fill_null(0).cast(pa.int64())
            counts = pa.array(kept(("counts", path), lambda: Counter(path)).count(texts_of(batch, text)), pa.int64())
            columns = [batch.column(f.name) for f in others]
            yield pa.RecordBatch.from_arrays(
                [*columns, sizes, counts], [*(f.name for f in others), n_bytes, n_tokens]
            )

    added = [T.StructField(name, T.LongType()) for name in (n_bytes, n_tokens)]
    return docs.mapInArrow(run, T.StructType([*others, *added]))
