"""BPE encoding and decoding by forced boundaries.

A merge can only make tokens of the vocabulary, so two neighbouring bytes that stand together in
no token are never merged: the text can be cut between them. Cuts are made where, in addition,
the tokenizer's own word pattern always starts a new word, namely before ASCII white space that
follows another character. Fragments are then encoded independently and their ids concatenated.
Fragments repeat a lot, so each task keeps the ids of those it has met.

Null texts are empty texts; an empty text has no ids. Repeated rows and extra columns are kept:
both functions only append a column. A column of that name must not exist yet.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from docgate.llm.common import by_bytes, by_size, free, kept, texts_of, unseen

CACHED_FRAGMENTS = 100_000  # in each of two generations
CACHED_BYTES = 12 << 20  # of fragments and ids, likewise; Python's own share comes on top
DECODED_TOKENS = 1 << 18
JOINED_FRAGMENTS = 256  # new fragments in one text for the tokenizer
ENCODED_BYTES = 1 << 19  # text encoded at once: fragments and ids are small Python objects
SPACES = b" \t\n\r\x0b\x0c"
# The three-byte white-space characters of Unicode.
WIDE_SPACE = rb"\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a byte as one character: itself if it is printable Latin-1
    and not a space, else the next free code point from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def vocabulary(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of every id."""
    special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    alphabet = byte_alphabet()
    tokens = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, number in tokenizer.get_vocab(with_added_tokens=True).items():
        tokens[number] = (
            special[number].encode() if number in special else bytes(alphabet[c] for c in token)
        )
    return tokens


class Codec:
    """One tokenizer file with what follows from its vocabulary."""

    def __init__(self, path: str):
        # Every core has a worker of its own; threads in each of them would only hold memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokens = vocabulary(self.tokenizer)
        self.joined = np.zeros((256, 256), bool)
        for token in self.tokens:
            self.joined[list(token[:-1]), list(token[1:])] = True
        self.special = sorted(s.encode() for s in special)
        self.fragment = re.compile(self._pattern())
        self.apart = re.compile(self._pattern_apart(), re.DOTALL)
        self.sizes = np.array([len(token) for token in self.tokens])
        self.known: dict[bytes, bytes] = {}  # ids of fragments as 32-bit numbers
        self.older: dict[bytes, bytes] = {}  # those of the generation before
        self.size = 0

    def _pattern(self) -> bytes:
        """Matches one fragment after the other: white space, then other characters, going on
        past white space where the pair of bytes at its start occurs in some token, or where a
        white-space character outside ASCII stands before it."""
        go_on = [rb"(?<=\xc2[\x85\xa0])", rb"(?<=" + WIDE_SPACE + rb")"]
        for space in SPACES:
            joined = [b for b in range(256) if self.joined[b, space] and b not in SPACES]
            if joined:
                before = b"".join(b"\\x%02x" % b for b in joined)
                go_on.append(b"(?<=[%b])(?=\\x%02x)" % (before, space))
        white = b"[" + re.escape(SPACES) + b"]"
        other = b"[^" + re.escape(SPACES) + b"]"
        more = b"(?:(?:%b)%b+%b*)*" % (b"|".join(go_on), white, other)
        return b"%b*%b+%b|%b+" % (white, other, more, white)

    def _pattern_apart(self) -> bytes:
        """Matches fragments that begin and end so that there is always a cut between two of them.
        Nothing does if a special token holds white space and might arise from putting together."""
        if any(byte in SPACES for special in self.special for byte in special):
            return rb"(?!)"
        spaces = list(SPACES)
        ends = [b for b in range(256) if b not in SPACES and not self.joined[b, spaces].any()]
        end = b"[" + b"".join(b"\\x%02x" % b for b in ends) + b"]" if ends else rb"(?!)"
        wide = rb"(?<!\xc2[\x85\xa0])(?<!" + WIDE_SPACE + rb")"
        return b"[" + re.escape(SPACES) + b"].*" + end + wide

    def fragments(self, text: str) -> list[bytes]:
        """Special tokens, and the fragments between them."""
        data = text.encode()
        if not any(s in data for s in self.special):
            return self.fragment.findall(data)
        found = []
        for part in re.split(b"(" + b"|".join(map(re.escape, self.special)) + b")", data):
            found += [part] if part in self.special else self.fragment.findall(part)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as 32-bit numbers one after the other."""
        parts = [self.fragments(text) for text in texts]
        if len(self.known) > CACHED_FRAGMENTS or self.size > CACHED_BYTES:
            self.known, self.older, self.size = {}, self.known, 0
        new = unseen(chain.from_iterable(parts), self.known)
        self.size += 3 * sum(map(len, new))  # ids take about twice the bytes of a fragment
        self.known.update((f, self.older[f]) for f in new if f in self.older)
        new = [f for f in new if f not in self.older]
        self.learn(new)
        return [b"".join(map(self.known.__getitem__, part)) for part in parts]

    def learn(self, new: list[bytes]) -> None:
        """Keep the ids of new fragments."""
        single, apart = [], []
        for fragment in new:
            (apart if self.apart.fullmatch(fragment) else single).append(fragment)
        groups = [apart[n : n + JOINED_FRAGMENTS] for n in range(0, len(apart), JOINED_FRAGMENTS)]
        for group, ids in zip(groups, self._ids([b"".join(group) for group in groups])):
            tokens = np.cumsum(self.sizes[np.frombuffer(ids, np.int32)])
            ends = np.cumsum([len(fragment) for fragment in group])
            at = np.searchsorted(tokens, ends)
            if not np.array_equal(tokens[at], ends):  # the tokenizer did not cut there
                single += group
                continue
            cuts = [0, *(4 * (at + 1)).tolist()]
            self.known.update((f, ids[a:b]) for f, a, b in zip(group, cuts, cuts[1:]))
        self.known.update(zip(single, self._ids(single)))

    def _ids(self, texts: list[bytes]) -> Iterator[bytes]:
        done = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return (array("i", e.ids).tobytes() for e in done)


@lru_cache(maxsize=4)
def token_bytes(path: str) -> pa.LargeBinaryArray:
    """All that decoding needs; bounded by the vocabulary, so it travels with the function."""
    return pa.array(vocabulary(Tokenizer.from_file(path)), pa.large_binary())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the token ids of a text column; a column named like them is an error. Tokenizer and
    known fragments are loaded once in each worker."""
    free(docs, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text, ENCODED_BYTES):
            packed = kept(("bpe", path), lambda: Codec(path)).encode(texts_of(batch, text))
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            flat = pa.Array.from_buffers(
                pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))]
            )
            found = pa.ListArray.from_arrays(ends, flat)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, found], [*batch.schema.names, ids]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Put the text of an id column in its place. The bytes of all tokens are put together by one
    Arrow take; bytes that are no UTF-8 become replacement characters. Null ids are no ids."""
    kept = [f for f in encoded.schema.fields if f.name != ids]
    tokens = token_bytes(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, ids, pc.list_value_length, DECODED_TOKENS):
            lists = pc.fill_null(batch.column(ids), pa.scalar([], pa.list_(pa.int32())))
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            taken = tokens.take(lists.flatten())
            sizes = np.concatenate([[0], np.cumsum(pc.binary_length(taken).to_numpy())])
            at = sizes[ends.astype(np.int64)].astype(np.int64)
            whole = _data(taken)
            texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(texts, pa.string())],
                [*(f.name for f in kept), text],
            )

    return encoded.mapInArrow(run, T.StructType([*kept, T.StructField(text, T.StringType())]))


def _data(taken: pa.LargeBinaryArray) -> bytes:
    data = taken.buffers()[2]
    return data.to_pybytes() if data is not None else b""
