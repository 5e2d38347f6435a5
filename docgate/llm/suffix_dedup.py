"""Suffix-array deduplication by merging Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with
a smaller id, or in the same document further left. Strings are judged on the input, and never
reach across documents.

1. Every string of the length is assigned to the smallest hash of its ``GRAM``-byte grams (the
   leftmost if there are several), its anchor. Equal strings have equal anchors at equal places.
   Neighbouring strings with one anchor are one record: hash of the anchor, hash of the whole
   context (all bytes of its strings). Records of one Arrow batch with equal context are combined
   before the shuffle, so copied documents and common passages do not heap up.
2. Among records with one anchor, all but the first of equal contexts are covered as a whole. Only
   first records whose anchor has several contexts can share a part, so their bytes are looked at.
3. Contexts that agree with no other around their anchor are put aside. The others are put
   together in shards. Each shard's suffixes are sorted once, and the
   Burrows-Wheeler transforms of the shards are merged by refining their interleave: from an order
   by the first h bytes, a stable sort by the bytes before each suffix makes the order by h + q.
   After ``length`` bytes, equal strings are neighbours; their common prefixes give the repeated
   intervals, and all strings of an interval but the earliest are covered.

Null texts are empty. Rows without id are returned whole and cover nothing. Rows that share an id
are one document for positions: what is covered in one of them is cut from all. Other columns are
kept by ``cut``; one named like a column that it appends is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgate.llm.common import by_bytes, free, kept, written

LENGTH = 100
GRAM = 20
BUFFER = 1 << 19  # bytes hashed at once; positions in it take POSITION_BITS at most
POSITION_BITS = np.uint64(20)
SHARD = 1 << 17
BUNDLE = 1 << 20  # bytes sorted at once, at about 60 bytes of memory each
STRIDES = (5, 4, 2, 1)  # bytes that one refinement may add

RECORDS = "anchor bigint, context bigint, doc_id bigint, start bigint, n bigint, known boolean"
COVERED = "doc_id bigint, start bigint, n bigint"
_CODEC = "zstd"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers for bytes; powers of an odd base, and of its inverse, modulo 2^64."""
    values = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    powers = [np.multiply.accumulate(np.r_[1, np.full(2 * BUFFER, b)].astype(np.uint64))
              for b in (np.uint64(base), np.uint64(pow(base, -1, 2**64)))]
    return values, powers[0], powers[1]


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Records of a buffer of pieces; ``ends`` has the end of each byte's piece."""
    n = len(data)
    values, up, down = tables()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * up[:n], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    low = (np.uint64(1) << POSITION_BITS) - np.uint64(1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, target = 1, length - GRAM + 1
    while width < target:
        step = min(width, target - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & low).astype(np.int64)
    at = np.arange(len(place))
    valid = ends[: len(place)] - at >= length
    # A record ends where the anchor changes, or the strings leave their piece.
    new = np.r_[True, (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])]
    start = np.flatnonzero(new)
    stop = np.r_[start[1:], len(place)]
    inside = valid[start]
    start, stop = start[inside], stop[inside]
    place = place[start]
    whole = (sums[stop + length - 1] - sums[start]) * down[start]
    return {
        "anchor": grams[place],
        "context": mix(whole + mix((place - start).astype(np.uint64) + np.uint64(1))),
        "start": start,
        "n": stop - start,
    }


def pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Documents as lists of (doc_id, offset, bytes) of bounded size; long ones are cut with an
    overlap, so that every string is in exactly one piece."""
    held, size = [], 0
    for batch in batches:
        for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("data").to_pylist()):
            for offset in range(0, max(1, len(data) - length + 1), BUFFER // 2):
                part = data[offset : offset + BUFFER // 2 + length - 1]
                if len(part) < length:
                    continue
                if size + len(part) > BUFFER:
                    yield held
                    held, size = [], 0
                held.append((doc_id, offset, part))
                size += len(part)
    if held:
        yield held


def records(docs: DataFrame, length: int) -> DataFrame:
    """Records of all documents (doc_id, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(by_bytes(batches, "data"), length):
            sizes = np.array([len(p) for *_, p in part])
            data = np.frombuffer(b"".join(p for *_, p in part), np.uint8)
            bounds = np.cumsum(sizes)
            found = anchors(data, np.repeat(bounds, sizes), length)
            owner = np.searchsorted(bounds, found["start"], side="right")
            doc_id = np.array([d for d, *_ in part])[owner]
            shift = np.array([o for _, o, _ in part]) - (bounds - sizes)
            start = found["start"] + shift[owner]
            order = np.lexsort((start, doc_id, found["context"], found["anchor"]))
            anchor, context = found["anchor"][order], found["context"][order]
            known = np.r_[False, (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])]
            # What is known to be covered needs no company: any partition will do.
            spread = mix(context + start[order].astype(np.uint64) + doc_id[order].astype(np.uint64))
            anchor = np.where(known, spread, anchor)
            columns = (
                anchor.view(np.int64), context.view(np.int64), doc_id[order], start[order],
                found["n"][order], known,
            )
            names = [p.split()[0] for p in RECORDS.split(", ")]
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(pa.array, columns))))

    return docs.mapInArrow(run, RECORDS)


def matches(found: DataFrame) -> DataFrame:
    """Records that are covered, and those whose bytes have to be looked at."""
    dealt = found.repartition("anchor")
    same = Window.partitionBy("anchor", "context").orderBy("doc_id", "start")
    group = Window.partitionBy("anchor")
    placed = dealt.withColumn("nth", F.row_number().over(same)).withColumns(
        {"lowest": F.min("context").over(group), "highest": F.max("context").over(group)}
    )
    covered = F.col("known") | (F.col("nth") > 1)
    return placed.where(covered | (F.col("lowest") != F.col("highest"))).select(
        "anchor", "doc_id", "start", "n", covered.alias("covered")
    )


def packed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Texts compressed before they are exchanged: data (zstd), n_bytes."""
    fields = [docs.schema[name] for name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "data"):
            raw = batch.column("data").to_pylist()
            data = [pa.compress(d, codec=_CODEC, asbytes=True) for d in raw]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(data, pa.binary()),
                 pa.array(map(len, raw), pa.int64())],
                [*keep, "data", "n_bytes"],
            )

    added = [T.StructField("data", T.BinaryType()), T.StructField("n_bytes", T.LongType())]
    return docs.select(*keep, "data").mapInArrow(run, T.StructType([*fields, *added]))


def unpacked(row: dict) -> bytes:
    return pa.decompress(row["data"], row["n_bytes"], codec=_CODEC, asbytes=True)


def contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted records (anchor, doc_id, start, n)."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("w"))
    joined = packed(docs, ["doc_id"]).join(lists, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, rows = unpacked(row), row["w"]
                parts = [data[w["start"] : w["start"] + w["n"] + length - 1] for w in rows]
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": pa.array([w["anchor"] for w in rows], pa.int64()),
                        "doc_id": pa.array([row["doc_id"]] * len(rows), pa.int64()),
                        "start": pa.array([w["start"] for w in rows], pa.int64()),
                        "data": pa.array(parts, pa.binary()),
                    }
                )

    return joined.mapInArrow(run, "anchor bigint, doc_id bigint, start bigint, data binary")


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the cyclic suffixes of a shard in order of their first ``depth`` symbols, by
    doubling from seven packed symbols."""
    n = len(text)
    packed_symbols = np.zeros(n, np.int64)
    for k in range(7):
        packed_symbols = (packed_symbols << 9) | np.roll(text, -k)
    width, key = 7, packed_symbols
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]])
        if width >= depth or rank[order[-1]] == n - 1:
            return order
        key = rank * n + np.roll(rank, -width)
        width *= 2


def preceding(text: np.ndarray, stride: int) -> np.ndarray:
    """The ``stride`` symbols before every position of a cyclic text, as one number."""
    symbols = np.zeros(len(text), np.int64)
    for k in range(stride, 0, -1):
        symbols = (symbols << 9) | np.roll(text, k)
    return symbols


def merged(shards: list[np.ndarray], depth: int) -> np.ndarray:
    """Suffixes of all shards, as positions in their concatenation, in order of ``depth`` symbols.
    Only the order within a shard is sorted; the rest is refinement of the interleave."""
    orders = [sorted_suffixes(shard, depth) for shard in shards]
    offsets = np.cumsum([0, *(len(s) for s in shards[:-1])])
    positions = np.concatenate([(o + at).astype(np.int32) for o, at in zip(orders, offsets)])
    if len(shards) == 1:
        return positions
    for stride in STRIDES:
        if depth % stride == 0:
            symbols = np.concatenate([preceding(s, stride)[o] for s, o in zip(shards, orders)])
            alphabet, symbols = np.unique(symbols, return_inverse=True)
            if len(alphabet) <= 1 << 16:
                break
    transform = symbols.astype(np.uint16)  # the shards' transforms, one after the other
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s) for s in shards])
    current = np.empty_like(transform)
    for _ in range(depth // stride):
        current[np.argsort(interleave, kind="stable")] = transform
        interleave = interleave[np.argsort(current, kind="stable")]
    suffixes = np.empty_like(positions)
    suffixes[np.argsort(interleave, kind="stable")] = positions
    return suffixes


def in_company(parts: list[bytes], anchor: np.ndarray, length: int) -> np.ndarray:
    """Which contexts agree with another one of the same anchor on nearly a whole string.

    A string with x bytes left of the anchor's gram holds the ``i * step`` bytes left of it for
    i = x // step, and at least ``length - GRAM - (i + 1) * step + 1`` right of it. These parts
    are compared by hash for every i; without an equal part no string is shared.
    """
    gap = length - GRAM
    step = max(1, gap // 8)
    keys, rows = [], []
    values, up, down = tables()
    begin = 0
    while begin < len(parts):
        end, size = begin, 0
        while end < len(parts) and size + len(parts[end]) <= BUFFER:
            size += len(parts[end])
            end += 1
        data = np.frombuffer(b"".join(parts[begin:end]), np.uint8)
        sizes = np.array([len(p) for p in parts[begin:end]])
        stops = np.cumsum(sizes)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=sums[1:])
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])
        owner = np.repeat(np.arange(end - begin), sizes)[: len(grams)]
        at = np.flatnonzero(grams == anchor[begin:end].view(np.uint64)[owner])
        own = owner[at]
        for i in range(gap // step + 1):
            left = at - i * step
            right = at + GRAM + max(0, gap - (i + 1) * step + 1)
            inside = (left >= (stops - sizes)[own]) & (right <= stops[own])
            segment = (sums[right[inside]] - sums[left[inside]]) * down[left[inside]]
            keys.append(mix(segment + mix(grams[at[inside]] + np.uint64(i))))
            rows.append(own[inside] + begin)
        begin = end
    keys, rows = np.concatenate(keys), np.concatenate(rows)
    order = np.argsort(keys)
    keys, rows = keys[order], rows[order]
    same = keys[1:] == keys[:-1]
    found = np.zeros(len(parts), bool)
    found[rows[1:][same]] = found[rows[:-1][same]] = True
    return found


def repeats(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of strings in the order of their places: runs (part, first, n) of strings of the length
    that also start earlier in these parts."""
    sizes = np.array([len(p) for p in parts]) + 1
    starts = np.cumsum(sizes) - sizes
    joined = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    symbols = joined.astype(np.int16) + 1
    symbols[starts + sizes - 1] = 0
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(joined), max(SHARD, len(joined) // 200))))
    edges = np.r_[starts[cuts[cuts < len(starts)]], len(joined)]
    order = merged([symbols[a:b] for a, b in zip(edges, edges[1:]) if b > a], length)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    order = order[starts[owner[order]] + sizes[owner[order]] - 1 - order >= length]
    windows = np.lib.stride_tricks.sliding_window_view(joined, length)
    equal = np.zeros(len(order), bool)  # whether the common prefix with the one before is whole
    for at in range(1, len(order), 1 << 15):
        own = slice(at, min(at + (1 << 15), len(order)))
        before = slice(at - 1, own.stop - 1)
        equal[own] = (windows[order[own]] == windows[order[before]]).all(axis=1)
    intervals = np.flatnonzero(~equal)
    if not len(intervals):
        return (np.zeros(0, np.int64),) * 3
    first = np.minimum.reduceat(order, intervals)
    again = np.sort(order[order != np.repeat(first, np.diff(np.r_[intervals, len(order)]))])
    heads = np.flatnonzero(np.r_[True, np.diff(again) > 1]) if len(again) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[heads, len(again)])
    part = owner[again[heads]]
    return part, again[heads].astype(np.int64) - starts[part], counts


def compared(found: DataFrame, length: int) -> DataFrame:
    """Covered runs among contexts, those with one anchor together."""

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            keys = batch.column("anchor").to_numpy()
            sizes = pc.binary_length(batch.column("data")).to_numpy()
            begin = 0
            for end in [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]:
                if size > BUNDLE and keys[begin] != last:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                held.append(batch.slice(begin, end - begin))
                size += int(sizes[begin:end].sum())
                last, begin = keys[begin], end
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("bundles", object)  # an earlier operator's memory in this worker goes
        for bundle in bundles(batches):
            anchor = bundle.column("anchor").to_numpy()
            shared = in_company(bundle.column("data").to_pylist(), anchor, length)
            bundle = bundle.filter(pa.array(shared))
            if not bundle.num_rows:
                continue
            bundle = bundle.sort_by([("doc_id", "ascending"), ("start", "ascending")])
            part, first, n = repeats(bundle.column("data").to_pylist(), length)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(bundle.column("doc_id").to_numpy()[part]),
                    "start": pa.array(bundle.column("start").to_numpy()[part] + first),
                    "n": pa.array(n, pa.int64()),
                }
            )

    return found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, COVERED)


def covered_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs (doc_id, start, n) of starts of strings that also start earlier."""
    data = _as_bytes(docs.select("doc_id", "text"))
    known = written(matches(records(data.where("doc_id IS NOT NULL"), length)), "matches")
    wanted = known.where("NOT covered").drop("covered")
    shared = compared(contexts(data, wanted, length), length)
    return known.where("covered").select("doc_id", "start", "n").unionByName(shared)


def _as_bytes(docs: DataFrame) -> DataFrame:
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.withColumn("data", data).drop("text")


def spans_of(runs: list[dict], length: int, n_bytes: int) -> list[tuple[int, int]]:
    """Maximal removed spans from covered runs."""
    spans: list[list[int]] = []
    for start, n in sorted((r["start"], r["n"]) for r in runs):
        end = min(start + n - 1 + length, n_bytes)
        if start >= n_bytes:
            break
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [tuple(s) for s in spans]


def readable(kept: bytes) -> str:
    """The text of bytes that stay; characters that a cut went through are left out."""
    return kept.decode("utf-8", "ignore")


def cut(docs: DataFrame, length: int = LENGTH, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The named columns, n_bytes, removed spans, the bytes that stay and their text."""
    runs = written(covered_runs(docs, length), "covered")
    lists = runs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    keep = list(keep)
    free(docs.select(*keep), "data", "n_bytes", "runs", "removed", "kept", "text")
    joined = packed(_as_bytes(docs.select(*keep, "text")), keep).join(lists, "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "data", limit=2 << 20):
            spans, left, texts = [], [], []
            for row in batch.select(["data", "n_bytes", "runs"]).to_pylist():
                data = unpacked(row)
                own = spans_of(row["runs"] or [], length, len(data))
                edges = [0, *(x for s in own for x in s), len(data)]
                left.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                texts.append(readable(left[-1]))
                spans.append([{"start": a, "end": b} for a, b in own])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), batch.column("n_bytes"),
                 pa.array(spans, kind), pa.array(left, pa.binary()), pa.array(texts, pa.string())],
                [*keep, "n_bytes", "removed", "kept", "text"],
            )

    fields = [docs.schema[name] for name in keep]
    ddl = "n_bytes bigint, removed array<struct<start: bigint, end: bigint>>, kept binary, text string"
    schema = T.StructType([*fields, *T.StructType.fromDDL(ddl)])
    return joined.select(*keep, "data", "n_bytes", "runs").mapInArrow(run, schema)
