"""Near-duplicates by SuperMinHash.

Every element of a document's shingle set draws one random permutation of the signature's places,
step by step; at step j it offers the value j + r (0 <= r < 1) to its j-th place, and a place keeps
its smallest value. A document is done at the first step after which no place could get smaller.
Documents with equal sets are one class. Classes that agree on a band of the signature are
candidates; candidates reachable from each other form a group, and within a group all links are
confirmed on the full sets. Components of confirmed links give the result.

A group's members compare themselves through posting lists, the most typical member first; what is
already in its component needs no further comparison, so families of copies cost about one pass.
A group larger than ``BLOCK`` is cut into blocks that all hold its most copied member; members that
remain outside this member's component then meet every block, each of them by itself: there a
member is passed over only if nothing that it meets is outside the first one's component.

Documents without words have an empty set and are linked with nothing; null texts are empty. Equal
rows are of one class. Rows that share an id are one document for linking: classes that hold one id
are linked; a row without words stays alone under its id. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import by_bytes, texts_of, unseen, written
from docgate.llm.components import components

CACHED_WORDS = 400_000
BLOCK = 4096
ELEMENTS = 1 << 17
STEP_BITS = np.uint64(56)


@dataclass(frozen=True)
class Settings:
    """Shingle length in words, similarity in percent, and bands x rows places of a signature
    (at most 256). At the similarity itself a pair is missed with (1 - s^rows)^bands."""

    words: int = 3
    percent: int = 85
    bands: int = 36
    rows: int = 6

    @property
    def places(self) -> int:
        return self.bands * self.rows


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of shingles as sorted 64-bit hashes; hashes of words are kept."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()  # of bytes: both touch ASCII only
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        for word in unseen(words, self.known):
            self.known[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        n = len(hashes) - width + 1
        whole = np.full(n, width, np.uint64)
        for k in range(width):
            whole = mix(whole + hashes[k : k + n])
        return np.unique(whole)


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """SuperMinHash of every set; empty sets keep the largest value everywhere."""
    best = np.full((len(sets), places), np.iinfo(np.uint64).max, np.uint64)
    flat = best.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    state = np.concatenate(sets) if len(owner) else np.zeros(0, np.uint64)
    order = None  # places in the order of each element's permutation, from step 1 on
    for step in range(places):
        if not len(owner):
            break
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        value = (np.uint64(step) << STEP_BITS) | (state >> np.uint64(8))
        pick = step + (mix(state) % np.uint64(places - step)).astype(np.int64)
        each = np.arange(len(owner))
        if order is None:
            place = pick
        else:
            place = order[each, pick].astype(np.int64)
            order[each, pick] = order[:, step]
        np.minimum.at(flat, owner * places + place, value)
        going = best.max(axis=1) >> STEP_BITS > step
        live = going[owner]
        if order is None:
            order = np.tile(np.arange(places, dtype=np.uint8), (int(live.sum()), 1))
            order[np.arange(len(order)), pick[live]] = 0
        else:
            order = order[live]
        owner, state = owner[live], state[live]
    return best


def band_hashes(best: np.ndarray, s: Settings) -> np.ndarray:
    parts = best.reshape(len(best), s.bands, s.rows)
    whole = np.broadcast_to(np.arange(s.bands, dtype=np.uint64), parts.shape[:2])
    for k in range(s.rows):
        whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return whole.view(np.int64)


def set_key(elements: np.ndarray) -> bytes:
    return blake2b(elements.tobytes(), digest_size=16).digest()


def signed(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n_shingles, set_key (the same for equal sets) and one hash for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(s.words)
        for batch in by_bytes(batches, "text", limit=1 << 20):
            sets = [shingles(t) for t in texts_of(batch)]
            bands = band_hashes(signatures(sets, s.places), s)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_shingles": pa.array(map(len, sets), pa.int64()),
                    "set_key": pa.array(map(set_key, sets), pa.binary()),
                    "bands": pa.FixedSizeListArray.from_arrays(
                        pa.array(bands.reshape(-1)), s.bands
                    ).cast(pa.list_(pa.int64())),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"
    )


def with_sets(docs: DataFrame, s: Settings) -> DataFrame:
    """Columns of ``docs`` with the full set in place of the text."""
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(s.words)
        for batch in by_bytes(batches, "text", limit=1 << 20):
            sets = [shingles(t) for t in texts_of(batch)]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), lists], [*(f.name for f in kept), "elements"]
            )

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(run, f"{ddl}, elements array<bigint>")


class Family:
    """Members of one group in one task: their sets as posting lists, and who is linked."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        by_element = np.argsort(number, kind="stable")
        self.holders = owner[by_element]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(number))])
        self.members = np.split(number, np.cumsum(self.sizes)[:-1])
        frequency = np.diff(self.at)
        self.typical = np.bincount(owner, frequency[number], len(sets)) / np.maximum(self.sizes, 1)

    def linked(self, member: int, percent: int) -> np.ndarray:
        """Members whose similarity with this one is at least the given one."""
        lists = [self.holders[self.at[e] : self.at[e + 1]] for e in self.members[member]]
        shared = np.bincount(np.concatenate(lists), minlength=len(self.sizes))
        union = self.sizes[member] + self.sizes - shared
        return np.flatnonzero(100 * shared >= percent * union)


def spanning_links(
    ids: list[int], sets: list[np.ndarray], labels: list[int], pivots: list[bool], percent: int
) -> list[tuple[int, int]]:
    """Confirmed links that join what all confirmed links of the pivots join. Members with equal
    labels count as joined before."""
    family = Family(sets)
    _, part = np.unique(np.array(labels), return_inverse=True)
    found = []
    order = sorted(np.flatnonzero(pivots), key=lambda m: -family.typical[m])
    asked = ~np.array(pivots, bool)  # these compare themselves with nothing
    for n, member in enumerate(order):
        joined = part == part[order[0]]
        if n and joined[member] and joined[asked].all():
            continue  # every member outside this component is compared with it
        for other in family.linked(member, percent):
            if part[other] != part[member]:
                found.append((ids[member], ids[other]))
                part[part == part[other]] = part[member]
        if part.min() == part.max():
            break
    return found


def _linked(members: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links within the members of equal keys: doc_id, elements, label, pivot."""

    def run(rows: pa.Table) -> pa.Table:
        ids, labels = rows.column("doc_id").to_pylist(), rows.column("label").to_pylist()
        lists = rows.column("elements").combine_chunks()
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy().view(np.uint64)
        sets = [values[a:b] for a, b in zip(ends, ends[1:])]
        pivots = rows.column("pivot").to_pylist()
        found = spanning_links(ids, sets, labels, pivots, percent)
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return members.groupBy(*keys).applyInArrow(run, "a bigint, b bigint")


def confirmed_links(docs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Links between classes (doc_id, copies, bands) that join all that is similar."""
    entries = classes.select("doc_id", "copies", F.explode("bands").alias("band"))
    centers = (
        entries.groupBy("band")
        .agg(F.max(F.struct("copies", -F.col("doc_id"))).alias("most"), F.count("*").alias("n"))
        .where("n > 1")
        .select("band", (-F.col("most.col2")).alias("center"))
    )
    star = entries.join(centers, "band").where("doc_id <> center")
    groups = components(star.select(F.col("doc_id").alias("a"), F.col("center").alias("b")))
    groups = groups.toDF("doc_id", "group")
    sizes = groups.join(classes.select("doc_id", "copies"), "doc_id").groupBy("group").agg(
        F.ceil(F.count("*") / BLOCK).alias("n_blocks"),
        F.max(F.struct("copies", -F.col("doc_id"))).alias("most"),
    ).select("group", "n_blocks", (-F.col("most.col2")).alias("center"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("n_blocks"))
    placed = groups.join(sizes, "group").withColumn("block", block)
    texts = docs.select("doc_id", "text").join(placed, "doc_id")
    sets = with_sets(texts, s).where(F.size("elements") > 0)  # ids may come with empty rows too
    members = written(sets.withColumn("label", F.col("doc_id")), "sets")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    hot = members.where("n_blocks > 1")
    seats = hot.where("doc_id = center").withColumn("block", every_block)
    first = members.where("n_blocks = 1 OR doc_id <> center").unionByName(seats)
    links = written(
        _linked(first.withColumn("pivot", F.lit(True)), ["group", "block"], s.percent), "links"
    )
    if hot.isEmpty():
        return links
    reached = components(links).toDF("doc_id", "reached")
    label = F.coalesce("reached", "doc_id")
    hot = hot.drop("label").join(reached, "doc_id", "left").withColumn("label", label).drop("reached")
    mains = hot.where("doc_id = center").select("group", F.col("label").alias("main"))
    outside = hot.join(mains, "group").where("label <> main")
    counts = outside.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).alias("n_outside"))
    slot = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("n_outside"))
    asking = (
        outside.drop("main").join(counts, "group").withColumn("slot", slot)
        .withColumn("block", every_block).withColumn("pivot", F.lit(True))
    )
    every_slot = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_outside") - 1))
    asked = hot.join(counts, "group").withColumn("slot", every_slot).withColumn("pivot", F.lit(False))
    more = _linked(asking.unionByName(asked), ["group", "block", "slot"], s.percent)
    return links.union(more)


def shared_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between ids that stand in rows of several classes and the classes' ids. Only ids and
    keys are exchanged, combined before the shuffle."""
    keyed = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "set_key")
    several = (
        keyed.groupBy("doc_id")
        .agg(F.min("set_key").alias("least"), F.max("set_key").alias("most"))
        .where("least <> most")
        .select("doc_id")
    )
    held = keyed.join(several, "doc_id").distinct()
    return held.join(classes.select("set_key", F.col("doc_id").alias("b")), "set_key").select(
        F.col("doc_id").alias("a"), "b"
    )


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable), kept (it is one's own)."""
    rows = written(signed(docs, s), "signed")
    classes = written(
        rows.where("n_shingles > 0").groupBy("set_key").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    links = confirmed_links(docs, classes.drop("set_key"), s)
    reached = components(links.union(shared_ids(rows, classes)))
    labels = classes.join(reached.toDF("doc_id", "reached"), "doc_id", "left").select(
        "set_key", F.coalesce("reached", "doc_id").alias("reached")
    )
    component = F.coalesce("reached", "doc_id")
    return rows.drop("bands").join(labels, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
