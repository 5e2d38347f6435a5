"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by random signs and a fast Hadamard transform, three times over, and hashed to
the nearest of the 2d signed axes; ``hashes`` such turns make one bucket, and there are ``tables``
of buckets. A vector is stored in its own bucket of each table and also looks into ``probes`` more:
those reached by the cheapest change of one of its axes. What meets in a bucket is compared in
double precision, so no link is false; the share of links that no table sees is far below one in a
million at the similarity itself (measured in the tests), and smaller for closer vectors.

Equal vectors of a label are one class that is hashed once. A pair that meets in several buckets is
counted only in the smallest of these, so each task adds up links and hands on no pairs, only a
forest that spans what it linked. A bucket of more than ``BLOCK`` classes is cut into blocks that
meet each other in tasks of their own.

Vectors are compared only if labels are equal and not null, and so are lengths. A vector that is
null, empty, zero, or holds null or non-finite components is linked with nothing. Other columns are
not used. Repeated rows are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import written
from docgate.llm.components import components

BLOCK = 2048


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.98
    tables: int = 10
    hashes: int = 3
    probes: int = 4
    seed: int = 4


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    half = 1
    while half < d:
        x = x.reshape(n, d // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
        x = x.reshape(n, d)
    return x / np.sqrt(d)


def buckets(vectors: np.ndarray, salt: np.ndarray, s: Settings) -> np.ndarray:
    """(n, tables, 1 + probes) buckets of unit vectors: the own one first. ``salt`` keeps vectors
    apart that must not meet."""
    n, d = vectors.shape
    width = 1 << max(1, d - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :d] = vectors
    random = np.random.default_rng(s.seed)
    signs = random.choice([-1.0, 1.0], (s.tables, s.hashes, 3, width))
    out = np.empty((n, s.tables, 1 + s.probes), np.uint64)
    for table in range(s.tables):
        axes = np.empty((n, s.hashes, 1 + s.probes), np.int64)
        loss = np.empty((n, s.hashes, s.probes))
        for h in range(s.hashes):
            turned = padded
            for k in range(3):
                turned = hadamard(turned * signs[table, h, k])
            size = np.abs(turned)
            best = np.argsort(-size, axis=1)[:, : 1 + s.probes]
            if best.shape[1] < 1 + s.probes:
                best = np.pad(best, ((0, 0), (0, 1 + s.probes - best.shape[1])), mode="edge")
            rows = np.arange(n)[:, None]
            axes[:, h] = 2 * best + (turned[rows, best] < 0)
            top = size[rows, best]
            loss[:, h] = top[:, :1] - top[:, 1:]
        own = axes[:, :, 0]
        out[:, table, 0] = _named(own, table, salt)
        # The cheapest changes of one axis.
        cheap = np.argsort(loss.reshape(n, -1), axis=1, kind="stable")[:, : s.probes]
        for p in range(s.probes):
            turn, rank = cheap[:, p] // s.probes, cheap[:, p] % s.probes + 1
            changed = own.copy()
            changed[np.arange(n), turn] = axes[np.arange(n), turn, rank]
            out[:, table, 1 + p] = _named(changed, table, salt)
    return out


def _named(axes: np.ndarray, table: int, salt: np.ndarray) -> np.ndarray:
    name = mix(salt + np.uint64(table + 1))
    for h in range(axes.shape[1]):
        name = mix(name * np.uint64(0x9E3779B97F4A7C15) + axes[:, h].astype(np.uint64))
    return name


def hashed(vectors: DataFrame, s: Settings) -> DataFrame:
    """vec_id, label, key (the same for equal vectors) and buckets; key is null where the vector
    can be linked with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                lists, labels = batch.column("embedding").to_pylist(), batch.column("label").to_pylist()
                usable: dict[int, list[int]] = {}
                rows: list[np.ndarray | None] = [None] * len(lists)
                for n, (values, label) in enumerate(zip(lists, labels)):
                    if label is None or not values or None in values:
                        continue
                    row = np.array(values, float)
                    norm = np.linalg.norm(row)
                    if np.isfinite(norm) and norm > 0:
                        rows[n] = row
                        usable.setdefault(len(row), []).append(n)
                found: list[list[int] | None] = [None] * len(lists)
                for length, own in usable.items():
                    matrix = np.stack([rows[n] for n in own])
                    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
                    salt = mix(np.array([labels[n] for n in own]).astype(np.int64).view(np.uint64))
                    codes = buckets(matrix, salt ^ np.uint64(length), s).view(np.int64)
                    for n, code in zip(own, codes.reshape(len(own), -1)):
                        found[n] = code.tolist()
                keys = [None if f is None else blake2b(r.tobytes(), digest_size=16).digest()
                        for f, r in zip(found, rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").cast(pa.int64()), batch.column("label").cast(pa.int64()),
                     pa.array(keys, pa.binary()), batch.column("embedding").cast(pa.list_(pa.float64())),
                     pa.array(found, pa.list_(pa.int64()))],
                    ["vec_id", "label", "key", "embedding", "buckets"],
                )

    return vectors.select("vec_id", "label", "embedding").mapInArrow(
        run, "vec_id bigint, label bigint, key binary, embedding array<double>, buckets array<bigint>"
    )


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the components of a symmetric matrix of links."""
    n = len(linked)
    seen = np.zeros(n, bool)
    edges = []
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        front = [root]
        while front:
            member = front.pop()
            new = np.flatnonzero(linked[member] & ~seen)
            seen[new] = True
            edges += [(member, int(j)) for j in new]
            front += new.tolist()
    return edges


def links_in_bucket(
    bucket: int, unit: np.ndarray, codes: np.ndarray, side: np.ndarray, s: Settings
) -> np.ndarray:
    """Symmetric matrix of the links that are counted in this bucket. ``side`` is 0 or 1 where only
    pairs of different sides are wanted, and -1 where all are."""
    linked = unit @ unit.T >= s.cosine
    np.fill_diagonal(linked, False)
    if side[0] >= 0:
        linked &= side[:, None] != side[None, :]
    i, j = np.nonzero(np.triu(linked))
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        least = np.full(len(a), np.iinfo(np.int64).max)
        for one, other in ((a, b), (b, a)):
            own = codes[one][:, :, :1]
            met = own == codes[other]
            least = np.minimum(
                least, np.where(met, own, np.iinfo(np.int64).max).reshape(len(a), -1).min(axis=1)
            )
        elsewhere = least != bucket
        linked[a[elsewhere], b[elsewhere]] = linked[b[elsewhere], a[elsewhere]] = False
    return linked


def counted(members: DataFrame, s: Settings) -> DataFrame:
    """Rows (a, null, n): n links of a found in a bucket; rows (a, b, null): edges that span."""

    def run(rows: pa.Table) -> pa.Table:
        ids = rows.column("vec_id").to_numpy()
        copies = rows.column("copies").to_numpy()
        matrix = np.array(rows.column("embedding").to_pylist())
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        codes = np.array(rows.column("buckets").to_pylist()).reshape(len(ids), s.tables, -1)
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        side = np.full(len(ids), -1) if low == high else rows.column("block").to_numpy()
        linked = links_in_bucket(rows.column("bucket")[0].as_py(), matrix, codes, side, s)
        n = linked @ copies
        some = np.flatnonzero(n)
        edges = np.array(forest(linked), np.int64).reshape(-1, 2)
        none = [None] * len(some)
        return pa.table(
            {
                "a": pa.array(np.r_[ids[some], ids[edges[:, 0]]]),
                "b": pa.array([*none, *ids[edges[:, 1]].tolist()], pa.int64()),
                "n": pa.array([*n[some].tolist(), *[None] * len(edges)], pa.int64()),
            }
        )

    return members.groupBy("bucket", "low", "high").applyInArrow(run, "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id (the smallest id reachable) and kept (it is one's own)."""
    rows = written(hashed(vectors, s), "hashed")
    classes = written(
        rows.where("key IS NOT NULL").groupBy("label", "key").agg(
            F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"),
            F.first("embedding").alias("embedding"), F.first("buckets").alias("buckets"),
        ),
        "classes",
    )
    entries = classes.select("vec_id", F.posexplode("buckets").alias("place", "bucket")).select(
        "vec_id", "bucket", (F.col("place") % (1 + s.probes) == 0).cast("int").alias("own")
    ).groupBy("vec_id", "bucket").agg(F.max("own").alias("own"))
    shared = entries.groupBy("bucket").agg(
        F.ceil(F.count("*") / BLOCK).alias("n_blocks"), F.count("*").alias("n"), F.sum("own").alias("own")
    ).where("n > 1 AND own > 0").select("bucket", "n_blocks")
    block = F.pmod(F.xxhash64("vec_id"), F.col("n_blocks"))
    met = entries.drop("own").join(shared, "bucket").withColumn("block", block)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    members = met.select(
        "vec_id", "bucket", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    ).join(classes.select("vec_id", "copies", "embedding", "buckets"), "vec_id")
    found = written(counted(members, s), "counted")
    sums = found.where("b IS NULL").groupBy(F.col("a").alias("vec_id")).agg(F.sum("n").alias("n"))
    reached = components(found.where("b IS NOT NULL").select("a", "b")).toDF("vec_id", "reached")
    labels = classes.join(sums, "vec_id", "left").join(reached, "vec_id", "left").select(
        "label", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("reached", "vec_id").alias("reached"),
    )
    component = F.coalesce("reached", "vec_id")
    return rows.select("vec_id", "label", "key").join(labels, ["label", "key"], "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
