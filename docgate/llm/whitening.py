"""Whitening of embeddings by a bidiagonal qd solver.

Components c become x = floor(64 c) + 1000000. Rows are centred exactly in whole numbers (n x - S)
before anything is multiplied; each task reduces its centred rows block by block to a triangle by QR,
and triangles are merged likewise, so what reaches the driver is a few d x d triangles, whatever the
number of rows. There the last triangle is made bidiagonal by Householder reflections, dqds finds the
squares of its singular values, a twisted factorisation gives each direction, and the reflections
turn it back.

A row is dropped if its vector is null, empty, or holds null or non-finite entries. Vectors of the most
frequent length are the fit list (of several such lengths the longest), others are dropped. A
direction without variance has ``whitened`` null; all vectors equal (or a single one) give rows with
null there. ``deviation`` is exact, and null where it is beyond a long. Repeated rows count as often
as they come; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.llm.common import written

ROWS = 4096
TRIANGLES = 8
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Settings:
    scale: int = 64
    shift: int = 1_000_000
    components: int = 32


def integers(vectors: DataFrame, s: Settings) -> DataFrame:
    """vec_id and x of the rows that can be used."""
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * s.scale).cast("long") + s.shift)
    odd = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(F.size("embedding") > 0).where(~odd).select("vec_id", whole.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            flat = part.column("x").flatten().to_numpy()
            yield part, flat.reshape(part.num_rows, -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) if n * (np.abs(x).max(initial=0) + 1) < 2**62 else n * x.astype(object) - sums.astype(object)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right-hand reflections (as a matrix) of a square matrix."""
    a, d = r.copy(), len(r)
    right = np.eye(d)
    for k in range(d):
        for turned, column in ((a, True), (a.T, False)):
            at = k if column else k + 1
            if at >= d:
                continue
            v = turned[at:, k].copy()
            size = np.linalg.norm(v)
            if size == 0:
                continue
            v[0] += np.copysign(size, v[0])
            v /= np.linalg.norm(v)
            turned[at:, k:] -= 2 * np.outer(v, v @ turned[at:, k:])
            if not column:
                right[:, at:] -= 2 * np.outer(right[:, at:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _dqds_step(q: list[float], e: list[float], shift: float):
    """One transform; None if the shift was larger than the smallest value."""
    new_q, new_e, d = [], [], q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None
        value = d + e[i]
        new_q.append(value)
        ratio = q[i + 1] / value if value else 0.0
        new_e.append(e[i] * ratio)
        d = d * ratio - shift if value else q[i + 1] - shift
    if d < 0:
        return None
    return new_q + [d], new_e


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of the qd array: squares of singular values, falling."""
    found, parts = [], [(list(map(float, q)), list(map(float, e)), 0.0)]
    while parts:
        q, e, moved = parts.pop()
        while len(q) > 1:
            small = [
                i for i in range(len(e))
                if e[i] <= (_EPS * 0.01) ** 2 * (moved + q[i]) or e[i] <= (_EPS * 0.01) * (moved + min(q[i], q[i + 1]))
            ]
            if small:
                i = small[-1]
                parts.append((q[: i + 1], e[:i], moved))
                q, e = q[i + 1 :], e[i + 1 :]
                continue
            a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0), q[-2] * e[-1], q[-1] + e[-1]
            half = (a - c) / 2
            shift = max(0.0, min(c - b / (half + np.copysign(np.hypot(half, np.sqrt(b)), half)) if half or b else c, q[-1], min(q)) * (1 - 1e-12))
            for _ in range(6):
                step = _dqds_step(q, e, shift)
                if step is not None:
                    break
                shift *= 0.5
            if step is None:
                shift, step = 0.0, _dqds_step(q, e, 0.0)
            (q, e), moved = step, moved + shift
        found.append(q[0] + moved)
    return np.sort(found)[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of the tridiagonal matrix (diagonal a, next to it b, no zeros in b)."""
    n = len(a)
    tiny = _EPS * max(np.abs(a).max(), np.abs(b).max(initial=0), np.finfo(float).tiny) * _EPS
    down, up = np.empty(n), np.empty(n)
    for rows, pivots in ((range(n), down), (range(n - 1, -1, -1), up)):
        last = None
        for i in rows:
            pivots[i] = a[i] - value
            if last is not None:
                pivots[i] -= b[min(i, last)] ** 2 / pivots[last]
            if abs(pivots[i]) < tiny:
                pivots[i] = -tiny
            last = i
    twist = int(np.argmin(np.abs(down + up - (a - value))))
    z = np.zeros(n)
    z[twist] = 1
    for i in range(twist - 1, -1, -1):
        z[i] = -b[i] * z[i + 1] / down[i]
    for i in range(twist + 1, n):
        z[i] = -b[i - 1] * z[i - 1] / up[i]
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors (columns) of r'r / n."""
    size = np.abs(r).max(initial=0) or 1.0
    diagonal, upper, right = bidiagonal(r / size)
    d = len(diagonal)
    top = max(np.abs(diagonal).max(), np.abs(upper).max(initial=0))
    cut = np.abs(upper) <= _EPS * top * 1e-3
    pairs = []
    edges = [0, *(np.flatnonzero(cut) + 1).tolist(), d]
    for start, end in zip(edges, edges[1:]):  # blocks that do not touch
        q, e = diagonal[start:end] ** 2, upper[start : end - 1] ** 2
        a, b = q.copy(), diagonal[start : end - 1] * upper[start : end - 1]
        a[1:] += e
        for value in dqds(q, e):
            v = np.zeros(d)
            v[start:end] = twisted(a, b, value)
            pairs.append((value, v))
    pairs.sort(key=lambda p: -p[0])
    values = np.array([p[0] for p in pairs])
    basis = right @ np.array([p[1] for p in pairs]).T
    basis, turned = np.linalg.qr(basis)  # close values: their directions made orthogonal, in order
    return values * size * size / n, basis * np.sign(np.diag(turned) + (np.diag(turned) == 0))


def whiten(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = written(integers(vectors, s), "integers")
    kind = rows.schema["vec_id"].dataType.simpleString()
    empty = rows.sparkSession.createDataFrame(
        [], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double",
    )
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return empty
    d, n = length["d"], length["count"]
    rows = rows.where(F.size("x") == d)
    sums = np.array([
        int(r["total"]) for r in rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
            F.sum(F.col("v").cast("decimal(38,0)")).alias("total")
        ).orderBy("at").collect()  # one row for each dimension
    ])

    def triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for _, x in _matrices(batches):
            r = np.linalg.qr(np.vstack([r, _centred(x, n, sums).astype(float) / n]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": [r.tobytes()]})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for part in batch.column("r").to_pylist():
                r = np.linalg.qr(np.vstack([r, np.frombuffer(part).reshape(-1, d)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": [r.tobytes()]})

    parts = rows.select("x").mapInArrow(triangle, "r binary").repartition(TRIANGLES).mapInArrow(merged, "r binary")
    r = np.linalg.qr(
        np.vstack([np.frombuffer(p["r"]).reshape(-1, d) for p in parts.collect()] + [np.zeros((d, d))]), mode="r"
    )
    values, basis = directions(r, n)
    total = float(values.sum())
    k = min(s.components, d)
    flat = values[:k] <= max(values[0], 0) * d * _EPS * _EPS * 1e4
    turn = np.where(flat, np.nan, basis[:, :k] / np.sqrt(np.where(flat, 1, values[:k])))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches):
            centred = _centred(x, n, sums)
            exact = [sum(int(v) * int(v) for v in row) for row in centred.tolist()]
            white = centred.astype(float) / n @ turn
            yield pa.RecordBatch.from_pydict({
                "vec_id": part.column("vec_id"),
                "deviation": pa.array([v if v < 2**63 else None for v in exact], pa.int64()),
                "white": pa.array(white.tolist(), pa.list_(pa.float64())),
            })

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Count, mean and products of a task's rows, centred on their own mean block by block."""
        count, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = batch.column("white").flatten().to_numpy().reshape(batch.num_rows, k)
            if len(w):
                own = w.mean(axis=0)
                gap = own - mean
                products += (w - own).T @ (w - own) + np.outer(gap, gap) * count * len(w) / (count + len(w))
                mean, count = mean + gap * len(w) / (count + len(w)), count + len(w)
        yield pa.RecordBatch.from_pydict(
            {"count": [count], "mean": [mean.tobytes()], "products": [products.tobytes()]}
        )

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for r in batch.to_pylist():
                if r["count"]:
                    gap = np.frombuffer(r["mean"]) - mean
                    both = count + r["count"]
                    products = products + np.frombuffer(r["products"]).reshape(k, k)
                    products += np.outer(gap, gap) * count * r["count"] / both
                    mean, count = mean + gap * r["count"] / both, both
        yield pa.RecordBatch.from_pydict(
            {"count": [count], "mean": [mean.tobytes()], "products": [products.tobytes()]}
        )

    white = written(
        rows.mapInArrow(projected, f"vec_id {kind}, deviation bigint, white array<double>"), "whitened"
    )
    layout = "count bigint, mean binary, products binary"
    sums_of = white.select("white").mapInArrow(moments, layout).repartition(TRIANGLES).mapInArrow(together, layout)
    last = next(together(iter(pa.Table.from_pylist([r.asDict() for r in sums_of.collect()]).to_batches())))
    covariance = np.frombuffer(last.column("products")[0].as_py()).reshape(k, k) / n
    error = np.abs(covariance - np.eye(k))[~flat][:, ~flat]
    shares = F.array(*[F.lit(float(v / total) if total > 0 else 0.0) for v in values[:k]])
    exploded = white.select("vec_id", "deviation", F.posexplode("white").alias("at", "w"))
    return exploded.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(~F.isnan("w"), F.col("w")).alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
        F.lit(float(error.max(initial=0))).alias("identity_error"),
    )
