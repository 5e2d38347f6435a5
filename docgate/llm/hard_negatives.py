"""Hard negatives by angular triangle filtering.

Components x become floor(scale * x); a score is the integer inner product of two such vectors. Each
row stores its norm and its angles to ``references`` fixed random directions. By the triangle
inequality on the sphere the angle between two rows lies between |a - b| and min(a + b, 2 pi - a - b)
for every reference, so the cosine lies in an interval, and times the norms so does the score; the
bounds are widened by more than their rounding error. Rows are put in windows of ``WINDOW`` rows with
like angles, which hold the extremes of their members: only windows whose bounds reach a score that
an anchor still wants are scored, exactly.

Rows are dealt over slots by a hash, anchors over groups of at most ``GROUP``; each pair of slot and
group is one task's work of bounded size, and hands on the best ``k`` for each wish of each anchor.
First the anchors' positives are found so, then the negatives of each positive.

Only rows with id, label and a vector of finite components take part; vectors are compared if they
have the same length. Repeated rows are rows of their own. Ties go to the smaller id. Sums beyond 53
bits are done in Python's integers, and a score beyond a long counts as the nearest long. An empty
table, or one without anchors, gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgate.llm.common import written

WINDOW = 256
SLOT = 16_384
GROUP = 2048
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    """A negative's score is from ``low`` / 100 of the positive's score up to the whole of it."""

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    low: int = 80
    references: int = 16
    seed: int = 12


def _directions(d: int, s: Settings) -> np.ndarray:
    turned = np.random.default_rng([s.seed, d]).normal(size=(s.references, d))
    return turned / np.linalg.norm(turned, axis=1, keepdims=True)


def stored(vectors: DataFrame, s: Settings) -> DataFrame:
    """vec_id, label, x (whole numbers as doubles), norm and angles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                xs, norms, angles, kept = [], [], [], []
                for n, values in enumerate(part.column("embedding").to_pylist()):
                    if not values or None in values or not np.isfinite(values).all():
                        continue
                    x = np.floor(np.array(values, float) * s.scale)
                    if not np.isfinite(x).all():
                        x = np.floor(np.clip(np.array(values, float), -1e300, 1e300) * s.scale)
                    top = np.abs(x).max() or 1.0
                    norm = float(np.linalg.norm(x / top))
                    cosine = _directions(len(x), s) @ (x / top) / (norm or 1.0)
                    kept.append(n)
                    xs.append(x.tolist())
                    norms.append(norm * top if norm else 0.0)
                    angles.append(np.arccos(np.clip(cosine, -1, 1)).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(kept, pa.int64())),
                     part.column("label").take(pa.array(kept, pa.int64())), pa.array(xs, pa.list_(pa.float64())),
                     pa.array(norms, pa.float64()), pa.array(angles, pa.list_(pa.float64()))],
                    ["vec_id", "label", "x", "norm", "angles"],
                )

    usable = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return usable.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding"
    ).mapInArrow(run, "vec_id bigint, label bigint, x array<double>, norm double, angles array<double>")


def bounds(
    own: np.ndarray, norm: np.ndarray, least: np.ndarray, most: np.ndarray, small: float, large: float
) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score of anchors with a window's rows, from the extremes of its angles and
    norms. Scores outside are impossible, also after rounding."""
    near = np.maximum(0, np.maximum(own - most, least - own)).max(axis=1)
    far = np.minimum(own + most, 2 * np.pi - own - least).min(axis=1)
    # Angles near 0 and pi lose half of the digits of their cosine.
    top = np.cos(np.maximum(0, near - 1e-6))
    bottom = np.cos(np.minimum(np.pi, far + 1e-6))
    slack = 1e-9 * norm * large + 1
    high = np.where(top > 0, top * large, top * small) * norm + slack
    return np.where(bottom < 0, bottom * large, bottom * small) * norm - slack, high


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond a long, the nearest long."""
    if a.size == 0 or b.size == 0 or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], object) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -_LONG, _LONG).astype(np.int64)


def _best(found: list, ids: np.ndarray, uids: np.ndarray, values: np.ndarray, k: int) -> list:
    new = [(-int(v), int(i), int(u)) for v, i, u in zip(values, ids, uids)]
    return sorted(found + new)[:k]


def _windows(rows: pa.Table) -> Iterator[tuple]:
    """Rows with like angles together: (ids, uids, labels, x, least and most angles, norms)."""
    ids, uids = rows.column("vec_id").to_numpy(), rows.column("uid").to_numpy()
    labels, norms = rows.column("label").to_numpy(), rows.column("norm").to_numpy()
    lists = rows.column("x").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    for d in np.unique(lengths):
        own = np.flatnonzero(lengths == d)
        some = rows.take(pa.array(own))
        x = some.column("x").combine_chunks().flatten().to_numpy().reshape(len(own), d)
        angles = some.column("angles").combine_chunks().flatten().to_numpy().reshape(len(own), -1)
        near = angles.argmin(axis=1)
        order = np.lexsort((angles.min(axis=1), near))
        for at in range(0, len(order), WINDOW):
            w = order[at : at + WINDOW]
            yield ids[own[w]], uids[own[w]], labels[own[w]], x[w], angles[w], norms[own[w]]


def _found(anchors: pa.Table, rows: pa.Table, s: Settings, positives: bool) -> pa.Table:
    """The best rows of a slot for each wish of the anchors: a wish is the anchor itself when positives
    are looked for, and one of its positives after that."""
    out = {"anchor": [], "wish": [], "uid": [], "vec_id": [], "score": []}
    k = s.positives if positives else s.negatives
    if anchors.num_rows and rows.num_rows:
        lists, angles = anchors.column("x").to_pylist(), np.array(anchors.column("angles").to_pylist())
        labels, norms = anchors.column("label").to_numpy(), anchors.column("norm").to_numpy()
        uids = anchors.column("uid").to_pylist()
        wishes = [[(None, _LONG, -_LONG)]] * len(uids) if positives else [
            # 100 * negative >= low * positive, rounded up to a whole score
            [(w["uid"], w["score"], -((-s.low * w["score"]) // 100)) for w in own if w["score"] >= 0]
            for own in anchors.column("wishes").to_pylist()
        ]
        held = [[[] for _ in own] for own in wishes]
        for ids, own_uids, own_labels, x, own_angles, own_norms in _windows(rows):
            same = np.array([n for n, v in enumerate(lists) if len(v) == x.shape[1] and wishes[n]], int)
            if not len(same):
                continue
            low, high = bounds(
                angles[same], norms[same], own_angles.min(axis=0), own_angles.max(axis=0),
                own_norms.min(), own_norms.max(),
            )
            wanted = [
                n for n, lo, hi in zip(same, low, high)
                if any(
                    lo <= upper and hi >= (-best[-1][0] if len(best) == k else lower)
                    for (_, upper, lower), best in zip(wishes[n], held[n])
                )
            ]
            if not wanted:
                continue
            for n, values in zip(wanted, scores(np.array([lists[n] for n in wanted]), x)):
                fits = (own_labels == labels[n]) == positives
                if positives:
                    fits &= own_uids != uids[n]
                for place, (_, upper, lower) in enumerate(wishes[n]):
                    best = held[n][place]
                    least = -best[-1][0] if len(best) == k else lower
                    hit = np.flatnonzero(fits & (values <= upper) & (values >= least))
                    if len(hit) > k:  # the k largest, and what ties with the last of them
                        least = np.sort(values[hit])[-k]
                        hit = hit[values[hit] >= least]
                        hit = hit[np.lexsort((ids[hit], -values[hit]))[:k]]
                    if len(hit):
                        held[n][place] = _best(best, ids[hit], own_uids[hit], values[hit], k)
        for n, own in enumerate(held):
            for (wish, _, _), best in zip(wishes[n], own):
                for score, vec_id, uid in best:
                    out["anchor"].append(uids[n])
                    out["wish"].append(wish)
                    out["uid"].append(uid)
                    out["vec_id"].append(vec_id)
                    out["score"].append(-score)
    return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})


def _searched(anchors: DataFrame, rows: DataFrame, slots: int, groups: int, s: Settings, positives: bool):
    """Each group of anchors meets each slot of rows; the best of all slots are kept."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")).withColumn(
        "slot", every(slots)
    ).groupBy("slot", "group")
    right = rows.withColumn("slot", F.pmod(F.xxhash64("uid"), F.lit(slots)).cast("int")).withColumn(
        "group", every(groups)
    ).groupBy("slot", "group")
    found = left.cogroup(right).applyInArrow(
        lambda a, b: _found(a, b, s, positives),
        "anchor bigint, wish bigint, uid bigint, vec_id bigint, score bigint",
    )
    order = Window.partitionBy("anchor", "wish").orderBy(F.col("score").desc(), "vec_id", "uid")
    k = s.positives if positives else s.negatives
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, s: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = written(stored(vectors, s).withColumn("uid", F.monotonically_increasing_id()), "angles")
    asked = rows.where(is_anchor)
    n, n_asked = rows.count(), asked.count()
    slots, groups = max(16, -(-n // SLOT)), max(1, -(-2 * n_asked // GROUP))
    positives = written(
        _searched(asked, rows, slots, groups, s, True).select(
            "anchor", F.struct("uid", "vec_id", "score").alias("wish")
        ).groupBy("anchor").agg(F.collect_list("wish").alias("wishes")),
        "positives",
    )
    wishing = written(asked.join(positives, F.col("uid") == F.col("anchor")).drop("anchor"), "wishes")
    negatives = _searched(wishing, rows, slots, groups, s, False)
    pairs = positives.join(asked.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    pairs = pairs.select("anchor", "anchor_id", F.explode("wishes").alias("p")).select(
        "anchor", "anchor_id", F.col("p.uid").alias("wish"), F.col("p.vec_id").alias("positive_id"),
        F.col("p.score").alias("positive_score"),
    )
    return negatives.join(pairs, ["anchor", "wish"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def sql(s: Settings = Settings()) -> str:
    """The same rows of ``embeddings`` in DuckDB, all scores at once."""
    return f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({s.scale} * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_inner_product(a.x, b.x)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {s.positives}
)
SELECT p.anchor_id, p.positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other))::INTEGER AS rank,
  n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE {s.low} * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= {s.negatives}"""
