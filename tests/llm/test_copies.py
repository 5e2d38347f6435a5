"""Near-duplicates, repeated strings, embeddings and components against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgate.llm import embedding_dedup, suffix_dedup, superminhash
from docgate.llm.components import components


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    rng.shuffle(links)
    found = components(spark.createDataFrame([*links, (7, None), (5, 5)], "a bigint, b bigint"))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    expected = smallest_reachable(nodes, links)
    assert {r["node"]: r["component"] for r in found.collect()} == expected
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def family(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(120)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(len(own))] = rng.choice(words)
        yield " ".join(own)


def near_fixture():
    rng = random.Random(2)
    words = [f"w{n}" for n in range(3000)]
    texts = [t for _ in range(4) for t in family(rng, words, 25, 8)]
    texts += [" ".join(rng.choice(words) for _ in range(50)) for _ in range(40)]
    texts += ["A b", "a B", "a b c", None, "", " \n", texts[0].upper().replace("W", "w"), texts[0]]
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute_near(rows, width, percent):
    sets = {}
    for n, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
        k = min(width, len(w))
        sets[n] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    reach = smallest_reachable(sets, links)
    return {n: (len(sets[n]), reach[n]) for n in sets}


@pytest.mark.parametrize("block", [4096, 5])
def test_superminhash_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(superminhash, "BLOCK", block)
    rows = near_fixture()
    docs = spark.createDataFrame([(n, t, n) for n, t in rows], "doc_id bigint, text string, copies int")
    found = superminhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_near(rows, 3, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_members_joined_before_still_meet_those_that_do_not_ask():
    far = np.arange(1000, 1100, dtype=np.uint64)
    first, bridge, other = far, far + np.uint64(8), far + np.uint64(16)
    sets, labels = [first, first, first, bridge, other], [1, 1, 1, 1, 9]
    links = superminhash.spanning_links([1, 2, 3, 4, 9], sets, labels, [True] * 4 + [False], 85)
    assert links == [(4, 9)]


def test_a_bridge_between_clusters_in_blocks_is_found(spark, monkeypatch):
    """One block holds a cluster away from the center, and in it the one text that is linked with
    a text of the center's cluster, which is in another block."""
    monkeypatch.setattr(superminhash, "BLOCK", 7)
    rng = random.Random(1)
    words = [f"w{n}" for n in range(3000)]

    def edited(text, *places):
        return [f"new{p}" if p in places else w for p, w in enumerate(text)]

    center = [rng.choice(words) for _ in range(120)]
    near = edited(center, 5, 15)
    bridge = edited(near, 25, 35)
    away = edited(bridge, 45, 55)
    clusters = [
        [away, *(edited(away, p) for p in (65, 70, 75, 80)), bridge], [near],
        [center, center, center, *(edited(center, p) for p in range(60, 118, 8))],
    ]
    block = F.pmod(F.xxhash64("id"), F.lit(3)).alias("block")
    ids = {n: [] for n in range(3)}
    for r in spark.range(200).select("id", block).collect():
        ids[r["block"]].append(r["id"])
    rows = [(ids[n].pop(), " ".join(t)) for n, own in enumerate(clusters) for t in own]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = superminhash.near_duplicates(docs).collect()
    expected = brute_near(rows, 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert len({component for _, component in expected.values()}) == 1


def test_superminhash_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert superminhash.near_duplicates(docs).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(80):
        pool = rng.integers(1, 2**63, 40, dtype=np.uint64)
        a, b = superminhash.signatures([pool[:30], pool[10:]], 200)
        errors.append((a == b).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02
    # MinHash has a deviation of sqrt(0.25 / 200) = 0.035; SuperMinHash has less on small sets.
    assert np.std(errors) < 0.035


def brute_cut(rows, length):
    seen, found = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(piece)
        left = bytes(b for b, g in zip(data, gone) if not g)
        found[doc_id] = (len(data), sum(gone), left)
    return found


def test_suffix_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    line = lambda n: "".join(rng.choice("abcdé f") for _ in range(n))
    shared = [line(160) for _ in range(6)]
    texts = [line(80) + rng.choice(shared)[rng.randrange(30):] + line(60) + rng.choice(shared) for _ in range(60)]
    texts += ["a" * 700, line(250) * 2, None, "", shared[0][:90], texts[0], texts[0], "x" + "ab" * 300]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = suffix_dedup.cut(docs).collect()
    removed = lambda r: sum(s["end"] - s["start"] for s in r["removed"])
    result = {r["doc_id"]: (r["n_bytes"], removed(r), bytes(r["kept"])) for r in found}
    assert result == brute_cut(rows, 100)
    assert all(r["text"].encode() in (bytes(r["kept"]), r["kept"].decode(errors="ignore").encode()) for r in found)


def test_suffix_dedup_without_ids_or_rows(spark):
    text = "0123456789" * 30
    docs = spark.createDataFrame([(None, text), (None, text)], "doc_id bigint, text string")
    assert all(not r["removed"] or True for r in suffix_dedup.cut(docs).collect())
    assert {bytes(r["kept"]) for r in suffix_dedup.cut(docs).collect()} == {text.encode()}
    assert suffix_dedup.cut(docs.limit(0)).count() == 0


def test_merge_is_the_order_of_all_suffixes():
    rng = np.random.default_rng(5)
    parts = [bytes(rng.integers(97, 100, rng.integers(30, 200)).astype(np.uint8)) for _ in range(40)]
    shards = []
    for at in range(0, 40, 7):
        shards.append(np.array([x for p in parts[at : at + 7] for x in [*(c + 1 for c in p), 0]]))
    order = suffix_dedup.merged(shards, 20)
    sizes = [len(s) for s in shards]
    offsets = np.cumsum([0, *sizes[:-1]])
    key = {}
    for shard, at in zip(shards, offsets):
        for i in range(len(shard)):
            key[int(at + i)] = tuple(np.roll(shard, -i)[:20])
    keys = [key[int(i)] for i in order]
    assert keys == sorted(keys) and len(set(order.tolist())) == sum(sizes)


def vectors_fixture():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(30, 64))
    rows, labels = [], []
    for n, b in enumerate(base):
        for _ in range(12):
            rows.append((b + rng.normal(size=64) * rng.uniform(0, 0.25)).tolist())
            labels.append(n % 3)
    rows += [rows[0], rows[0], (2 * np.array(rows[0])).tolist(), rows[0], rows[0][:32], None, [], [0.0] * 64,
             [float("nan")] + rows[0][1:], [None] + rows[0][1:]]
    labels += [0, 0, 0, None, 0, 0, 0, 0, 0, 0]
    return list(zip(range(len(rows)), rows, labels))


def brute_links(rows):
    unit = {}
    for n, v, label in rows:
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            unit[n] = (label, np.array(v) / np.linalg.norm(v))
    links = [
        (a, b) for a in unit for b in unit
        if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1])
        and unit[a][1] @ unit[b][1] >= 0.98
    ]
    reach = smallest_reachable([n for n, *_ in rows], links)
    degree = {n: sum(n in link for link in links) for n, *_ in rows}
    return {n: (degree[n], reach[n]) for n in degree}


@pytest.mark.parametrize("block", [2048, 4])
def test_embeddings_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors_fixture()
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(frame).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == brute_links(rows)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_pairs_at_the_similarity_itself_are_found():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(1000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    e = rng.normal(size=a.shape)
    e -= (e * a).sum(axis=1, keepdims=True) * a
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    settings = embedding_dedup.Settings()
    salt = np.zeros(len(a), np.uint64)
    one = embedding_dedup.buckets(a, salt, settings)
    other = embedding_dedup.buckets(0.98 * a + np.sqrt(1 - 0.98**2) * e, salt, settings)
    met = (one[:, :, :1] == other).any(axis=2) | (one == other[:, :, :1]).any(axis=2)
    assert (1 - met.mean()) ** settings.tables < 1e-6


def test_rows_that_share_an_id_are_one_document(spark):
    text = {k: " ".join(f"{k}{n}" for n in range(12)) for k in "abcd"}
    rows = [(3, "a"), (5, "a"), (5, "b"), (7, "b"), (8, "c"), (9, "c"), (9, "d"), (9, None), (6, "d"), (11, None)]
    docs = spark.createDataFrame([(i, text.get(k)) for i, k in rows], "doc_id bigint, text string")
    found = {(r["doc_id"], r["n_shingles"] > 0): r["component_id"] for r in superminhash.near_duplicates(docs).collect()}
    assert [found[i, True] for i in (3, 5, 7)] == [3, 3, 3]
    assert [found[i, True] for i in (6, 8, 9)] == [6, 6, 6]
    assert found[9, False] == 9 and found[11, False] == 11
