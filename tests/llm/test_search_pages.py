"""Page differencing, hard negatives and whitening."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docgate.llm import catalog, hard_negatives, page_diff, whitening

DATA = "/root/testdata/sf0.01"


def test_lines_of_a_page():
    html = (
        "<head><title>T</title></head><nav><ul><li>menu</ul></nav><div class='Cookie-bar'>c</div>"
        "<main><header><h1>A &amp;\n B</h1></header><p>one<br>two<p>three<script>var t='</p>';</script>"
        "<section id=comments><p>said</section><ul><li>x<li>y</ul><form>f</form></main><footer>&copy;</footer>"
    )
    assert [t for _, t in page_diff.lines(html)] == ["A & B", "one two", "three", "x", "y"]
    assert page_diff.lines("a < b <p title='>'>c") == [(1, "a < b"), (1, "c")]
    assert page_diff.lines("") == [] and page_diff.lines("<a href='x>y") == [(1, "y")]
    assert page_diff.lines("<p>x</p>" * 50_000) == [(1, "x")] * 50_000


def test_common_subsequence(monkeypatch):
    random = np.random.default_rng(1)
    for cells in (1, 4, 1000):
        monkeypatch.setattr(page_diff, "CELLS", cells)
        for _ in range(300):
            a, b = (random.integers(0, 5, random.integers(0, 12)).tolist() for _ in range(2))
            x, y = page_diff.shared(a, b)
            length = np.zeros((len(a) + 1, len(b) + 1), int)
            for i, v in enumerate(a):
                for j, w in enumerate(b):
                    length[i + 1, j + 1] = length[i, j] + 1 if v == w else max(length[i, j + 1], length[i + 1, j])
            assert [v for v, m in zip(a, x) if m] == [w for w, m in zip(b, y) if m]
            assert x.sum() == length[-1, -1]


def _host_pages(n):
    body = "<div>Top of all</div><div>{}</div><p>Story {} is told here at some length</p><p>It ends {}</p><div>Bottom</div>"
    return [(i, f"http://h/a/{i:05d}?x={i}", body.format("Seen on many pages", i, i * i)) for i in range(n)]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_lines_shared_by_nearest_urls_go(spark, limit):
    rows = _host_pages(400)  # more than one block
    rows += [(1000, "http://H/a/00007#top", rows[7][2]), (1000, "http://H/a/00007#top", rows[7][2])]
    rows += [(2000, "http://other/", rows[3][2]), (2001, None, "<p>x"), (2002, "http://h/a/00003", None), (None, "odd", "")]
    pages = spark.createDataFrame(
        [(*r, "clash", "clash") for r in rows], "page_id bigint, url string, html string, lines string, seq string"
    )
    out = page_diff.main_text(pages, broadcast_limit=limit).collect()
    assert len(out) == len(rows)
    for r in out:
        i = r["page_id"]
        if i is not None and (i < 400 or i == 1000):
            i = 7 if i == 1000 else i
            assert r["text"] == f"Story {i} is told here at some length\nIt ends {i * i}"
        assert r["n_chars"] == len(r["text"])
    by_id = {r["page_id"]: r["text"] for r in out}
    assert by_id[2000].startswith("Top of all\nSeen") and by_id[2001] == "x" and by_id[2002] == by_id[None] == ""
    assert page_diff.main_text(pages.limit(0)).count() == 0


def test_shared_lines_of_an_article_stay(spark):
    page = "<div>Bar {0} off</div><div>Bar</div><article><p>Licence line</p><p>Own text number {0}</p></article>"
    pages = spark.createDataFrame([(i, f"http://h/{i}", page.format(i)) for i in range(9)], "page_id int, url string, html string")
    texts = {r["page_id"]: r["text"] for r in page_diff.main_text(pages).collect()}
    assert texts == {i: f"Bar {i} off\nLicence line\nOwn text number {i}" for i in range(9)}


def test_pages_of_the_table(spark):
    found = {r["page_id"]: r["text"] for r in catalog.op11_page_diff(spark, DATA).collect()}
    for page_id, html in duckdb.sql(f"SELECT page_id, html FROM '{DATA}/pages.parquet'").fetchall():
        article = html[html.index("<article>") : html.index("</article>")]
        kept = [t for _, t in page_diff.lines(article)]
        assert found[page_id] == "\n".join(kept) and len(kept) > 0
    assert len(found) == 250


def clip(score):
    return max(-hard_negatives._LONG, min(hard_negatives._LONG, score))


def _brute(rows, is_anchor, s):
    usable = [
        (i, n, label, [int(np.floor(v * s.scale)) for v in x])
        for n, (i, label, x) in enumerate(rows)
        if i is not None and label is not None and x and all(v is not None and np.isfinite(v) for v in x)
    ]
    out = []
    for i, n, label, x in usable:
        if not is_anchor(i):
            continue
        met = sorted(
            (-clip(sum(p * q for p, q in zip(x, y))), j, m, other) for j, m, other, y in usable if m != n and len(x) == len(y)
        )
        for p, positive, _, _ in [r for r in met if r[3] == label][: s.positives]:
            fits = [r for r in met if r[3] != label and s.low * -p <= 100 * -r[0] <= 100 * -p][: s.negatives]
            out += [(i, positive, k + 1, r[1], -p, -r[0]) for k, r in enumerate(fits)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    random = np.random.default_rng(3)
    rows = []
    for i in range(600):
        centre = random.normal(size=8) if i % 40 == 0 else centre
        rows.append((i, int(random.integers(0, 4)), (centre + random.normal(size=8) / 6).tolist()))
    rows += [(700, 1, rows[5][2]), (701, 1, rows[5][2]), (701, 1, rows[5][2]), (800, 2, [0.0] * 8), (900, 1, [1.0, 2.0])]
    rows += [(1000, None, [1.0] * 8), (1001, 1, None), (1002, 1, [None] * 8), (1003, 1, [float("nan")] * 8), (None, 1, [1.0] * 8)]
    rows += [(1004, 2, []), (1100, 3, [1e9] * 8), (1101, 1, [0.9e9] * 8), (1102, 3, [1.1e9] * 8)]
    vectors = spark.createDataFrame(
        [(*r, "clash") for r in rows], "vec_id bigint, label int, embedding array<double>, angles string"
    )
    s = hard_negatives.Settings()
    monkeypatch.setattr(hard_negatives, "SLOT", 30)
    monkeypatch.setattr(hard_negatives, "GROUP", 8)
    found = hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, s).collect()
    assert sorted(map(tuple, found)) == _brute(rows, lambda i: i % 100 == 0, s)
    assert hard_negatives.mine(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_hold_for_all_pairs():
    random = np.random.default_rng(5)
    s = hard_negatives.Settings()
    for d in (2, 8, 64):
        x = np.floor(256 * random.normal(size=(300, d)) * random.uniform(0.1, 3, (300, 1)))
        norms = np.linalg.norm(x, axis=1)
        angles = np.arccos(np.clip(x @ hard_negatives._directions(d, s).T / norms[:, None], -1, 1))
        for at in range(0, 300, 10):
            w = slice(at, at + 10)
            low, high = hard_negatives.bounds(
                angles, norms, angles[w].min(axis=0), angles[w].max(axis=0), norms[w].min(), norms[w].max()
            )
            exact = x @ x[w].T
            assert (exact.min(axis=1) >= low).all() and (exact.max(axis=1) <= high).all()


def test_hard_negatives_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    expected = sorted(con.execute(hard_negatives.sql()).fetchall())
    assert sorted(map(tuple, catalog.op12_hard_negatives(spark, DATA).collect())) == expected and expected


@pytest.mark.parametrize("shape", ["plain", "scaled", "flat", "equal", "narrow"])
def test_directions(shape):
    random = np.random.default_rng(7)
    x = {
        "plain": random.normal(size=(500, 64)), "scaled": random.normal(size=(300, 20)) * np.logspace(0, -5, 20),
        "flat": np.diag([3.0, 3, 2, 1, 0]), "equal": np.zeros((4, 4)), "narrow": random.normal(size=(30, 1)),
    }[shape]
    r = np.linalg.qr(np.vstack([x, np.zeros((x.shape[1], x.shape[1]))]), mode="r")
    values, basis = whitening.directions(r, len(x))
    covariance = x.T @ x / len(x)
    assert np.allclose(values, np.linalg.eigvalsh(covariance)[::-1], rtol=1e-12, atol=1e-15)
    assert np.allclose(covariance @ basis, basis * values, atol=1e-13)
    assert np.allclose(basis.T @ basis, np.eye(len(values)), atol=1e-13)


def test_whitening_equals_a_plain_solver(spark):
    found = catalog.op13_whitening(spark, DATA).toPandas()
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{DATA}/embeddings.parquet'").fetchall()
    x = np.floor(np.array([r[1] for r in rows], float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:32], basis[:, ::-1][:, :32]
    white = centred @ basis / np.sqrt(values)
    got = found.pivot(index="vec_id", columns="component", values="whitened").loc[[r[0] for r in rows]].to_numpy()
    assert np.allclose(np.abs(got), np.abs(white), atol=1e-7)
    assert (found.identity_error <= 1e-9).all() and found.identity_error.nunique() == 1 and (found.n == n).all()
    exact = dict(zip((r[0] for r in rows), ((n * x - sums) ** 2).sum(axis=1).tolist()))
    assert all(exact[i] == v for i, v in zip(found.vec_id, found.deviation))
    explained = found.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, values / np.trace(centred.T @ centred / n), rtol=1e-9)


def test_whitening_of_odd_rows(spark):
    layout = "vec_id bigint, embedding array<float>, whitened string"
    rows = [(1, [1.0, 2.0], "c"), (2, [3.0, 1.0], "c"), (2, [3.0, 1.0], "c"), (4, None, "c"), (5, [None, 1.0], "c")]
    rows += [(6, [float("nan"), 1.0], "c"), (7, [], "c"), (8, [1.0], "c"), (None, [0.0, 0.0], "c"), (9, [float("inf"), 0.0], "c")]
    out = whitening.whiten(spark.createDataFrame(rows, layout)).collect()
    assert len(out) == 8 and {r["n"] for r in out} == {4}
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "c")] * 3, layout)).collect()
    assert len(same) == 6 and all(r["whitened"] is None and r["deviation"] == 0 for r in same)
    assert whitening.whiten(spark.createDataFrame([], layout)).count() == 0
