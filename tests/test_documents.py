import json
import random
import time

import pytest

from docgate.functions import html
from docgate.functions.html import html_text
from docgate.operators import chunks as chunk_ops
from docgate.operators import documents as ops
from docgate.sources.objects import read_objects
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    "name, content_type, mime",
    [
        ("doc.pdf", None, "application/pdf"),
        ("doc.html", None, "text/html"),
        ("A.HTM", None, "text/html"),
        ("doc.bin", None, "application/octet-stream"),
        ("doc.pdf", "", "application/pdf"),
        ("doc.pdf", "text/plain", "text/plain"),
    ],
)
def test_mime(spark, name, content_type, mime):
    df = spark.createDataFrame([(name, content_type)], "name string, content_type string")
    assert ops.with_mime(df).first()["mime"] == mime


def test_html_text(spark):
    page = (
        "<html><SCRIPT>var a='<p>';</SCRIPT><style>p{}</style><!-- a\nb --><p>Tom &amp;&nbsp;Ann"
        "</p>\n<b>&lt;x&gt; &quot;y&quot; &#39;z&#39; &amp;lt; &copy;</b></html>"
    )
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(html_text(F.col("html"))).first()[0] == (
        "Tom & Ann <x> \"y\" 'z' &lt; &copy;"
    )


def test_stored_objects_become_ingest_events(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.html").write_text("<p>Hello</p>")
    (tmp_path / "b.bin").write_bytes(b"\x00\x01")
    objects = ops.with_mime(read_objects(spark, str(tmp_path)))
    names = {r["name"]: r["mime"] for r in objects.collect()}
    assert names == {"sub/a.html": "text/html", "b.bin": "application/octet-stream"}
    events = ops.document_events(ops.extract_text(objects))
    (row,) = events.collect()
    body = json.loads(row["data"].decode())
    assert body["trace_id"] == "sub/a.html"
    assert body["event_type"] == "data_ingest"
    assert body["version"] == "1.0"
    assert body["payload"]["content"] == "Hello"
    assert body["payload"]["source_url"].endswith("sub/a.html")
    assert body["timestamp"].endswith("+00:00")
    assert chunk_ops.ingest_summary(events).first()["chunk_count"] == 1


def test_object_listing_does_not_read_the_bytes(spark, tmp_path, plan):
    (tmp_path / "a.html").write_text("x")
    assert "content" not in plan(read_objects(spark, str(tmp_path)).select("name", "length"))


def test_large_pages_do_not_exhaust_the_stack(spark):
    page = "<script>" + "x = 1;\n" * 300_000 + "</script><p>" + "word " * 200_000 + "</p><!-- " + "y\n" * 300_000 + "-->"
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(F.length(html_text(F.col("html")))).first()[0] == 5 * 200_000 - 1


PIECES = ["<", ">", "<script", "<SCRIPT>", "</script>", "</Script>", "<style a>", "</style>", "<!--", "-->", "x", " ", "İ", "é\n"]


def test_marks_in_any_order_are_removed_as_by_the_patterns(spark):
    rng = random.Random(11)
    pages = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(p,) for p in [*pages, None]], "html string")
    plain = F.col("html")
    for pattern in html.REMOVED:
        plain = F.regexp_replace(plain, pattern, " ")
    plain = F.trim(F.regexp_replace(plain, html.BLANKS, " "))
    rows = df.select("html", plain.alias("want"), html.html_text(F.col("html")).alias("got")).collect()
    assert [r for r in rows if r["got"] != r["want"]] == []


@pytest.mark.parametrize(
    "page",
    ["<" * 1_000_000, "<script" * 150_000, "<script>" * 120_000, "<style>" * 150_000, "<!--" * 250_000,
     "<script" * 150_000 + "</script>", "<script>" * 120_000 + "</script><" + "<style" * 9_000 + "</style>"],
)
def test_unclosed_marks_take_linear_time(spark, page):
    df = spark.createDataFrame([(page,)], "html string")
    start = time.monotonic()
    assert df.select(F.length(html.html_text(F.col("html"))).alias("n")).first()["n"] >= 0
    assert time.monotonic() - start < 10


def test_object_names_start_after_the_first_prefix(spark, tmp_path):
    for folder in (tmp_path / "x.html", tmp_path / str(tmp_path).lstrip("/") / "x.html"):
        folder.parent.mkdir(parents=True, exist_ok=True)
        folder.write_text("x")
    names = [r["name"] for r in read_objects(spark, str(tmp_path)).select("name").collect()]
    assert sorted(names) == sorted(["x.html", f"{str(tmp_path).lstrip('/')}/x.html"])
