import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docgate.functions.chunking import chunk_array, chunk_count
from docgate.operators import chunks as ops


def expected(text, size, overlap):
    starts = range(0, max(1, len(text) - overlap), size - overlap)
    return [text[i : i + size] for i in starts]


@pytest.mark.parametrize(
    "length, n",
    [(0, 1), (5, 1), (64, 1), (65, 1), (512, 1), (513, 2), (600, 2), (900, 2), (940, 2), (960, 2), (961, 3)],
)
def test_counts(spark, length, n):
    df = spark.createDataFrame([("d", "A" * length)], "doc_id string, text string")
    rows = ops.split_chunks(df).orderBy("chunk_no").collect()
    assert len(rows) == n
    assert [r["chunk_no"] for r in rows] == list(range(n))
    assert df.select(chunk_count(F.col("text"))).first()[0] == n
    if length == 600:
        assert len(rows[0]["chunk_text"]) == 512
        assert rows[0]["chunk_text"][-64:] == rows[1]["chunk_text"][:64]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(st.text(alphabet="ab é😀\ń\r", max_size=90), min_size=20, max_size=20),
    size=st.integers(1, 20),
    data=st.data(),
)
def test_windows_equal_slices(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    text = F.col("text")
    rows = df.select("id", chunk_array(text, size, overlap).alias("c"), chunk_count(text, size, overlap).alias("n"))
    for row in rows.collect():
        want = expected(texts[row["id"]], size, overlap)
        assert row["c"] == want
        assert row["n"] == len(want)


@pytest.mark.parametrize("size, overlap", [(10, 10), (10, 11), (10, -1), (0, 0)])
def test_bad_sizes(size, overlap):
    with pytest.raises(ValueError):
        chunk_array(F.lit("x"), size, overlap)


def messages(spark, *bodies):
    rows = [(f"m{i}", body.encode()) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "message_id string, data binary")


def event(content, more=""):
    return f'{{"event_type":"data_ingest","version":"1.0","payload":{{{content}}}{more}}}'


def test_ingest(spark):
    text = "Messages are routed reliably. " * 30
    df = messages(
        spark,
        event(f'"content":"{text}","source_url":"u"', ',"trace_id":"evt-1"'),
        event('"content":""', ',"trace_id":""'),
        event(""),
        event('"content":null'),
        event('"content":"x","source_url":7'),
        '{"bad":"payload"}',
    )
    rows = {r["message_id"]: r for r in ops.batch_ingest(df).collect()}
    assert [(rows[f"m{i}"]["status"], rows[f"m{i}"]["code"], rows[f"m{i}"]["n_chunks"]) for i in range(6)] == [
        ("ACCEPTED", None, 2),
        ("ACCEPTED", None, 1),
        ("ACCEPTED", None, 1),
        ("REJECTED", "CONTENT_NOT_STRING", 0),
        ("REJECTED", "SOURCE_URL_NOT_STRING", 0),
        ("REJECTED", "CONTRACT_VIOLATION", 0),
    ]
    summary = ops.ingest_summary(df)
    assert sorted(map(tuple, summary.collect())) == [
        ("m0", "ok", 2, "evt-1"),
        ("m1", "ok", 1, ""),
        ("m2", "ok", 1, "data_ingest"),
    ]
    assert ops.ingested_documents(summary.union(summary)).first()["documents"] == 3
    stored = ops.chunks_from_events(df)
    first = stored.where("message_id = 'm0'").orderBy("chunk_no").collect()
    assert [r["chunk_text"] for r in first] == expected(text, 512, 64)
    assert {r["doc_id"] for r in first} == {"evt-1"}
    assert {(r["embedding"], r["source_url"]) for r in first} == {("{}", "u")}
    assert all(r["ingested_at"] is not None for r in first)
    assert stored.where("message_id IN ('m1', 'm2')").count() == 2


def test_chunk_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "doc_id string")
    assert sorted(map(tuple, ops.chunk_counts(df).collect())) == [("a", 2), ("b", 1)]
    assert list(map(tuple, ops.chunk_counts(df, "a").collect())) == [("a", 2)]
