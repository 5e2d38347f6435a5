import json

from docgate.operators import evaluation as ops
from docgate.sources.tables import append_metrics, append_signals

SCHEMA = "question string, answer string, expected_terms array<string>"
ANSWER = "Subscription guidance: create a topic subscription, validate the message, and use the right ack path."


def evaluated(spark, *rows):
    return ops.evaluate_answers(spark.createDataFrame(list(rows), SCHEMA))


def test_scores(spark):
    df = evaluated(
        spark,
        ("a", ANSWER, ["Topic", "subscription"]),
        ("b", ANSWER, ["validate", "reject"]),
        ("c", ANSWER, []),
        ("d", ANSWER, ["ack", "ack", "no", ""]),
        ("e", ANSWER, ["ack", "path", "right", "use", "no"]),
    )
    rows = {r["question"]: r for r in df.collect()}
    assert [rows[q]["score"] for q in "abcde"] == [1.0, 0.5, 1.0, 0.75, 0.8]
    assert rows["d"]["matched_terms"] == ["ack", "ack", ""]
    titles = {r["title"]: r["detail"] for r in ops.suggest_improvements(df).collect()}
    assert titles == {
        "Improve answer coverage for: b": "Missing terms: reject",
        "Improve answer coverage for: d": "Missing terms: no",
    }


def test_missing_terms_keep_order_and_repeats(spark):
    df = evaluated(spark, ("q", "a topic", ["topic", "subscription", "ack", "subscription"]))
    assert ops.suggest_improvements(df).first()["detail"] == (
        "Missing terms: subscription, ack, subscription"
    )


def test_metrics_are_appended(spark, tmp_path):
    df = evaluated(spark, ("q", "x", ["x", "y"]))
    path = str(tmp_path / "metrics")
    append_metrics(ops.metric_records(df, "r1"), path)
    append_metrics(ops.metric_records(df, "r2"), path)
    rows = spark.read.parquet(path).collect()
    assert sorted((r["run_id"], r["question"], r["score"]) for r in rows) == [
        ("r1", "q", 0.5),
        ("r2", "q", 0.5),
    ]
    assert all(r["created_at"] is not None for r in rows)


def test_signals_keep_null_scores(spark, tmp_path):
    df = evaluated(spark, ("low", "x", ["y"]), ("fine", "x", ["x"]))
    sources = spark.createDataFrame([("s",), ("s",)], "source string")
    path = str(tmp_path / "signals")
    append_signals(ops.retraining_signals(df, sources), path)
    bodies = [json.loads(bytes(r["data"]).decode()) for r in spark.read.parquet(path).collect()]
    assert sorted((b["reason"], b["source"], b["score"]) for b in bodies if b["score"] is not None) == [
        ("score below threshold", "low", 0.0)
    ]
    (fresh,) = [b for b in bodies if b["score"] is None]
    assert fresh["source"] == "s" and "score" in fresh and fresh["created_at"]


def test_suggestions_take_linear_time_and_keep_null_answers(spark):
    words = [f"word{n}" for n in range(5000)]
    df = evaluated(spark, ("q", " ".join(words[:2500]), words), ("n", None, ["a", None]))
    details = {r["title"][-1]: r["detail"] for r in ops.suggest_improvements(df).collect()}
    missing = [w for w in words if w not in " ".join(words[:2500])]
    assert details == {"q": "Missing terms: " + ", ".join(missing), "n": "Missing terms: a"}


def test_fresh_documents(spark):
    layout = "doc_id bigint, source string, text string"
    before = [(1, "a", "x"), (2, "a", "y"), (3, "b", None), (4, "b", "gone"), (5, "c", "two"), (5, "c", "texts"), (None, "d", "n")]
    after = [(1, "a", "x"), (2, "a", "z"), (3, "b", ""), (5, "c", "two"), (6, "c", "x"), (6, "c", "x"), (None, "d", "n")]
    snapshots = [ops.content_snapshot(spark.createDataFrame(rows, layout)) for rows in (before, after)]
    fresh = ops.fresh_documents(*snapshots)
    assert sorted(map(tuple, fresh.collect())) == [(2, "a", "changed"), (3, "b", "changed"), (6, "c", "new")]
    assert sorted(map(tuple, ops.fresh_sources(fresh).collect())) == [("a", 0, 1), ("b", 0, 1), ("c", 1, 0)]
    assert ops.fresh_documents(snapshots[1], snapshots[1]).isEmpty()
    assert ops.fresh_documents(snapshots[0].limit(0), snapshots[1]).count() == 6
