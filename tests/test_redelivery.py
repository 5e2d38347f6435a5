import pytest
from pyspark.sql import functions as F

from docgate.sources.messages import publish_files, stream_messages
from docgate.streaming.redelivery import Redelivery

LAYOUT = "message_id string, data binary, charset string"


def messages(spark, *ids):
    return spark.createDataFrame([(i, b"payload", None) for i in ids], LAYOUT).coalesce(1)


def handler(messages):
    """Ids say what happens: t2 fails twice for a passing reason, f is broken, x never works."""
    fails = F.try_to_number(F.regexp_extract("message_id", r"^[tu](\d)", 1), F.lit("9")).cast("int")
    kind = (
        F.when(F.col("message_id").startswith("f"), "functional")
        .when(F.col("message_id").startswith("x"), "other")
        .when(F.col("attempt") <= F.coalesce(fails, F.lit(0)), "transient")
    )
    return messages.withColumn("error_kind", kind)


def ends(results):
    rows = results.where("fate <> 'retry'").select("message_id", "fate", "attempt", "step").collect()
    assert len({r["message_id"] for r in rows}) == len(rows)
    return {r["message_id"]: (r["fate"], r["attempt"], r["step"]) for r in rows}


def test_each_message_meets_its_own_fate(spark, tmp_path):
    again = Redelivery(handler, f"{tmp_path}/r", max_attempts=4)
    for n, ids in enumerate((("a", "t1", "t3", "f", "x"), ("b", "t2"), ("c",))):
        again.process_batch(messages(spark, *ids), n)
    # Attempts of t1: steps 0 and 1; of t3 and x: 0, 1, 3, 7; of t2: 1, 2, 4.
    assert ends(again.results(spark)) == {
        "a": ("accepted", 1, 0), "b": ("accepted", 1, 1), "c": ("accepted", 1, 2),
        "f": ("quarantine", 1, 0), "t1": ("accepted", 2, 1),
    }
    assert again.drain(spark) == 5
    want = {"t2": ("accepted", 3, 4), "t3": ("accepted", 4, 7), "x": ("dead", 4, 7)}
    assert want.items() <= ends(again.results(spark)).items() and len(ends(again.results(spark))) == 8
    assert again.drain(spark) == 0
    # The batch after a drain counts on from it.
    again.process_batch(messages(spark, "d", "t1b"), 3)
    again.process_batch(messages(spark, "e"), 4)
    found = ends(again.results(spark))
    assert found["d"] == ("accepted", 1, 8) and found["t1b"] == ("accepted", 2, 9)
    kept = {r["message_id"]: r["data"] for r in again.results(spark).where("fate <> 'retry'").collect()}
    assert kept["x"] == kept["f"] == b"payload" and kept["a"] is None


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    again = Redelivery(handler, f"{tmp_path}/r", max_attempts=3)
    for n, ids in enumerate((("t1", "t2", "x"), ("a",), ("a2", "f"), ("b",))):
        for _ in range(2):
            again.process_batch(messages(spark, *ids), n)
    assert again.drain(spark) == 0
    assert {k: v[:2] for k, v in ends(again.results(spark)).items()} == {
        "t1": ("accepted", 2), "t2": ("accepted", 3), "x": ("dead", 3), "a": ("accepted", 1),
        "a2": ("accepted", 1), "f": ("quarantine", 1), "b": ("accepted", 1),
    }


def test_in_a_stream_batches_are_not_replayed(spark, tmp_path):
    for n in range(3):
        publish_files(messages(spark, f"a{n}", f"t1-{n}", f"f{n}", f"x{n}"), f"{tmp_path}/inbox")
    again = Redelivery(handler, f"{tmp_path}/r", max_attempts=2)
    stream = stream_messages(spark, f"{tmp_path}/inbox", files_per_batch=1)
    results = again.run(stream, f"{tmp_path}/checkpoint")
    commits = list((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))
    assert len(commits) == 3
    fates = {k: v[:2] for k, v in ends(results).items()}
    want = {"a": ("accepted", 1), "t1-": ("accepted", 2), "f": ("quarantine", 1), "x": ("dead", 2)}
    assert fates == {f"{k}{n}": v for k, v in want.items() for n in range(3)}
    # More arrives: the same query goes on.
    publish_files(messages(spark, "t1-3"), f"{tmp_path}/inbox")
    assert ends(again.run(stream, f"{tmp_path}/checkpoint"))["t1-3"][:2] == ("accepted", 2)


def test_empty_and_wrong_settings(spark, tmp_path):
    again = Redelivery(handler, f"{tmp_path}/r")
    assert again.results(spark) is None and again.drain(spark) == 0
    again.process_batch(spark.createDataFrame([], LAYOUT), 0)
    for bad in ({"max_attempts": 0}, {"delay": 0}):
        with pytest.raises(ValueError):
            Redelivery(handler, "p", **bad)
