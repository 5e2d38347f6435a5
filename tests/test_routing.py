from docgate.operators import chunks, routing


def test_outcomes(spark):
    rows = [("a", None), ("b", "transient"), ("c", "functional"), ("d", "other")]
    df = spark.createDataFrame(rows, "message_id string, error_kind string")
    assert sorted(map(tuple, routing.classify_outcomes(df).collect())) == [
        ("a", "ACCEPTED", "ack", False),
        ("b", "TRANSIENT", "nack", False),
        ("c", "FUNCTIONAL_REJECT", "ack", True),
        ("d", "UNKNOWN", "nack", False),
    ]


def test_quarantine_keeps_payload_and_reason(spark):
    good = b'{"event_type":"data_ingest","version":"1.0","payload":{}}'
    df = spark.createDataFrame([("a", b"x"), ("b", good)], "message_id string, data binary")
    (row,) = routing.quarantine(chunks.resolve_fields(df)).collect()
    assert row["message_id"] == "a"
    assert bytes(row["data"]) == b"x"
    assert row["reason"] == "REJECTED — SYNTAX_NOT_JSON[$]: payload is not a single JSON value"
