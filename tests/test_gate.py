import io
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from docgate.functions.contract import Contract
from docgate.operators import chunks as chunk_ops
from docgate.operators import gate, routing, search

GOOD = '{"event_type":"llm_request","payload":{"prompt":"Hello world"},"version":"1.0"}'
CASES = {
    "conformant": (GOOD.encode(), "utf-8", []),
    "escaped NFD": (
        rb'{"event_type":"data_ingest","payload":{"text":"nin\u0303o"},"version":"1.0"}',
        "utf-8",
        [],
    ),
    "raw NFD": (
        '{"event_type":"data_ingest","payload":{"text":"nin\N{COMBINING TILDE}o"},"version":"1.0"}'.encode(),
        "utf-8",
        [],
    ),
    "bad enum": (
        b'{"event_type":"unknown_event","payload":{},"version":"1.0"}',
        "utf-8",
        [("$.event_type", "CONTRACT_VIOLATION")],
    ),
    "missing version": (
        b'{"event_type":"llm_response","payload":{}}',
        "utf-8",
        [("$", "CONTRACT_VIOLATION")],
    ),
    "not json": (b"this is not json at all", "utf-8", [("$", "SYNTAX_NOT_JSON")]),
    "empty": (b"", "utf-8", [("$", "SYNTAX_NOT_JSON")]),
    "null literal": (b" null\n", "utf-8", [("$", "SYNTAX_EMPTY")]),
    "bad charset": (b"\xff\xfe invalid utf-8 sequence", "utf-8", [("$", "ENCODING_UNDECODABLE")]),
    "unknown charset": (GOOD.encode(), "no-such", [("$", "ENCODING_UNDECODABLE")]),
    "no bytes": (None, "utf-8", [("$", "ENCODING_UNDECODABLE")]),
    "utf-16": (GOOD.encode("utf-16"), "utf-16", []),
    "byte order mark": (b"\xef\xbb\xbf" + GOOD.encode(), "utf-8", [("$", "SYNTAX_NOT_JSON")]),
    "extra field": (
        b'{"event_type":"eval_result","payload":{},"version":"2.1","unknown_field":"oops"}',
        "utf-8",
        [("$", "CONTRACT_VIOLATION")],
    ),
    "numeric version": (
        b'{"event_type":"eval_result","payload":{},"version":1}',
        "utf-8",
        [("$.version", "CONTRACT_VIOLATION")],
    ),
    "trailing text": ((GOOD + " x").encode(), "utf-8", [("$", "SYNTAX_NOT_JSON")]),
    "two values": ((GOOD + "," + GOOD).encode(), "utf-8", [("$", "SYNTAX_NOT_JSON")]),
    "array root": (b"[1]", "utf-8", [("$", "CONTRACT_VIOLATION")]),
    "null members": (
        b'{"event_type":null,"payload":null,"version":null,"trace_id":null,"timestamp":null}',
        "utf-8",
        [
            ("$.event_type", "CONTRACT_VIOLATION"),
            ("$.event_type", "CONTRACT_VIOLATION"),
            ("$.payload", "CONTRACT_VIOLATION"),
            ("$.timestamp", "CONTRACT_VIOLATION"),
            ("$.trace_id", "CONTRACT_VIOLATION"),
            ("$.version", "CONTRACT_VIOLATION"),
        ],
    ),
    "duplicate keys": (
        b'{"event_type":"x","event_type":"data_ingest","payload":{},"version":"1.0"}',
        "utf-8",
        [],
    ),
    "other digits": (
        '{"event_type":"data_ingest","payload":{},"version":"١.٢"}'.encode(),
        "utf-8",
        [],
    ),
    "newline version": (
        rb'{"event_type":"data_ingest","payload":{},"version":"1.0\n"}',
        "utf-8",
        [],
    ),
    "crlf version": (
        rb'{"event_type":"data_ingest","payload":{},"version":"1.0\r\n"}',
        "utf-8",
        [("$.version", "CONTRACT_VIOLATION")],
    ),
    "free timestamp": (
        b'{"event_type":"data_ingest","payload":{},"version":"1.0","timestamp":"soon"}',
        "utf-8",
        [],
    ),
}


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(k, d, c) for k, (d, c, _) in CASES.items()]
    return spark.createDataFrame(rows, "message_id string, data binary, charset string")


@pytest.fixture(scope="module")
def validated(messages):
    return {r["message_id"]: r for r in gate.validate(messages).collect()}


@pytest.mark.parametrize("label", CASES)
def test_case(validated, label):
    data, charset, errors = CASES[label]
    row = validated[label]
    assert [(e["path"], e["code"]) for e in row["errors"]] == errors
    assert all(e["message"] for e in row["errors"])
    assert row["status"] == ("REJECTED" if errors else "ACCEPTED")
    if errors:
        assert row["canonical"] is None
    else:
        assert row["canonical"] == unicodedata.normalize("NFC", data.decode(charset))


def test_errors_never_repeat_payload_values(validated):
    assert "unknown_event" not in str(validated["bad enum"]["errors"])


def test_rendering(messages):
    rows = gate.validate(messages).select(
        "message_id", gate.rendered().alias("line"), gate.reasons().alias("reasons")
    )
    lines = {r["message_id"]: r for r in rows.collect()}
    assert lines["conformant"]["line"] == "ACCEPTED (enqueued)"
    assert lines["conformant"]["reasons"] == []
    assert lines["null literal"]["line"] == (
        "REJECTED — SYNTAX_EMPTY[$]: payload contained no JSON value"
    )
    assert lines["null members"]["line"].count("; ") == 5


def test_tally(messages):
    rows = {(r["status"], r["code"]): r["n"] for r in gate.tally(gate.validate(messages)).collect()}
    assert sum(rows.values()) == len(CASES)
    assert rows["ACCEPTED", None] == sum(not errors for _, _, errors in CASES.values())


def test_syntax_matches_python_on_random_mutations(spark):
    rng = random.Random(7)
    seeds = [GOOD, "[1, 2.5e3, true, null]", '{"a": {"b": ["x\\u00e9", "\\n"]}}', '"text"', "-0.1", "{}"]
    texts = []
    for _ in range(1500):
        text = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text) + 1)
            action = rng.random()
            if action < 0.4 and text:
                del text[min(at, len(text) - 1)]
            elif action < 0.8:
                text.insert(at, rng.choice('{}[],:"0123456789.eE+-\\ntf\'/ \t\x01é'))
            else:
                text = text[:at]
        texts.append("".join(text))

    def strict(text):
        def refuse(value):
            raise ValueError(value)

        try:
            json.loads(text, parse_constant=refuse)
        except ValueError:
            return False
        return True

    rows = [(str(i), t.encode()) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "message_id string, data binary")
    got = {r["message_id"]: r["_code"] for r in gate.with_syntax(df).select("message_id", "_code").collect()}
    wrong = [t for i, t in enumerate(texts) if (got[str(i)] != "SYNTAX_NOT_JSON") != strict(t)]
    assert wrong == []


def test_hostile_sizes_are_rejected_not_thrown(spark):
    rows = [("deep", b"[" * 100_000), ("digits", b"1" * 5_000), ("big", b'"' + b"a" * 3_000_000 + b'"')]
    df = spark.createDataFrame(rows, "message_id string, data binary")
    codes = {r["message_id"]: r["errors"][0]["code"] for r in gate.validate(df).collect()}
    assert codes["deep"] == "SYNTAX_NOT_JSON"
    assert codes["big"] == "CONTRACT_VIOLATION"


def test_every_message_is_parsed_and_normalised_once(messages, plan):
    resolved = chunk_ops.resolve_fields(messages)
    for df in (
        gate.validate(messages),
        chunk_ops.batch_ingest(messages),
        chunk_ops.ingest_summary(messages),
        chunk_ops.chunk_records(resolved),
        routing.quarantine(resolved),
        search.find_by_trace(messages, "t"),
    ):
        text = plan(df)
        assert text.count("parseJson") == 1
        assert text.count("ArrowEvalPython") == 1
        assert "Exchange" not in text


def test_a_trace_is_found_in_rejected_messages_too(spark):
    rows = [("bad", b'{"trace_id":"t","bad":1}'), ("other", b'{"trace_id":"u"}'), ("list", b'["t"]'), ("text", b"t"), ("none", b"null")]
    df = spark.createDataFrame(rows, "message_id string, data binary")
    assert search.find_by_trace(df, "t").collect() == [("bad", "t")]


def test_contract_can_come_from_a_stream(spark):
    contract = Contract.from_stream(
        io.StringIO('{"type":"object","required":["it\'s"],"properties":{"it\'s":{"type":"boolean"}}}')
    )
    rows = [("a", b'{"it\'s":true,"more":1}'), ("b", b'{"it\'s":"true"}'), ("c", b"{}")]
    df = spark.createDataFrame(rows, "message_id string, data binary")
    got = {r["message_id"]: [e["path"] for e in r["errors"]] for r in gate.validate(df, contract).collect()}
    assert got == {"a": [], "b": ["$.it's"], "c": ["$"]}


@pytest.mark.parametrize(
    "text",
    [
        '{"type":"array"}',
        '{"type":"object","minProperties":1}',
        '{"type":"object","properties":{"a":{"oneOf":[]}}}',
        '{"type":"object","properties":{"a":{"type":"date"}}}',
        '{"type":"object","properties":{"a":{"pattern":"\\\\w"}}}',
        '{"type":"object","properties":{"a":{"enum":[[1]]}}}',
        '{"type":"object","properties":{"a":{"items":{"uniqueItems":true}}}}',
        '{"type":"object","additionalProperties":{"type":"string"}}',
        '{"type":"object","properties":{"a":{"maximum":Infinity}}}',
    ],
)
def test_unsupported_contracts_fail_when_compiled(text):
    with pytest.raises(ValueError):
        Contract.from_stream(io.StringIO(text))


# Rule of member "a" -> values that keep it, and (value, path of the error) for those that do not.
KEYWORDS = {
    '{"type":"integer"}': (["1", "-2.0", "1e3", "123456789012345678901"], [("1.5", ""), ("true", ""), ('"1"', "")]),
    '{"type":"number"}': (["1", "1.5", "1e300"], [("true", ""), ("null", ""), ('"1"', "")]),
    '{"type":["string","null"]}': (['"x"', "null"], [("1", ""), ("{}", "")]),
    '{"minLength":2,"maxLength":3}': (['"ab"', '"\U0001F600\U0001F600\U0001F600"', "1"], [('"a"', ""), ('"abcd"', "")]),
    '{"minimum":0,"maximum":1.5}': (["0", "1.5", '"x"', "true"], [("-1", ""), ("1.51", "")]),
    '{"exclusiveMinimum":0,"exclusiveMaximum":2}': (["1"], [("0", ""), ("2.0", "")]),
    '{"enum":[1,true,null,"x"]}': (["1", "1.0", "true", "null", '"x"'], [("false", ""), ('"1"', ""), ("[]", ""), ("{}", "")]),
    '{"const":false}': (["false"], [("0", ""), ("true", "")]),
    '{"required":["b"],"additionalProperties":false,"properties":{"b":{"properties":{"c":{"type":"string"}}}}}': (
        ['{"b":{"c":"x","d":1}}', '{"b":1}', "7"],
        [("{}", ""), ('{"b":1,"z":1}', ""), ('{"b":{"c":1}}', ".b.c")],
    ),
    '{"items":{"type":"object","required":["k"],"properties":{"k":{"items":{"maximum":5}}}},"minItems":1,"maxItems":2}': (
        ['[{"k":[1,5]},{"k":"x"}]', '"x"', '[{"k":[]}]'],
        [("[]", ""), ('[{"k":1},{"k":1},{"k":1}]', ""), ('[{"k":[]},3]', ".1"), ('[{"k":[]},{}]', ".1"), ('[{"k":[1,2,6]}]', ".0.k.2")],
    ),
}


def test_contract_keywords(spark):
    for rule, (good, bad) in KEYWORDS.items():
        contract = Contract.from_stream(io.StringIO('{"type":"object","properties":{"a":%s}}' % rule))
        cases = [(v, []) for v in good] + [(v, [("$.a" + p, "CONTRACT_VIOLATION")]) for v, p in bad]
        rows = [(n, ('{"a":%s}' % v).encode()) for n, (v, _) in enumerate(cases)]
        rows.append((len(rows), b"{}"))  # a member that is not there breaks no rule
        df = spark.createDataFrame(rows, "message_id int, data binary")
        got = {r["message_id"]: [(e["path"], e["code"]) for e in r["errors"]] for r in gate.validate(df, contract).collect()}
        assert [got[n] for n in range(len(rows))] == [expected for _, expected in cases] + [[]], rule


def test_errors_of_a_nested_contract_come_by_path(spark):
    text = """{"type":"object","required":["z"],"properties":{"b":{"type":"string"},
        "a":{"type":"object","required":["y"],"properties":{"q":{"minimum":1},"l":{"items":{"type":"integer"}}}}}}"""
    df = spark.createDataFrame([(b'{"b":1,"a":{"q":0,"l":[1,"x",2.5]}}',)], "data binary")
    (row,) = gate.validate(df, Contract.from_stream(io.StringIO(text))).collect()
    assert [e["path"] for e in row["errors"]] == ["$", "$.a", "$.a.l.1", "$.a.l.2", "$.a.q", "$.b"]


def test_contract_is_compiled_once_per_content():
    assert Contract.from_path() is Contract.from_path()


def test_keep_is_a_filter_with_projection(spark):
    df = spark.range(5)
    kept = gate.keep(df, F.col("id") > 2, "id", (F.col("id") * 2).alias("twice"))
    assert sorted(map(tuple, kept.collect())) == [(3, 6), (4, 8)]
