import unicodedata

from docgate.functions.charset import NFC_STABLE_RANGES
from docgate.operators.gate import with_decoded


def _second_in_a_composition():
    """Characters that can merge with the one before them."""
    found = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(int(parts[1], 16))
    return found


def test_stable_ranges_never_change_under_nfc():
    merging = _second_in_a_composition()
    for first, last in NFC_STABLE_RANGES:
        for code in range(first, last + 1):
            char = chr(code)
            assert unicodedata.is_normalized("NFC", char), hex(code)
            assert unicodedata.combining(char) == 0, hex(code)
            assert code not in merging, hex(code)


def test_decoding_matches_python(spark):
    composed = ["plain", "\u00e9\u00f1", "\u65e5\u672c\u8a9e\u304c", "\ud55c", "\U0001f600 ok", ""]
    texts = composed + [unicodedata.normalize("NFD", t) for t in composed] + ["\u212b\u2126"]
    rows = [(t.encode(c), c) for t in texts for c in ("utf-8", "UTF_8", "utf-16", "utf8")]
    rows += [(bytes(range(32, 256)), c) for c in ("latin-1", "ISO-8859-1", "cp437", "cp1252", "ascii")]
    rows += [
        (b"\xff\xfe bad", "utf-8"),
        (b"\xed\xa0\x80", "utf-8"),
        (b"abc", "no-such"),
        (b"abc", "u-t-f-8"),
        (b"abc", "hex"),
        (b"abc", ""),
        (b"abc", None),
        (None, "utf-8"),
    ]
    df = spark.createDataFrame(
        [(i, d, c) for i, (d, c) in enumerate(rows)], "id int, data binary, charset string"
    )
    got = {r["id"]: r["_text"] for r in with_decoded(df).collect()}
    for i, (data, charset) in enumerate(rows):
        try:
            want = unicodedata.normalize("NFC", data.decode("utf-8" if charset is None else charset))
        except (AttributeError, LookupError, ValueError):
            want = None
        assert got[i] == want, rows[i]


def test_charset_column_may_be_missing(spark):
    df = spark.createDataFrame([("é".encode(),)], "data binary")
    assert with_decoded(df).first()["_text"] == "é"
