"""Bytes in a declared charset -> NFC text, or NULL where the bytes do not decode.

UTF-8 and Latin-1 are decoded by Spark itself. Python sees only the rows that need it: those in
another charset, and UTF-8 text with a character outside the ranges below.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgate.functions.sqltext import name, quoted

DEFAULT_CHARSET = "utf-8"

# Code point ranges whose characters all stand alone under NFC (they are their own
# normal form, have combining class 0 and never merge with the character before them). Text made
# of these only is in NFC already. tests/test_charset.py checks them one by one.
NFC_STABLE_RANGES = (
    (0x0000, 0x02FF),  # ASCII, Latin, phonetic and spacing modifier letters
    (0x0388, 0x03FF),  # Greek
    (0x0400, 0x0482),  # Cyrillic
    (0x048A, 0x052F),
    (0x05D0, 0x05EA),  # Hebrew letters
    (0x0621, 0x064A),  # Arabic letters
    (0x0E01, 0x0E37),  # Thai, without its marks that have an order
    (0x0E3F, 0x0E47),
    (0x0E4C, 0x0E5B),
    (0x1E00, 0x1EFF),  # Vietnamese and other Latin letters with marks
    (0x2010, 0x2027),  # dashes, quotes, bullets, ellipsis
    (0x2030, 0x205E),
    (0x20A0, 0x20C0),  # currency
    (0x2190, 0x2328),  # arrows, mathematics, technical signs
    (0x232B, 0x27BF),
    (0x3001, 0x3029),  # CJK punctuation
    (0x3041, 0x3096),  # Hiragana
    (0x30A0, 0x30FF),  # Katakana
    (0x3400, 0x4DBF),  # CJK ideographs
    (0x4E00, 0x9FFF),
    (0xAC00, 0xD7A3),  # Hangul syllables
    (0xFF01, 0xFFEE),  # full width forms
    (0x1F300, 0x1FAFF),  # emoji
)
# One range is matched several times faster than many, and settles all Latin text.
_BEYOND_LATIN = "[^\\x{0}-\\x{2FF}]"
_MAY_CHANGE = "[^" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in NFC_STABLE_RANGES) + "]"

_UTF8_NAME = r"(?i)^utf[-_ ]?8$"
_LATIN1_NAME = r"(?i)^(iso[-_ ]?8859[-_ ]1|latin[-_ ]?1)$"


def _nfc_udf():
    """Arrow UDF (data, charset) -> NFC text or NULL; NULL in, NULL out.

    The functions are nested so that they travel by value: executors need no copy of this package.
    """

    def one(data: bytes | None, charset: str) -> str | None:
        if data is None:
            return None
        try:
            text = unicodedata.normalize("NFC", data.decode(charset))
            text.encode("utf-8")  # a lone surrogate has no UTF-8 form
        except (LookupError, ValueError):
            return None
        return text

    def rows(data: pa.Array, charset: pa.Array) -> pa.Array:
        pairs = zip(data.to_pylist(), charset.to_pylist())
        return pa.array([one(d, c) for d, c in pairs], type=pa.string())

    # Declared nondeterministic only to stop the optimizer from copying the call into filters
    # further up, which would run it twice per row.
    return F.arrow_udf(rows, T.StringType()).asNondeterministic()


def with_text(df: DataFrame, data: str = "data", charset: str = "charset") -> DataFrame:
    """Add ``_charset`` (as declared, or the default) and ``_text``: the decoded, NFC-normalised
    payload, NULL if it cannot be decoded."""
    raw = name(data)
    declared = name(charset) if charset in df.columns else "NULL"
    is_utf8 = f"_charset RLIKE {quoted(_UTF8_NAME)}"
    is_latin1 = f"_charset RLIKE {quoted(_LATIN1_NAME)}"
    # Counting characters is much cheaper than a regular expression and settles pure ASCII.
    unsettled = f"{is_utf8} AND octet_length(_plain) <> length(_plain)"
    staged = df.selectExpr(
        "*",
        f"coalesce({declared}, {quoted(DEFAULT_CHARSET)}) AS _charset",
        f"""CASE WHEN {is_utf8} THEN try_validate_utf8(CAST({raw} AS STRING))
                 WHEN {is_latin1} THEN decode({raw}, 'ISO-8859-1') END AS _plain""",
        f"""CASE WHEN {raw} IS NOT NULL
                  AND CASE WHEN {unsettled}
                           THEN _plain RLIKE {quoted(_BEYOND_LATIN)}
                                AND _plain RLIKE {quoted(_MAY_CHANGE)}
                           ELSE NOT ({is_utf8} OR {is_latin1}) END
                 THEN named_struct('data', {raw}, 'charset', _charset) END AS _to_python""",
    )
    from_python = _nfc_udf()(F.col("_to_python.data"), F.col("_to_python.charset"))
    text = F.when(F.isnull("_to_python"), F.col("_plain")).otherwise(from_python)
    return staged.select(*df.columns, "_charset", text.alias("_text"))
