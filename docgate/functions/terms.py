"""Word terms of a text: lower-cased runs of letters and digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """All words in order, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def terms(text: Column) -> Column:
    """Distinct words."""
    return F.array_distinct(tokens(text))
