"""Overlapping text windows as one linear pass over the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default window and overlap, in characters.
CHUNK_SIZE = 512
CHUNK_OVERLAP = 64


def _check(size: int, overlap: int) -> None:
    if not 0 <= overlap < size:
        raise ValueError(f"need 0 <= overlap < size, got size={size} overlap={overlap}")


def chunk_array(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of windows of ``size`` characters, each starting ``size - overlap`` after the last.

    Slicing with ``substring`` walks from the start of the text for every window, which is
    quadratic. The pattern looks ahead for a window, then moves on by one step, so each character
    is visited a constant number of times. A window needs more than ``overlap`` characters,
    else it would only repeat the tail of the one before; short texts are one window of their own.
    """
    _check(size, overlap)
    window = f"(?s)(?=(.{{{overlap + 1},{size}}})).{{1,{size - overlap}}}"
    return F.when(F.length(text) <= overlap, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(window), F.lit(1))
    )


def chunk_count(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Number of windows, from the length alone."""
    _check(size, overlap)
    step = size - overlap
    return F.greatest(
        F.lit(1), F.ceil((F.length(text) - F.lit(overlap)) / F.lit(step))
    ).cast("long")
