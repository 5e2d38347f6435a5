"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frames that add up to more than this many bytes are never broadcast.
BROADCAST_LIMIT = 4 * 1024 * 1024
_ROW_BYTES = 64


def row_bytes(text_bytes: Column) -> Column:
    """What a row counts for, by the bytes of its texts."""
    return text_bytes + F.lit(_ROW_BYTES)


def fits_broadcast(df: DataFrame, limit: int, text_bytes: Column) -> bool:
    """Measure what would be broadcast with one distributed aggregate; a single number reaches
    the driver. ``text_bytes`` are the bytes of a row's texts."""
    size = F.sum(row_bytes(text_bytes))
    return (df.agg(size.alias("bytes")).first()["bytes"] or 0) <= limit
