"""Stored documents -> ingest event messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.functions.html import html_text
from docgate.functions.mime import mime_type

# Fixed values of the envelope.
INGEST_EVENT = "data_ingest"
ENVELOPE_VERSION = "1.0"


def with_mime(objects: DataFrame) -> DataFrame:
    """Add ``mime`` to rows of ``name, content_type``."""
    return objects.withColumn("mime", mime_type(F.col("name"), F.col("content_type")))


def extract_text(objects: DataFrame, content: str = "content") -> DataFrame:
    """Add ``text``: the plain text of ``text/html`` rows, NULL for every other type.

    Expects ``mime``; the content may be text or UTF-8 bytes.
    """
    html = html_text(F.col(content).cast("string"))
    return objects.withColumn("text", F.when(F.col("mime") == "text/html", html))


def document_events(
    extracted: DataFrame, timestamp: Column | None = None, source_url: str = "source_url"
) -> DataFrame:
    """Rows of ``name, text, source_url`` -> messages whose JSON is an ingest event.

    Rows without text yield none.
    """
    when = F.current_timestamp() if timestamp is None else timestamp
    envelope = F.struct(
        F.col("name").alias("trace_id"),
        F.lit(INGEST_EVENT).alias("event_type"),
        F.lit(ENVELOPE_VERSION).alias("version"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        F.struct(F.col("text").alias("content"), F.col(source_url).alias("source_url")).alias(
            "payload"
        ),
    )
    present = F.when(F.col("text").isNotNull(), F.array(envelope))
    return extracted.select("name", F.explode(present).alias("_event")).select(
        F.col("name").alias("message_id"),
        F.to_json("_event").cast("binary").alias("data"),
        F.lit("utf-8").alias("charset"),
    )
