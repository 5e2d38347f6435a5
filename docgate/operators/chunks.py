"""Documents and accepted messages -> rows of the chunk table. Every step is narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.functions.chunking import CHUNK_OVERLAP, CHUNK_SIZE, chunk_array, chunk_count
from docgate.functions.contract import Contract, error_list
from docgate.functions.sqltext import name, quoted
from docgate.operators.gate import keep, with_gate

# Fixed value: placeholder until embeddings exist.
NO_EMBEDDING = "{}"
NO_CONTENT_STRING = "CONTENT_NOT_STRING"
NO_SOURCE_STRING = "SOURCE_URL_NOT_STRING"


def split_chunks(
    df: DataFrame,
    text: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    where: Column | None = None,
) -> DataFrame:
    """Replace the text column by ``chunk_no`` (from 0) and ``chunk_text``, one row per window.

    Rows for which ``where`` does not hold yield nothing. An empty text yields one empty chunk.
    """
    windows = chunk_array(F.col(text), size, overlap)
    if where is not None:
        windows = F.when(where, windows)
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(windows).alias("chunk_no", "chunk_text"))


_PAYLOAD = (
    "try_element_at(_members, 'payload') AS _payload",
    "try_variant_get(_payload, '$.content', 'variant') AS _content",
    "try_variant_get(_payload, '$.source_url', 'variant') AS _source",
    "try_variant_get(try_element_at(_members, 'trace_id'), '$', 'string') AS trace_id",
    "try_variant_get(try_element_at(_members, 'event_type'), '$', 'string') AS _event",
)


def _not_string(member: str, path: str, code: str) -> str:
    return error_list(
        f"schema_of_variant({member}) <> 'STRING'", path, code, quoted("is not of type 'string'")
    )


def resolve_fields(df: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Gate the messages and resolve the fields of an ingest event.

    Adds ``errors`` (gate errors, or else the ingest rejects for a ``content`` or ``source_url``
    that is no string), ``trace_id``, ``doc_id``, ``content`` and ``source_url``.
    """
    ingest_errors = ", ".join(
        (
            _not_string("_content", "$.payload.content", NO_CONTENT_STRING),
            _not_string("_source", "$.payload.source_url", NO_SOURCE_STRING),
        )
    )
    gated = with_gate(df, contract).withColumnRenamed("errors", "_gate_errors")
    return gated.selectExpr(
        *(name(c) for c in df.columns),
        "_gate_errors",
        *_PAYLOAD,
        f"CASE WHEN size(_gate_errors) > 0 THEN _gate_errors ELSE concat({ingest_errors}) END AS errors",
        "coalesce(trace_id, _event, 'unknown') AS doc_id",
        "coalesce(try_variant_get(_content, '$', 'string'), '') AS content",
        "coalesce(try_variant_get(_source, '$', 'string'), '') AS source_url",
    ).select(*df.columns, "errors", "trace_id", "doc_id", "content", "source_url")


def chunk_records(resolved: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Rows of the chunk table for all accepted messages, with their ``message_id``."""
    split = split_chunks(
        resolved.select("message_id", "doc_id", "source_url", "content", "errors"),
        "content",
        size,
        overlap,
        where=F.size("errors") == 0,
    )
    return split.select(
        "message_id",
        "doc_id",
        "chunk_no",
        "chunk_text",
        "source_url",
        F.current_timestamp().alias("ingested_at"),
        F.lit(NO_EMBEDDING).alias("embedding"),
    )


def chunks_from_events(messages: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Gate, then chunk."""
    return chunk_records(resolve_fields(messages, contract))


def batch_ingest(messages: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Outcome of every message: status, first reject code, number of chunks."""
    resolved = resolve_fields(messages, contract)
    accepted = F.size("errors") == 0
    return resolved.select(
        "message_id",
        F.when(accepted, F.lit("ACCEPTED")).otherwise(F.lit("REJECTED")).alias("status"),
        F.get("errors", F.lit(0))["code"].alias("code"),
        F.when(accepted, chunk_count(F.col("content"))).otherwise(F.lit(0)).alias("n_chunks"),
    )


def ingest_summary(messages: DataFrame, contract: Contract | None = None) -> DataFrame:
    """One row per ingested message; the chunk count follows from the length of the content."""
    return keep(
        resolve_fields(messages, contract),
        F.size("errors") == 0,
        "message_id",
        F.lit("ok").alias("status"),
        chunk_count(F.col("content")).alias("chunk_count"),
        "doc_id",
    )


def ingested_documents(summary: DataFrame) -> DataFrame:
    """Number of ingested messages; one that was delivered again counts once."""
    return summary.agg(F.count_distinct("message_id").alias("documents"))


def chunk_counts(chunks: DataFrame, doc_id: str | None = None) -> DataFrame:
    """Chunks per document, or for one document."""
    if doc_id is not None:
        chunks = chunks.where(F.col("doc_id") == doc_id)
    return chunks.groupBy("doc_id").agg(F.count("*").alias("chunk_count"))
