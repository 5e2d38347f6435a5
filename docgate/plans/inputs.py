"""Frames that the registered queries start from, built from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.operators.chunks import split_chunks
from docgate.session import spread


# Columns that the queries use. Naming them saves the job that would infer a schema.
COLUMNS = {
    "documents": "doc_id bigint, text string, source string",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": "event_id bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", *columns), "doc_id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


_MESSAGE_PARTS = (
    "CAST(doc_id AS STRING) AS ident",
    "doc_id % 20 AS kind",
    r"""replace(replace(replace(replace(replace(text, r'\', r'\\'), '"', r'\"'),
        '\n', r'\n'), '\r', r'\r'), '\t', r'\t') AS escaped""",
    r"""CASE WHEN kind = 11
             THEN replace(replace(escaped, '\u00e9', 'e\u0301'), '\u00f1', 'n\u0303')
             ELSE escaped END AS content""",
    """concat('"source_url":"src://', source, '/', ident, '"') AS url""",
    """CASE WHEN kind = 8 THEN '[]'
            WHEN kind = 16 THEN concat('{', url, '}')
            WHEN kind = 17 THEN concat('{"content":', ident, ',', url, '}')
            ELSE concat('{"content":"', content, '",', url, '}') END AS payload""",
    "CASE WHEN kind IN (4, 14) THEN 'unknown_event' ELSE 'data_ingest' END AS event",
    """CASE WHEN kind = 12 THEN '' WHEN kind = 15 THEN concat(',"trace_id":', ident)
            ELSE concat(',"trace_id":"doc-', ident, '"') END AS trace""",
    r"""CASE WHEN kind IN (3, 14) THEN ''
             WHEN kind = 5 THEN ',"version":1'
             WHEN kind = 6 THEN ',"version":"v1"'
             WHEN kind = 18 THEN r',"version":"1.0\n"'
             ELSE ',"version":"1.0"' END AS version""",
    """CASE WHEN kind IN (7, 14) THEN ',"unknown_field":"oops"' ELSE '' END AS extra""",
    """concat('{"event_type":"', event, '","payload":', payload, trace, version, extra, '}')
       AS whole""",
    """CAST(CASE WHEN kind = 0 THEN concat('this is not json ', ident)
                 WHEN kind = 1 THEN 'null'
                 WHEN kind = 2 THEN ''
                 WHEN kind = 10 THEN concat(whole, ' x')
                 WHEN kind = 13 THEN '[1]'
                 ELSE whole END AS BINARY) AS body""",
)


def messages_from(docs: DataFrame) -> DataFrame:
    """Every document as an event message. The id decides which way it is broken, if at all."""
    return docs.selectExpr("doc_id", *_MESSAGE_PARTS).selectExpr(
        "concat('m', ident) AS message_id",
        "CASE WHEN doc_id % 40 = 9 THEN concat(X'FFFE', body) ELSE body END AS data",
        "CASE WHEN doc_id % 40 = 29 THEN 'no-such' ELSE 'utf-8' END AS charset",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from(documents(spark, sf_dir, "text", "source"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "text", "source").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit("src://"), "source", F.lit("/"), "doc_id").alias("source_url"),
        "text",
    )
    return split_chunks(docs)


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as object names; every third one declares its content type."""
    return table(spark, sf_dir, "pages").select(
        F.regexp_replace("url", r"[?#].*$", "").alias("name"),
        F.when(F.col("page_id") % 3 == 0, F.lit("text/html")).alias("content_type"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 4
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("message_id"),
        F.when(kind == 1, "transient").when(kind == 2, "functional").when(kind == 3, "other")
        .alias("error_kind"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"),
        F.col("text").alias("question"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn that the assistant answers in the next turn.

    The two turns meet in one grouping on the conversation and the user's turn number, so a very
    long conversation is spread like many short ones.
    """
    asked, replied = F.col("role") == "user", F.col("role") == "assistant"
    turns = table(spark, sf_dir, "conversations").where(asked | replied)
    pairs = (
        turns.groupBy("conv_id", F.when(asked, F.col("turn")).otherwise(F.col("turn") - 1).alias("at"))
        .agg(
            F.max(F.when(asked, F.col("text"))).alias("question"),
            F.max(F.when(replied, F.col("text"))).alias("answer"),
        )
        .where(F.col("question").isNotNull() & F.col("answer").isNotNull())
    )
    words = F.split("question", " ")
    none = F.array().cast("array<string>")
    return pairs.select(
        "question",
        "answer",
        F.when(F.col("conv_id") % 10 == 0, none).otherwise(words).alias("expected_terms"),
    )
