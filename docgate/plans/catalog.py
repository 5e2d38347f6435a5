"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.functions.html import html_text
from docgate.operators import chunks as chunk_ops
from docgate.operators import documents as document_ops
from docgate.operators import evaluation, gate, prompts, routing, search
from docgate.plans import inputs
from docgate.session import configure, shared_dir
from docgate.sources.messages import publish_files, read_messages, stream_messages
from docgate.sources.tables import read_postings, save_postings
from docgate.streaming.ingest import StreamingIngest, folder_sink
from docgate.streaming.pull import BoundedPull
from docgate.streaming.redelivery import Redelivery

QUERY = "the and of"
TRACE = "doc-23"  # of a message without a version, which the contract rejects
RUN = "run-1"


def mime_type(spark, sf_dir):
    return document_ops.with_mime(inputs.objects(spark, sf_dir)).select("name", "mime")


def extract_html_text(spark, sf_dir):
    text = html_text(F.col("html"))
    return inputs.pages(spark, sf_dir).select("page_id", text.alias("text")).select(
        "page_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("text_len")
    )


def _page_events(spark, sf_dir):
    rows = inputs.pages(spark, sf_dir).select(
        F.col("url").alias("name"), F.col("url").alias("source_url"), F.col("html").alias("content"),
        F.lit("text/html").alias("mime"),
    )
    return document_ops.document_events(
        document_ops.extract_text(rows), F.lit("2024-01-01 00:00:00").cast("timestamp")
    )


def document_events(spark, sf_dir):
    body = _page_events(spark, sf_dir).select(
        F.from_json(
            F.col("data").cast("string"),
            "trace_id string, event_type string, version string, timestamp string, "
            "payload struct<content: string, source_url: string>",
        ).alias("e"),
        "charset",
    )
    return body.select(
        F.col("e.trace_id").alias("trace_id"),
        F.col("e.payload.source_url").alias("source_url"),
        F.md5("e.payload.content").alias("content_md5"),
        F.col("e.event_type").alias("event_type"),
        F.col("e.version").alias("version"),
        F.col("e.timestamp").alias("timestamp"),
        "charset",
    )


def published_documents(spark, sf_dir):
    """The pages as events, published as message files, read back, gated and counted."""
    configure(spark)
    inbox = f"{shared_dir(spark)}/inbox-{uuid.uuid4().hex}"
    publish_files(_page_events(spark, sf_dir), inbox)
    return chunk_ops.ingested_documents(chunk_ops.ingest_summary(read_messages(spark, inbox)))


def chunks(spark, sf_dir):
    return inputs.chunks(spark, sf_dir).select("doc_id", "chunk_no", "chunk_text")


def chunks_from_events(spark, sf_dir):
    return chunk_ops.chunks_from_events(inputs.messages(spark, sf_dir)).drop("ingested_at")


def batch_ingest(spark, sf_dir):
    return chunk_ops.batch_ingest(inputs.messages(spark, sf_dir))


def ingest_summary(spark, sf_dir):
    return chunk_ops.ingest_summary(inputs.messages(spark, sf_dir))


def gate_encoding(spark, sf_dir):
    decoded = gate.with_decoded(inputs.messages(spark, sf_dir))
    return decoded.select("message_id", F.col("_text").isNotNull().alias("decodable"))


def nfc_canonical(spark, sf_dir):
    decoded = gate.with_decoded(inputs.messages(spark, sf_dir))
    return decoded.where(F.col("_text").isNotNull()).select(
        "message_id", F.md5("_text").alias("canonical_md5")
    )


def gate_syntax(spark, sf_dir):
    checked = gate.with_syntax(inputs.messages(spark, sf_dir))
    return gate.keep(
        checked, F.col("_text").isNotNull(), "message_id", F.col("_code").alias("code")
    )


def gate_contract_errors(spark, sf_dir):
    checked = gate.with_gate(inputs.messages(spark, sf_dir))
    past_syntax = F.when(F.col("_code").isNull(), F.col("errors"))
    return checked.select("message_id", F.posexplode(past_syntax).alias("pos", "e")).select(
        "message_id", "pos", "e.path", "e.code", "e.message"
    )


def gate_validate(spark, sf_dir):
    first = F.get("errors", F.lit(0))
    return gate.validate(inputs.messages(spark, sf_dir)).select(
        "message_id",
        "status",
        F.md5("canonical").alias("canonical_md5"),
        F.size("errors").alias("n_errors"),
        first["code"].alias("first_code"),
        first["path"].alias("first_path"),
    )


def gate_reasons(spark, sf_dir):
    validated = gate.validate(inputs.messages(spark, sf_dir))
    return validated.select("message_id", gate.rendered().alias("rendered"))


def gate_tally(spark, sf_dir):
    return gate.tally(gate.validate(inputs.messages(spark, sf_dir)))


def classify_outcomes(spark, sf_dir):
    return routing.classify_outcomes(inputs.outcomes(spark, sf_dir))


def quarantine(spark, sf_dir):
    checked = chunk_ops.resolve_fields(inputs.messages(spark, sf_dir))
    return routing.quarantine(checked.drop("data"))


def find_by_trace(spark, sf_dir):
    return search.find_by_trace(inputs.messages(spark, sf_dir), TRACE)


def stream_ingest(spark, sf_dir):
    """The documents as a file stream, through gate and chunking, read back from the sink."""
    configure(spark)
    work = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    # A table is one file or a folder of them; a stream takes a single file only by a pattern.
    docs = spark.readStream.schema("doc_id bigint, text string, source string").parquet(
        f"{sf_dir}/documents.{{parquet}}"
    )
    ingest = StreamingIngest(folder_sink(f"{work}/chunks"), folder_sink(f"{work}/quarantine"))
    ingest.start(inputs.messages_from(docs), f"{work}/checkpoint").awaitTermination()
    stored = spark.read.parquet(f"{work}/chunks")
    return stored.select("message_id", "doc_id", "chunk_no", "chunk_text")


def chunk_counts(spark, sf_dir):
    return chunk_ops.chunk_counts(inputs.chunks(spark, sf_dir))


def search_all_terms(spark, sf_dir):
    return search.search_all_terms(inputs.chunks(spark, sf_dir), QUERY)


def search_any_word(spark, sf_dir):
    return search.search_any_word(inputs.chunks(spark, sf_dir), QUERY)


def search_batch(spark, sf_dir):
    return search.search_batch(inputs.chunks(spark, sf_dir), inputs.questions(spark, sf_dir))


def search_ranked(spark, sf_dir):
    return search.search_ranked(inputs.chunks(spark, sf_dir), inputs.questions(spark, sf_dir))


def search_any_word_batch(spark, sf_dir):
    return search.search_any_word_batch(inputs.chunks(spark, sf_dir), inputs.questions(spark, sf_dir))


def search_stored(spark, sf_dir):
    """The postings of all chunks, stored, and every question answered from them."""
    configure(spark)
    name = f"postings_{uuid.uuid4().hex}"
    save_postings(inputs.chunks(spark, sf_dir), name, spark.sparkContext.defaultParallelism, shared_dir(spark))
    counted, stats = read_postings(spark, name)
    return search.search_ranked(None, inputs.questions(spark, sf_dir), stats=stats, counted=counted)


def rag_prompts(spark, sf_dir):
    asked = inputs.questions(spark, sf_dir)
    hits = search.search_batch(
        inputs.chunks(spark, sf_dir), asked, carry=("source_url", "chunk_text")
    )
    return prompts.rag_prompts(asked, hits).select(
        "question_id",
        F.md5("prompt").alias("prompt_md5"),
        F.col("prompt_len").cast("long").alias("prompt_len"),
        "fixed_answer",
    )


def _evaluated(spark, sf_dir):
    return evaluation.evaluate_answers(inputs.answers(spark, sf_dir))


def evaluate_answers(spark, sf_dir):
    return _evaluated(spark, sf_dir).select(
        "question",
        F.array_join("matched_terms", "|").alias("matched"),
        F.size("expected_terms").alias("n_expected"),
        "score",
    )


def suggest_improvements(spark, sf_dir):
    return evaluation.suggest_improvements(_evaluated(spark, sf_dir))


def metric_records(spark, sf_dir):
    return evaluation.metric_records(_evaluated(spark, sf_dir), RUN).drop("created_at")


def retraining_signals(spark, sf_dir):
    sources = inputs.table(spark, sf_dir, "documents").select("source")
    signals = evaluation.retraining_signals(_evaluated(spark, sf_dir), sources)
    return evaluation.signal_json(signals.drop("created_at"))


def bounded_pull(spark, sf_dir):
    """All messages published as ten files, pulled file by file until the trace is met."""
    configure(spark)
    work = f"{shared_dir(spark)}/pull-{uuid.uuid4().hex}"
    publish_files(inputs.messages(spark, sf_dir).repartitionByRange(10, "message_id"), f"{work}/inbox")
    pull = BoundedPull(TRACE, f"{work}/found", max_batches=10, seconds=3600)
    return pull.run(stream_messages(spark, f"{work}/inbox", files_per_batch=1), f"{work}/checkpoint")


def _some_fail(messages):
    """The gate, for messages that fail first: once, twice or always, as their number says."""
    n = F.substring("message_id", 2, 20).cast("long")
    fails = F.when(n % 27 == 13, 99).when(n % 9 == 1, 2).when(n % 9 == 4, 1).otherwise(0)
    transient = F.when(n % 9 == 1, routing.TRANSIENT).otherwise("other")
    kind = F.when(F.col("attempt") <= fails, transient).when(F.size("errors") > 0, routing.FUNCTIONAL)
    return chunk_ops.resolve_fields(messages).withColumn("error_kind", kind)


def redelivered_messages(spark, sf_dir):
    """All messages as a stream of files; those that fail for a passing reason come again."""
    configure(spark)
    work = f"{shared_dir(spark)}/redelivery-{uuid.uuid4().hex}"
    publish_files(inputs.messages(spark, sf_dir).repartitionByRange(12, "message_id"), f"{work}/inbox")
    again = Redelivery(_some_fail, f"{work}/fates", max_attempts=3)
    stream = stream_messages(spark, f"{work}/inbox", files_per_batch=6)
    return again.run(stream, f"{work}/checkpoint").where("fate <> 'retry'").select(
        "message_id", "fate", F.col("attempt").alias("attempts")
    )


def fresh_sources(spark, sf_dir):
    """The documents against an earlier state that lacks some and has other texts of some."""
    docs = inputs.table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 7 == 3, F.concat("text", F.lit(" (draft)"))).otherwise(F.col("text"))
    earlier = docs.where(F.col("doc_id") % 10 != 4).withColumn("text", text)
    snapshots = evaluation.content_snapshot(earlier), evaluation.content_snapshot(docs)
    return evaluation.fresh_sources(evaluation.fresh_documents(*snapshots))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        mime_type,
        extract_html_text,
        document_events,
        published_documents,
        chunks,
        chunks_from_events,
        batch_ingest,
        ingest_summary,
        gate_encoding,
        nfc_canonical,
        gate_syntax,
        gate_contract_errors,
        gate_validate,
        gate_reasons,
        gate_tally,
        classify_outcomes,
        quarantine,
        find_by_trace,
        stream_ingest,
        chunk_counts,
        search_all_terms,
        search_any_word,
        search_batch,
        search_ranked,
        search_any_word_batch,
        search_stored,
        rag_prompts,
        evaluate_answers,
        suggest_improvements,
        metric_records,
        retraining_signals,
        bounded_pull,
        redelivered_messages,
        fresh_sources,
    )
}
