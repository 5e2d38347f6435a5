"""Sinks of the pipeline. Each appends; a failing write fails the job, which may then be retried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.operators.evaluation import signal_json
from docgate.operators.search import counted_words
from docgate.schemas import CHUNKS, METRICS, SIGNALS


def _as(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def append_chunks(chunks: DataFrame, path: str) -> None:
    _as(chunks, CHUNKS).write.mode("append").parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNKS).parquet(path)


def save_chunk_table(chunks: DataFrame, name: str, buckets: int) -> None:
    """Chunk table bucketed and sorted by document.

    Counting per document, and joins on it, need no exchange of chunk rows on this layout, and a
    look-up of one document reads one bucket.
    """
    writer = _as(chunks, CHUNKS).repartition(buckets, "doc_id").write.mode("append")
    writer.bucketBy(buckets, "doc_id").sortBy("doc_id", "chunk_no").saveAsTable(name)


def save_postings(chunks: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """Counted words of the chunks as table ``name``, their statistics as ``name`` with ``_stats``.

    A row says how often each word stands in a chunk, so scores are added up without an exchange and
    a chunk's key is stored once. The chunks' texts are exchanged, not their words, and the rows are
    written as they come. A chunk's bucket (a file) follows from key and text: neither a hot word, nor
    a hot document, nor a text that stands everywhere heaps up. Tables lie below ``path`` if it is
    given, else in the warehouse.
    """
    def save(df: DataFrame, table: str) -> None:
        writer = df.write.mode("errorifexists")
        if path is not None:
            writer = writer.option("path", f"{path}/{table}")
        writer.saveAsTable(table)

    save(counted_words(chunks, buckets), name)
    # From the postings: the texts are split into words once. Every chunk is counted under "".
    posted = chunks.sparkSession.table(name)
    each = posted.select("copies", "length", F.explode(F.array_append("terms", "")).alias("term"))
    worded = each.groupBy("term").agg(
        F.sum("copies").alias("n_chunks"), F.sum(F.col("copies") * F.col("length")).alias("n_words")
    )
    save(worded, f"{name}_stats")


def read_postings(spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame]:
    """Counted words and statistics, for ``search_ranked``."""
    return spark.table(name), spark.table(f"{name}_stats")


def append_metrics(records: DataFrame, path: str) -> None:
    """Append to the evaluation metrics; the table comes into being with the first write."""
    _as(records, METRICS).write.mode("append").parquet(path)


def append_signals(signals: DataFrame, path: str) -> None:
    """Append retraining signals as JSON message bodies."""
    signal_json(_as(signals, SIGNALS)).select(F.col("body").cast("binary").alias("data")).write.mode(
        "append"
    ).parquet(path)
