"""Streaming ingest: gate every micro-batch, store its chunks, park its rejects.

A batch whose chunks cannot be written fails, and the restarted query delivers it again from the
checkpoint. So does one whose rejects cannot be parked, after a second try; a caller who would
rather lose rejects than wait sets ``lose_rejects``. Each batch of a query overwrites a folder of
its own, so a batch that is delivered twice leaves the same rows as one delivered once, and a query
with a new checkpoint does not touch what an earlier one stored.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docgate.functions.chunking import CHUNK_OVERLAP, CHUNK_SIZE
from docgate.functions.contract import Contract
from docgate.operators.chunks import chunk_records, resolve_fields
from docgate.operators.routing import quarantine
from docgate.session import spread

logger = logging.getLogger(__name__)

# The property under which Spark keeps the id of the streaming query that runs a job.
_QUERY_ID = "sql.streaming.queryId"

BatchSink = Callable[[DataFrame, int], None]


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query that runs this batch; its checkpoint keeps it over restarts.
    Batches that are handled outside a stream count as one query."""
    return spark.sparkContext.getLocalProperty(_QUERY_ID) or "none"


def folder_sink(path: str) -> BatchSink:
    """Write each batch to a folder of its query and number, replacing an earlier attempt at it."""

    def write(df: DataFrame, batch_id: int) -> None:
        query = query_id(df.sparkSession)
        df.write.mode("overwrite").parquet(f"{path}/query_id={query}/batch_id={batch_id}")

    return write


@dataclass(frozen=True)
class StreamingIngest:
    """``on_accept`` gets each batch's chunk rows, ``on_quarantine`` its rejects, as DataFrames."""

    on_accept: BatchSink
    on_quarantine: BatchSink
    contract: Contract | None = None
    size: int = CHUNK_SIZE
    overlap: int = CHUNK_OVERLAP
    # Drop redelivered copies of a message inside a batch.
    drop_duplicates: bool = False
    # Commit a batch although its rejects could not be parked.
    lose_rejects: bool = False

    def process_batch(self, messages: DataFrame, batch_id: int) -> None:
        if self.drop_duplicates:
            messages = messages.dropDuplicates(["message_id"])
        # A source with few partitions would leave cores idle; no key, so copies spread as well.
        messages = spread(messages)
        rejected = F.size("errors") > 0
        checked = resolve_fields(messages, self.contract).select(
            "message_id",
            "errors",
            "doc_id",
            "source_url",
            F.when(~rejected, F.col("content")).alias("content"),
            F.when(rejected, F.col("data")).alias("data"),
        )
        # Two sinks read the batch; keeping it saves gating it twice. A lost block is recomputed.
        checked = checked.persist()
        try:
            self.on_accept(chunk_records(checked, self.size, self.overlap), batch_id)
            parked = quarantine(checked).withColumn("quarantined_at", F.current_timestamp())
            self._park(parked, batch_id)
        finally:
            checked.unpersist()

    def _park(self, parked: DataFrame, batch_id: int) -> None:
        try:
            self.on_quarantine(parked, batch_id)
            return
        except Exception:
            logger.exception("quarantine of batch %d failed, trying once more", batch_id)
        try:
            self.on_quarantine(parked, batch_id)
        except Exception:
            if not self.lose_rejects:
                raise
            logger.exception("quarantine of batch %d failed again; its rejects are lost", batch_id)

    def start(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Start on a stream of messages; without a trigger, take what is there and stop."""
        writer = messages.writeStream.foreachBatch(self.process_batch)
        writer = writer.option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()
