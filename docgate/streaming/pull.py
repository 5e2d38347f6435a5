"""A pull that ends by itself: look for one message and take no more of the stream than needed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docgate.operators.search import find_by_trace

_FOUND = T.StructType([T.StructField("message_id", T.StringType()), T.StructField("trace_id", T.StringType())])


class _Enough(Exception):
    """Ends the query before a batch is read; the batch stays uncommitted."""


@dataclass
class BoundedPull:
    """Search a stream of messages, micro-batch by micro-batch, for a trace id.

    The query ends at the first batch that holds the trace, after ``max_batches`` batches, after
    ``seconds``, or with what was available. Batches searched are committed to the checkpoint. The one
    that would follow is planned but neither read nor committed, so the next pull on the checkpoint
    starts with it. ``path`` keeps the hits, a folder per batch, so a batch that is searched again
    leaves the same rows. Files per batch bound what is taken at once (``stream_messages``).
    """

    trace_id: str
    path: str
    max_batches: int = 12
    seconds: float = 120.0
    found: bool = field(default=False, init=False)
    batches: int = field(default=0, init=False)

    def __post_init__(self) -> None:
        if self.max_batches < 1:
            raise ValueError(f"max_batches must be at least 1, got {self.max_batches}")

    def search_batch(self, messages: DataFrame, batch_id: int) -> None:
        if self.found or self.batches >= self.max_batches:
            raise _Enough
        target = f"{self.path}/batch_id={batch_id}"
        find_by_trace(messages, self.trace_id).write.mode("overwrite").parquet(target)
        self.batches += 1
        self.found = not messages.sparkSession.read.schema(_FOUND).parquet(target).isEmpty()

    def run(self, messages: DataFrame, checkpoint: str) -> DataFrame:
        """The messages with the trace id in the batches taken; no rows if it was not met."""
        self.found, self.batches = False, 0
        writer = messages.writeStream.foreachBatch(self.search_batch)
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            if not query.awaitTermination(self.seconds):
                query.stop()
        except StreamingQueryException:
            if not (self.found or self.batches >= self.max_batches):
                raise
        spark = messages.sparkSession
        if not self.batches:
            return spark.createDataFrame([], _FOUND)
        return spark.read.schema(_FOUND).parquet(f"{self.path}/batch_id=*")
