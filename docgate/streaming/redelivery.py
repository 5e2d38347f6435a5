"""Redelivery inside a stream: a message that fails for a passing reason comes again by itself.

Without this, one failing message makes the whole batch come again. Here every message of a batch
meets its own fate, and the batch is done:

* ``accepted``: the handler found no error;
* ``quarantine``: a functional error, which another attempt would not mend;
* ``retry``: a transient or unknown error; the message joins a later batch;
* ``dead``: such an error in the last attempt allowed.

A step (a batch, or a round of ``drain``) is handled once and written in one pass, partitioned by
fate and attempt, to a folder of its own. The attempt that failed in step s as number a comes again
in step ``s + delay * 2**(a - 1)``, so a step reads what is due from at most ``max_attempts - 1``
folders whose names it knows: nothing is listed, and waiting messages are not rewritten while they
wait. A replayed step reads the same folders and overwrites its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docgate.operators.routing import classify_outcomes
from docgate.streaming.ingest import query_id

_MESSAGE = "message_id string, data binary, charset string"
_STEPS = f"{_MESSAGE}, outcome string, query_id string, step bigint, fate string, attempt int"
_DRAINED = "steps bigint, query_id string, after bigint"

Handler = Callable[[DataFrame], DataFrame]


def _stored(spark: SparkSession, path: str, schema: str, base: str | None = None) -> DataFrame | None:
    """The table at a path, or None if nothing was ever written there."""
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class Redelivery:
    """``handle`` gets messages with their ``attempt`` (from 1) and returns the same rows with an
    ``error_kind`` (null: none, else as ``classify_outcomes`` takes it); other columns are dropped.
    The payload is kept for every fate but ``accepted``. ``delay`` counts steps.
    """

    handle: Handler
    path: str
    max_attempts: int = 5
    delay: int = 1

    def __post_init__(self) -> None:
        if self.max_attempts < 1 or self.delay < 1:
            raise ValueError("max_attempts and delay must be at least 1")

    def _wait(self, attempt: int) -> int:
        return self.delay * 2 ** (attempt - 1)

    def _due(self, spark: SparkSession, query: str, step: int) -> DataFrame | None:
        """Messages whose next attempt belongs to this step."""
        found = []
        for attempt in range(1, self.max_attempts):
            failed = step - self._wait(attempt)
            folder = f"{self.path}/steps/query_id={query}/step={failed}/fate=retry/attempt={attempt}"
            waiting = _stored(spark, folder, _MESSAGE) if failed >= 0 else None
            if waiting is not None:
                found.append(waiting.withColumn("attempt", F.lit(attempt + 1)))
        return reduce(DataFrame.unionByName, found) if found else None

    def _step(self, spark: SparkSession, query: str, step: int, messages: DataFrame | None) -> bool:
        """Handle what is new and what is due; False if there is neither."""
        due = self._due(spark, query, step)
        if messages is not None:
            fresh = messages.select("message_id", "data", "charset", F.lit(1).alias("attempt"))
            due = fresh if due is None else fresh.unionByName(due)
        if due is None:
            return False
        handled = self.handle(due).select("message_id", "data", "charset", "attempt", "error_kind")
        settled = F.col("action") == "ack"
        fate = (
            F.when(F.col("quarantined"), "quarantine")
            .when(settled, "accepted")
            .when(F.col("attempt") < self.max_attempts, "retry")
            .otherwise("dead")
        )
        routed = classify_outcomes(handled).withColumn("fate", fate).select(
            "message_id",
            F.when(F.col("fate") != "accepted", F.col("data")).alias("data"),
            "charset",
            "outcome",
            "fate",
            "attempt",
        )
        target = f"{self.path}/steps/query_id={query}/step={step}"
        routed.write.mode("overwrite").partitionBy("fate", "attempt").parquet(target)
        return True

    def _drained(self, spark: SparkSession, query: str, before: int | None = None) -> int:
        """Steps that drains took, in all or before a batch."""
        rows = _stored(spark, f"{self.path}/drained", _DRAINED)
        if rows is None:
            return 0
        rows = rows.where(F.col("query_id") == query)
        if before is not None:
            rows = rows.where(F.col("after") < before)
        return rows.agg(F.sum("steps").alias("n")).first()["n"] or 0

    def process_batch(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        query = query_id(spark)
        self._step(spark, query, batch_id + self._drained(spark, query, batch_id), messages)

    def drain(self, spark: SparkSession, query: str = "none") -> int:
        """Give waiting messages their attempts without new ones, until none waits; for a stream
        that is not running. Returns the number of steps taken. A later batch counts on from there.
        """
        steps = self.results(spark)
        if steps is None:
            return 0
        wait = F.lit(self.delay) * F.pow(F.lit(2), F.col("attempt") - 1)
        retry = F.col("fate") == "retry"
        # Partition columns only: file footers are read, no rows. Two numbers reach the driver.
        state = steps.where(F.col("query_id") == query).agg(
            F.max("step").alias("last"),
            F.max(F.when(retry, F.col("step") + wait)).cast("bigint").alias("due"),
        ).first()
        if state["due"] is None or state["due"] <= state["last"]:
            return 0
        earlier = self._drained(spark, query)
        after = state["last"] - earlier
        # A failed drain may have left an entry for the same batch; its steps count once.
        entry = f"{self.path}/drained/query_id={query}/after={after}"
        step, end = state["last"], state["due"]
        while step < end:
            step += 1
            spark.range(1).select(F.lit(step - state["last"]).cast("bigint").alias("steps")).write.mode(
                "overwrite"
            ).parquet(entry)
            if not self._step(spark, query, step, None):
                continue
            again = _stored(
                spark, f"{self.path}/steps/query_id={query}/step={step}", "message_id string, fate string, attempt int"
            )
            last = again.where(retry).agg(F.max("attempt").alias("attempt")).first()["attempt"]
            end = max(end, step + self._wait(last)) if last else end
        return step - state["last"]

    def start(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Start on a stream of messages; without a trigger, take what is there and stop."""
        writer = messages.writeStream.foreachBatch(self.process_batch)
        writer = writer.option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def run(self, messages: DataFrame, checkpoint: str) -> DataFrame | None:
        """Take what is there, then drain: every message ends accepted, in quarantine or dead."""
        query = self.start(messages, checkpoint)
        query.awaitTermination()
        spark = messages.sparkSession
        self.drain(spark, str(query.id))
        return self.results(spark)

    def results(self, spark: SparkSession) -> DataFrame | None:
        """All steps: ``message_id, data, charset, outcome, query_id, step, fate, attempt``. Rows of
        fate ``retry`` are attempts that failed; every message has at most one row of another fate."""
        return _stored(spark, f"{self.path}/steps", _STEPS)
