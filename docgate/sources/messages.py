"""Message sources and sinks: files for replay and tests, Kafka for live topics.

Acknowledgement is the streaming checkpoint: a message is done when the batch that holds it has
been committed, and is delivered again if that batch fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.schemas import MESSAGES


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages stored as Parquet under ``path``."""
    return spark.read.schema(MESSAGES).parquet(path)


def stream_messages(
    spark: SparkSession, path: str, files_per_batch: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """Messages arriving as Parquet files; both options bound the size of one batch."""
    reader = spark.readStream.schema(MESSAGES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def _from_kafka(rows: DataFrame) -> DataFrame:
    charset = F.expr("filter(headers, h -> h.key = 'charset')[0].value").cast("string")
    return rows.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("value").alias("data"),
        charset.alias("charset"),
    )


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a Kafka topic (needs Spark's Kafka package on the class path)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("includeHeaders", "true")
    return _from_kafka(reader.options(**options).load())


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send ``data`` of every message to a Kafka topic."""
    rows = messages.select(F.col("message_id").alias("key"), F.col("data").alias("value"))
    writer = rows.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).save()


def publish_files(messages: DataFrame, path: str) -> None:
    """Append messages as Parquet files, where ``stream_messages`` picks them up."""
    messages.select("message_id", "data", "charset").write.mode("append").parquet(path)
