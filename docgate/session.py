"""Session settings the operators rely on, and where scratch data may live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Duplicate object keys are legal JSON (the last one wins), so the parser must take them.
# Small Arrow batches keep one batch of long documents far below Arrow's 2 GiB string limit.
SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings above; cheap and safe to repeat."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own: on a cluster the
    driver's temporary folder is not visible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    fallback = tempfile.mkdtemp(prefix="docgate-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small, reused frame with a reliable checkpoint."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def scratch(spark: SparkSession) -> str:
    """A folder of its own, not yet made, below the shared one."""
    return f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Compute a large, reused frame once: as files, which are smaller than a checkpoint's."""
    folder = scratch(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core on an input that comes in fewer splits than there are cores.

    A table of that size is at most cores x ``maxPartitionBytes``, so the exchange is small. An
    input with enough splits, which is any large one, is returned untouched: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
