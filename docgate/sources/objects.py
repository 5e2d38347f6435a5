"""Stored objects (files under a prefix) as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.functions.sqltext import quoted


def read_objects(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """``name, content_type, content, length`` of every object below ``prefix``.

    ``name`` is relative to the prefix and ``content_type`` is NULL, as a file system keeps none.
    Directory markers (names ending in a slash) are left out. The bytes are read only if the
    ``content`` column is used.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(prefix)
    root = prefix.split("://", 1)[-1].rstrip("/") + "/"
    return files.where(~F.col("path").endswith("/")).select(
        # After the first occurrence: the prefix may turn up again further down.
        F.expr(f"substring(path, locate({quoted(root)}, path) + {len(root)})").alias("name"),
        F.lit(None).cast("string").alias("content_type"),
        F.col("path").alias("source_url"),
        "content",
        "length",
    )
