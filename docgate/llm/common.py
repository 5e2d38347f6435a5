"""What the operators of this folder share: reading tables, scratch tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from docgate.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared folder."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe from lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_size(
    batches: Iterator[pa.RecordBatch], column: str, measure: Callable, limit: int
) -> Iterator[pa.RecordBatch]:
    """Cut batches where the measure of one column reaches the limit; a larger value is alone."""
    for batch in batches:
        start = held = 0
        for row, size in enumerate(measure(batch.column(column)).fill_null(0).to_pylist()):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches by the bytes of one column."""
    return by_size(batches, column, pc.binary_length, limit)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column as Python strings; null is the empty text."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def free(df: DataFrame, *names: str) -> None:
    """An error for names of new columns that a frame has already, in any case of letters."""
    present = {c.lower() for c in df.columns}
    if taken := [n for n in names if n.lower() in present]:
        raise ValueError(f"columns {taken} exist already; rename them or give other names")


_KEPT: dict = {}


def kept(key: object, make: Callable):
    """What a worker keeps from task to task, under one key at a time: another key forgets it, so
    that memory of one operator does not stay while the next one runs in the same worker."""
    if key not in _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()
        _KEPT[key] = make()
    return _KEPT[key]


def unseen(values: Iterable, known: dict) -> list:
    """Distinct values that are no keys yet; the time depends on the values alone."""
    return [v for v in set(values) if v not in known]
