"""Fixed layouts of the tables that the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_STR, _TS, _DBL = T.StringType(), T.TimestampType(), T.DoubleType()

ERROR = _schema(("path", _STR), ("code", _STR), ("message", _STR))
MESSAGES = _schema(("message_id", _STR), ("data", T.BinaryType()), ("charset", _STR))
CHUNKS = _schema(
    ("doc_id", _STR),
    ("chunk_no", T.IntegerType()),
    ("chunk_text", _STR),
    ("source_url", _STR),
    ("ingested_at", _TS),
    ("embedding", _STR),
)
METRICS = _schema(("run_id", _STR), ("question", _STR), ("score", _DBL), ("created_at", _TS))
SIGNALS = _schema(("reason", _STR), ("source", _STR), ("score", _DBL), ("created_at", _TS))
