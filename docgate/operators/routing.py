"""Where a handled message goes: accept, retry or quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgate.operators.gate import keep, rendered

TRANSIENT = "transient"
FUNCTIONAL = "functional"


def classify_outcomes(handled: DataFrame, error_kind: str = "error_kind") -> DataFrame:
    """Add ``outcome``, ``action`` and ``quarantined`` from the kind of error (NULL = none).

    Only transient and unknown failures are delivered again; a functional reject is settled and
    parked in quarantine, so that it never bounces.
    """
    kind = F.col(error_kind)
    outcome = (
        F.when(kind.isNull(), F.lit("ACCEPTED"))
        .when(kind == TRANSIENT, F.lit("TRANSIENT"))
        .when(kind == FUNCTIONAL, F.lit("FUNCTIONAL_REJECT"))
        .otherwise(F.lit("UNKNOWN"))
    )
    settled = kind.isNull() | (kind == FUNCTIONAL)
    return handled.select(
        *[c for c in handled.columns if c != error_kind],
        outcome.alias("outcome"),
        F.when(settled, F.lit("ack")).otherwise(F.lit("nack")).alias("action"),
        F.coalesce(kind == FUNCTIONAL, F.lit(False)).alias("quarantined"),
    )


def quarantine(checked: DataFrame) -> DataFrame:
    """Rejected messages with their reason, for rows that carry ``errors``; payload kept as is."""
    data = [F.col("data")] if "data" in checked.columns else []
    return keep(
        checked, F.size("errors") > 0, F.col("message_id"), rendered().alias("reason"), *data
    )
