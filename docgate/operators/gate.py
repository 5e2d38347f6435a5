"""The validation gate: every message gets a status, and its errors as data.

Stages run cheapest first and the first failing one ends the check: charset and NFC, then strict
JSON, then the contract, which reports all its errors. The gate never fails a job on bad input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgate.functions.charset import with_text
from docgate.functions.contract import Contract, contract_columns
from docgate.functions.strict_json import PARSED
from docgate.session import configure

ACCEPTED = "ACCEPTED"
REJECTED = "REJECTED"
UNDECODABLE = "ENCODING_UNDECODABLE"
NOT_JSON = "SYNTAX_NOT_JSON"
EMPTY = "SYNTAX_EMPTY"


def keep(df: DataFrame, condition: Column, *columns: Column | str) -> DataFrame:
    """Filter and project in one step.

    A plain ``filter`` on a gate result would be pushed below the projection that computes it, and
    every message would be parsed once for the filter and once more for its columns. Emitting
    zero or one row per input row keeps it at one parse.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def with_decoded(df: DataFrame, data: str = "data", charset: str = "charset") -> DataFrame:
    """Add ``_text``, NULL for undecodable payloads."""
    configure(df.sparkSession)
    return with_text(df, data, charset)


_SYNTAX = (
    *PARSED,
    f"""CASE WHEN _text IS NULL THEN '{UNDECODABLE}'
             WHEN NOT _is_json THEN '{NOT_JSON}'
             WHEN btrim(_text, ' \\t\\n\\r') = 'null' THEN '{EMPTY}' END AS _code""",
)
# The messages of the early stages.
_ERRORS = f"""CASE WHEN _code IS NULL THEN _violations ELSE array(named_struct(
    'path', '$', 'code', _code, 'message',
    CASE _code WHEN '{UNDECODABLE}' THEN concat('payload is not valid ', _charset)
               WHEN '{NOT_JSON}' THEN 'payload is not a single JSON value'
               ELSE 'payload contained no JSON value' END)) END AS errors"""


def with_syntax(df: DataFrame, data: str = "data", charset: str = "charset") -> DataFrame:
    """Add ``_text``, the parsed value, and ``_code`` of the first failing early stage."""
    return with_decoded(df, data, charset).selectExpr("*", *_SYNTAX)


def with_gate(
    df: DataFrame,
    contract: Contract | None = None,
    data: str = "data",
    charset: str = "charset",
) -> DataFrame:
    """Add ``errors``, and keep the intermediate columns (leading underscore) for what follows.

    One projection: each item may use the ones before it, and Spark stacks them so that the
    message is parsed once.
    """
    rules = contract_columns(contract or Contract.from_path())
    return with_decoded(df, data, charset).selectExpr("*", *_SYNTAX, *rules, _ERRORS)


def status_of(errors: Column | str = "errors") -> Column:
    return F.when(F.size(errors) == 0, ACCEPTED).otherwise(REJECTED)


def validate(
    df: DataFrame,
    contract: Contract | None = None,
    data: str = "data",
    charset: str = "charset",
) -> DataFrame:
    """Add ``status``, ``canonical`` (NFC text of accepted messages) and ``errors``."""
    return with_gate(df, contract, data, charset).select(
        *df.columns,
        status_of().alias("status"),
        F.expr("CASE WHEN size(errors) = 0 THEN _text END AS canonical"),
        "errors",
    )


def reasons(errors: Column | str = "errors") -> Column:
    """Each error as ``CODE[path]: message``."""
    return F.transform(
        errors, lambda e: F.format_string("%s[%s]: %s", e["code"], e["path"], e["message"])
    )


def rendered(errors: Column | str = "errors") -> Column:
    """One line per message for logs; the two leading texts are fixed values."""
    return F.when(F.size(errors) == 0, "ACCEPTED (enqueued)").otherwise(
        F.concat(F.lit("REJECTED — "), F.array_join(reasons(errors), "; "))
    )


def tally(validated: DataFrame) -> DataFrame:
    """Messages by status and first error code."""
    return validated.groupBy("status", F.get("errors", F.lit(0))["code"].alias("code")).agg(
        F.count("*").alias("n")
    )
