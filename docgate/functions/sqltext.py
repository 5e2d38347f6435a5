"""Values as Spark SQL text, for expressions that are clearer (and quicker to build) as SQL."""

from __future__ import annotations


def quoted(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A column name."""
    return "`" + column.replace("`", "``") + "`"
