"""MIME type of a stored object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Known name endings and the type of everything else.
ENDINGS = ((".pdf", "application/pdf"), (".html", "text/html"), (".htm", "text/html"))
OTHER = "application/octet-stream"


def mime_type(name: Column, content_type: Column) -> Column:
    """The declared type if there is one, else a guess from the name's ending."""
    guess = F.when(content_type != "", content_type)
    for ending, kind in ENDINGS:
        guess = guess.when(F.lower(name).endswith(ending), F.lit(kind))
    return guess.otherwise(F.lit(OTHER))
