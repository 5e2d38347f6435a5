"""Strict JSON check on top of Spark's lenient parser.

``try_parse_json`` stops after the first JSON value and ignores what follows. So the text is
parsed as the first element of a two-element array whose second element is the text's own hash:
the hash can only turn up there if the parser consumed the whole text as exactly one value.
"""

from __future__ import annotations

# Where the document sits inside the wrapped value.
ROOT = "$[0]"

# Adds ``_wrapped`` and ``_is_json`` for the text in ``_text``. Later items use earlier ones.
PARSED = (
    "sha2(_text, 256) AS _seal",
    """try_parse_json(concat('[', _text, ',"', _seal, '"]')) AS _wrapped""",
    "coalesce(try_variant_get(_wrapped, '$[1]', 'string') = _seal, false) AS _is_json",
)
