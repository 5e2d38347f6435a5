"""Plain text of an HTML page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is removed, in this order, each match becoming one blank.
REMOVED = (
    r"(?is)<script[^>]*>.*?</script>",
    r"(?is)<style[^>]*>.*?</style>",
    r"(?s)<!--.*?-->",
    r"<[^>]*>",
)
# Entities that are decoded; the ampersand comes last.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
)
BLANKS = r"[ \t\n\r\f]+"


# What ends a match of each of the patterns above.
CLOSINGS = ("</script>", "</style>", "-->", ">")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _up_to_last(text: Column, mark: str) -> Column:
    """The text through the last ASCII-case-insensitive ``mark``; empty without one."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rest = F.length(F.substring_index(lowered, mark, -1))
    return F.left(text, F.length(text) - rest)


def _removed(text: Column, pattern: str, closing: str) -> Column:
    """All matches as blanks, in linear time: an opening mark that no closing mark follows would
    be searched to the end of the text, so the pattern sees only the text before the last one."""

    def apply(t: Column) -> Column:
        return _let(_up_to_last(t, closing), lambda head: F.concat(cut(head), F.substr(t, F.length(head) + 1)))

    def cut(head: Column) -> Column:
        if closing in ("-->", ">"):
            return F.regexp_replace(head, pattern, " ")
        # An opening tag must end before the last closing tag. What stands between the last such
        # end and the closing tag holds no opening and no closing, and is put aside.
        n = len(closing)
        body = F.left(head, F.length(head) - n)
        return F.when(F.length(head) == 0, head).otherwise(
            _let(_up_to_last(body, ">"), lambda pre: rejoin(head, body, pre, F.right(head, F.lit(n))))
        )

    def rejoin(head: Column, body: Column, pre: Column, last: Column) -> Column:
        def put_back(done: Column) -> Column:
            unused = F.endswith(done, last)  # a match that took it has become a blank
            kept = F.left(done, F.length(done) - len(closing))
            return F.when(unused, F.concat(kept, F.substr(head, F.length(pre) + 1))).otherwise(done)

        return _let(F.regexp_replace(F.concat(pre, last), pattern, " "), put_back)

    return _let(text, apply)


def html_text(html: Column) -> Column:
    text = html
    for pattern, closing in zip(REMOVED, CLOSINGS):
        text = _removed(text, pattern, closing)
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, BLANKS, " "))
