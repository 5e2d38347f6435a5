"""Main text of HTML pages: markup first, then the lines that a page shares with its nearest URLs.

A page is read into lines, one for each block (``br`` is white space inside one). Three kinds:
lines in elements that are no article by their tag, role, class or id (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, reader comments, hidden elements) go at once; lines
inside the page's own ``article`` or ``main`` stay; the rest is undecided. Undecided lines are
settled by page differencing: pages of a host are put in the order of their URL paths, each is
compared with the nearest ``reach`` pages on either side, the two sequences of lines are aligned by a
longest common subsequence, and undecided lines that are shared go. A neighbour that has the same
article (``same`` of the characters) says nothing about a template and is passed over.

Lines in an ``article`` or ``main`` are aligned too, but sharing does not remove them: copies, quotes
and licence lines are part of an article.

Differencing moves only 64-bit hashes and lengths of lines: pages of one host with the same lines
are one entry; entries are ordered by a range exchange and numbered, and blocks of ``BLOCK``
consecutive entries, with ``reach`` more at both ends, are compared. So a host with most of all pages
is spread like any other. What has to go is joined to the pages, which are parsed a second time:
broadcast if it has been measured to be small, by a shuffled join otherwise.

Null html is empty; a page without text gives the empty string. A null or odd URL has no host and so
no neighbours. Repeated rows give repeated rows. Tags are found in linear time; the alignment takes the product of the numbers of lines that occur in both pages, in linear memory. Only
``page_id``, ``url`` and ``html`` are read, whatever other columns there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgate.llm.common import by_bytes, written
from docgate.operators.sizing import BROADCAST_LIMIT, fits_broadcast

BLOCK = 128
CELLS = 1 << 20  # an alignment table of at most this size is held at once

CHROME, OPEN, ARTICLE = 0, 1, 2

VOID = frozenset(
    "area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
NOT_TEXT = frozenset(
    "head nav aside footer form search menu dialog button select datalist noscript template object "
    "canvas audio video svg applet noframes noembed".split()
)
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar status".split()
)
# Parts of a class or id that mark an element as no part of the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner banners "
    "sponsor sponsored promo promotion breadcrumb breadcrumbs comment comments disqus respond reply "
    "replies cookie cookies consent gdpr footer copyright disclaimer menu menus nav navbar navigation "
    "masthead topbar newsletter notice notices notification notifications alert pager pagination popup "
    "modal overlay paywall related recommended recommendations share sharing sharebar sidebar signup "
    "signin login subscribe subscription social skiplink toolbar widget widgets search form hidden "
    "outbrain taboola".split()
)
# These end an open paragraph or an open element of their own kind.
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"),
}
_FENCES = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "option": ("select",),
           "tr": ("table",), "td": ("table",), "th": ("table",)}

_TAG = r"<(/?)([a-zA-Z][^\s/>]*)(%s)>"
_REST = r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)"
# Quotes may hold a closing bracket. Once one is never closed, brackets alone count, from there on.
_QUOTED = re.compile(_REST + "|" + _TAG % r"""(?:"[^"]*"|'[^']*'|[^>"'])*+""", re.S)
_PLAIN = re.compile(_REST + "|" + _TAG % "[^>]*", re.S)
_OPENING = re.compile(r"</?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_URL = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)([^?#]*)"


@dataclass(frozen=True)
class Settings:
    reach: int = 3
    same: float = 0.5


@lru_cache(maxsize=4096)
def _kind(name: str, attributes: str) -> int | None:
    """What an element says about the text in it; None if nothing."""
    if name in ("html", "body"):
        return None
    found = {}
    for key, value in _ATTRIBUTE.findall(attributes):
        value = value[1:-1] if value[:1] in "\"'" else value
        found.setdefault(key.lower(), unescape(value))
    roles = set(found.get("role", "").lower().split())
    style = found.get("style", "").lower().replace(" ", "")
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    if name in NOT_TEXT or roles & ROLES or hidden or "display:none" in style or "visibility:hidden" in style:
        return CHROME
    if name != "main":
        for token in f"{found.get('class', '')} {found.get('id', '')}".split():
            words = [w.lower() for w in _WORDS.findall(token)]
            if words and words[0] not in ("no", "has", "with", "without") and MARKS.intersection(words):
                return CHROME
    return ARTICLE if name in ("article", "main") or roles & {"article", "main"} else None


class _Page:
    """Reads one page. ``stack`` holds (name, kind of the text inside)."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.open: dict[str, int] = {}
        self.kind = OPEN
        self.held: list[str] = []
        self.lines: list[tuple[int, str]] = []

    def flush(self) -> None:
        if self.held:
            text = " ".join(unescape("".join(self.held)).split())
            self.held = []
            if text and self.kind != CHROME:
                self.lines.append((self.kind, text))

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.flush()
            if self.open.get("p"):
                self.end("p", fences=("table", "td", "th", "button"))
            for sibling in SIBLINGS.get(name, ()):
                self.end(sibling, fences=_FENCES[name])
        elif name == "br":
            self.held.append(" ")
        if name in VOID:
            return
        own = _kind(name, attributes)
        if name == "header" and self.kind != ARTICLE:
            own = CHROME
        self.enter(name, self.kind if own is None or self.kind == CHROME else own)

    def enter(self, name: str, kind: int) -> None:
        if kind != self.kind:
            self.flush()
        self.stack.append((name, kind))
        self.open[name] = self.open.get(name, 0) + 1
        self.kind = kind

    def end(self, name: str, fences: tuple[str, ...] = ()) -> None:
        """Close the innermost element of the name, and what is open inside it."""
        if not self.open.get(name):
            return
        if fences:
            for inner, _ in reversed(self.stack):
                if inner == name:
                    break
                if inner in fences:
                    return
        while True:
            inner, _ = self.stack.pop()
            self.open[inner] -= 1
            kind = self.stack[-1][1] if self.stack else OPEN
            if kind != self.kind:
                self.flush()
                self.kind = kind
            if inner == name:
                return


def lines(html: str) -> list[tuple[int, str]]:
    """The lines of a page that markup does not rule out: (OPEN or ARTICLE, text) in page order."""
    page, tags, at = _Page(), _QUOTED, 0
    while True:
        mark = html.find("<", at)
        if mark < 0:
            page.held.append(html[at:])
            break
        tag = tags.match(html, mark)
        if tag is None and not _OPENING.match(html, mark):  # a bracket in the text
            page.held.append(html[at : mark + 1])
            at = mark + 1
            continue
        if tag is None and tags is _QUOTED:
            tags = _PLAIN
            continue
        if tag is None:  # a tag that the page's end cuts off
            page.held.append(html[at:mark])
            break
        page.held.append(html[at : tag.start()])
        at = tag.end()
        if not tag[2]:
            continue
        name = tag[2].lower()
        if tag[1]:
            if name in BLOCKS:
                page.flush()
            elif name == "br":
                page.held.append(" ")
            page.end(name)
        elif name in RAW:
            if name not in ("script", "style"):
                page.held.append(" ")
            closing = _ENDS[name].search(html, at)
            at = closing.start() if closing else len(html)
        else:
            page.start(name, tag[3])
    page.flush()
    return page.lines


def shared(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Which members of two sequences are in one longest common subsequence of them."""
    marks = np.zeros(len(a), bool), np.zeros(len(b), bool)
    both = set(a) & set(b)
    one = np.array([n for n, x in enumerate(a) if x in both], np.int64)
    two = np.array([n for n, x in enumerate(b) if x in both], np.int64)
    left, right = np.array(a, np.int64)[one], np.array(b, np.int64)[two]
    parts = [(0, len(one), 0, len(two))]
    while parts:
        i, j, k, m = parts.pop()
        while i < j and k < m and left[i] == right[k]:
            marks[0][one[i]] = marks[1][two[k]] = True
            i, k = i + 1, k + 1
        while i < j and k < m and left[j - 1] == right[m - 1]:
            j, m = j - 1, m - 1
            marks[0][one[j]] = marks[1][two[m]] = True
        if i == j or k == m:
            continue
        if j - i == 1:
            hit = np.flatnonzero(right[k:m] == left[i])
            if len(hit):
                marks[0][one[i]] = marks[1][two[k + hit[0]]] = True
        elif (j - i) * (m - k) <= CELLS:
            rows = [np.zeros(m - k + 1, np.int32)]
            for x in left[i:j]:
                rows.append(_next_row(rows[-1], right[k:m], x))
            p, q = j - i, m - k
            while p and q:
                if left[i + p - 1] == right[k + q - 1] and rows[p][q] == rows[p - 1][q - 1] + 1:
                    p, q = p - 1, q - 1
                    marks[0][one[i + p]] = marks[1][two[k + q]] = True
                elif rows[p - 1][q] >= rows[p][q - 1]:
                    p -= 1
                else:
                    q -= 1
        else:  # halve one sequence, and split the other where the two halves share most
            half = (i + j) // 2
            head, tail = (np.zeros(m - k + 1, np.int32) for _ in range(2))
            for x in left[i:half]:
                head = _next_row(head, right[k:m], x)
            for x in left[half:j][::-1]:
                tail = _next_row(tail, right[k:m][::-1], x)
            cut = k + int(np.argmax(head + tail[::-1]))
            parts += [(i, half, k, cut), (half, j, cut, m)]
    return marks


def _next_row(row: np.ndarray, right: np.ndarray, x: int) -> np.ndarray:
    new = row.copy()
    new[1:] = np.maximum(row[1:], row[:-1] + (right == x))
    return np.maximum.accumulate(new)


def _parsed(pages: DataFrame, texts: bool) -> DataFrame:
    """host, path, seq (names the lines of the page), and the lines themselves or their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "html"):
            kinds, hashes, lengths, names, found_texts = [], [], [], [], []
            for html in batch.column("html").to_pylist():
                found = lines(html or "")
                own = [blake2b(t.encode("utf-8", "replace"), digest_size=8).digest() for _, t in found]
                kinds.append([k for k, _ in found])
                names.append(blake2b(b"".join(own) + bytes(kinds[-1]), digest_size=16).digest())
                if texts:
                    found_texts.append([t for _, t in found])
                else:
                    hashes.append([int.from_bytes(h, "little", signed=True) for h in own])
                    lengths.append([len(t) for _, t in found])
            new = {"seq": pa.array(names, pa.binary()), "kinds": pa.array(kinds, pa.list_(pa.int8()))}
            if texts:
                old = {c: batch.column(c) for c in ("page_id", "url", "host")}
                new["lines"] = pa.array(found_texts, pa.list_(pa.string()))
            else:
                old = {c: batch.column(c) for c in ("host", "path")}
                new["hashes"] = pa.array(hashes, pa.list_(pa.int64()))
                new["lengths"] = pa.array(lengths, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(old | new)

    host = F.lower(F.regexp_extract("url", _URL, 1))
    placed = pages.select(
        "page_id", "url", F.when(host != "", host).alias("host"),
        F.regexp_extract("url", _URL, 2).alias("path"), "html",
    )
    if texts:
        kind = placed.schema["page_id"].dataType.simpleString()
        schema = f"page_id {kind}, url string, host string, seq binary, kinds array<tinyint>, lines array<string>"
    else:
        schema = ("host string, path string, seq binary, kinds array<tinyint>, hashes array<bigint>, "
                  "lengths array<bigint>")
    return placed.mapInArrow(run, schema)


def _template(page: dict, other: dict, s: Settings) -> np.ndarray | None:
    """Lines of a page shared with another; None if they have one article."""
    mine, _ = shared(page["hashes"], other["hashes"])
    lengths, kinds = np.array(page["lengths"]), np.array(page["kinds"])
    told = (kinds == ARTICLE).any() and ARTICLE in other["kinds"]
    judged = kinds == ARTICLE if told else np.ones(len(kinds), bool)
    theirs = np.array(other["lengths"])[np.array(other["kinds"]) == ARTICLE] if told else np.array(other["lengths"])
    whole = min(lengths[judged].sum(), theirs.sum())
    return None if whole and lengths[judged & mine].sum() > s.same * whole else mine


def _differences(block: pa.Table, s: Settings) -> pa.Table:
    rows = sorted(block.to_pylist(), key=lambda r: r["place"])
    own = block.column("block")[0].as_py()
    found = []
    for n, page in enumerate(rows):
        if page["place"] // BLOCK != own or OPEN not in page["kinds"]:
            continue
        gone = np.zeros(len(page["kinds"]), bool)
        for other in rows[max(0, n - s.reach) : n + s.reach + 1]:
            if other is not page and other["host"] == page["host"]:
                mine = _template(page, other, s)
                if mine is not None:
                    gone |= mine
        gone &= np.array(page["kinds"]) == OPEN
        if gone.any():
            found.append((page["host"], page["seq"], np.flatnonzero(gone).tolist()))
    hosts, seqs, places = zip(*found) if found else ((), (), ())
    return pa.table({"host": pa.array(hosts, pa.string()), "seq": pa.array(seqs, pa.binary()),
                     "gone": pa.array(places, pa.list_(pa.int32()))})


def templates(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """host, seq and gone: places of the undecided lines that nearest URLs share."""
    entries = _parsed(pages, texts=False).where("host IS NOT NULL").groupBy("host", "seq").agg(
        F.min("path").alias("path"), F.first("kinds").alias("kinds"), F.first("hashes").alias("hashes"),
        F.first("lengths").alias("lengths"),
    )
    order = ("host", "path", "seq")
    ranged = written(
        entries.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
            "part", F.spark_partition_id()
        ).withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "page-order",
    )
    # One row for each partition.
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = ranged.join(F.broadcast(starts), "part").withColumn("place", F.col("start") + F.col("at"))
    reached = F.array_distinct(F.transform(
        F.array(F.lit(-s.reach), F.lit(0), F.lit(s.reach)), lambda d: F.floor((F.col("place") + d) / BLOCK)
    ))
    blocks = placed.drop("part", "at", "start", "path").withColumn("block", F.explode(reached))
    return blocks.groupBy("block").applyInArrow(
        lambda block: _differences(block, s), "host string, seq binary, gone array<int>"
    )


def main_text(
    pages: DataFrame, s: Settings = Settings(), broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """page_id, url, text (blocks joined by line ends) and n_chars, a row for each page."""
    gone = written(templates(pages, s), "page-templates")
    parsed = _parsed(pages, texts=True)
    small = fits_broadcast(gone, broadcast_limit, F.octet_length("host") + 4 * F.size("gone"))
    joined = parsed.join(F.broadcast(gone) if small else gone.hint("merge"), ["host", "seq"], "left")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda _, n: ~F.array_contains("gone", n))
    )
    return joined.select("page_id", "url", F.array_join(kept, "\n").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
