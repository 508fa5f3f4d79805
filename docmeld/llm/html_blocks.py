"""Main text of web pages from flat text blocks.

A page is read once from front to back. Tags that begin or end a block cut its text into flat blocks; each knows how many
words it has, which part of them are links, the same of the block before and after it, and what the elements around it are
called. A decision tree, trained on the labelled table below, says which blocks belong to the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docmeld.llm.common import map_texts, text_bytes

# Elements of HTML.
RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|canvas|select|audio|video"
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Containers that name their content, and words of classes, ids and roles that do.
APART = frozenset("nav aside footer form dialog menu button fieldset".split())
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disclaimer discussion disqus footer form gdpr legal login masthead menu modal nav navbar navigation newsletter notice pager "
    "pagination popup promo promoted promotion recommended related reply replies respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe tags teaser toolbar widget".split()
)
ARTICLE = frozenset("article main".split())
ARTICLE_WORDS = frozenset("article content entry main post story".split())
#: Apart only outside an article, which may have a header of its own.
PAGE_HEAD = frozenset(["header", "banner", "masthead"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose class speaks of the page and not of their own content.
WHOLE = frozenset(["html", "body"])

_ATTRIBUTES = r"""(?>(?:"[^"]*"|'[^']*'|[^'">])*)"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:{_ATTRIBUTES}|[^>]*)>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)({_ATTRIBUTES}|[^>]*)>|<[!?][^>]*>", re.S | re.I
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?(?:false|until))|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile("[a-z]+")

FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "apart", "in_article", "heading",
)

# Labelled blocks in the order of FEATURES, and whether each is part of the article.
LABELLED = (
    # paragraphs of an article, long and short, beside others of their kind, at its ends, and beside a caption or a link list
    (62, 0.00, 48, 0.00, 75, 0.00, 0, 1, 0, 1), (48, 0.04, 9, 0.00, 62, 0.00, 0, 1, 0, 1), (110, 0.10, 62, 0.00, 31, 0.00, 0, 1, 0, 1),
    (3, 0.00, 40, 0.00, 55, 0.00, 0, 1, 0, 1), (1, 0.00, 90, 0.00, 12, 0.00, 0, 1, 0, 1), (14, 0.07, 70, 0.00, 12, 0.50, 0, 1, 0, 1),
    (25, 0.40, 51, 0.00, 44, 0.00, 0, 1, 0, 1), (1, 0.00, 1, 0.00, 2, 0.00, 0, 1, 0, 1), (33, 0.00, 8, 0.00, 11, 0.27, 0, 1, 0, 1),
    (7, 0.00, 1, 1.00, 120, 0.00, 0, 1, 0, 1), (5, 0.60, 33, 0.00, 30, 0.00, 0, 1, 0, 1), (2, 0.00, 0, 0.00, 0, 0.00, 0, 1, 0, 1),
    (9, 0.50, 40, 0.00, 0, 0.00, 0, 1, 0, 1), (2, 0.50, 1, 1.00, 0, 0.00, 0, 1, 0, 1), (4, 0.50, 30, 0.00, 8, 0.00, 0, 1, 0, 1),
    (6, 0.67, 20, 0.00, 2, 0.50, 0, 1, 0, 1), (3, 0.33, 3, 0.33, 3, 0.33, 0, 1, 0, 1), (8, 0.75, 60, 0.00, 30, 0.00, 0, 1, 0, 1),
    (20, 0.00, 5, 0.00, 2, 1.00, 0, 1, 0, 1), (3, 0.00, 2, 0.00, 1, 1.00, 0, 1, 0, 1), (60, 0.00, 1, 1.00, 1, 1.00, 0, 1, 0, 1),
    (9, 0.11, 12, 0.00, 4, 1.00, 0, 1, 0, 1), (31, 0.00, 0, 0.00, 1, 1.00, 0, 1, 0, 1), (12, 0.00, 24, 0.30, 3, 0.80, 0, 1, 0, 1),
    # its headings
    (9, 0.00, 6, 1.00, 48, 0.00, 0, 1, 1, 1), (4, 0.00, 75, 0.00, 62, 0.00, 0, 1, 1, 1), (12, 0.00, 11, 0.00, 1, 0.00, 0, 1, 1, 1),
    (6, 1.00, 1, 1.00, 60, 0.00, 0, 1, 1, 1),
    # lists of links inside an article's element
    (2, 1.00, 2, 1.00, 2, 1.00, 0, 1, 0, 0), (1, 1.00, 1, 1.00, 1, 1.00, 0, 1, 0, 0), (3, 1.00, 44, 0.00, 3, 1.00, 0, 1, 0, 0),
    (4, 0.95, 3, 1.00, 5, 1.00, 0, 1, 0, 0), (2, 1.00, 2, 1.00, 0, 0.00, 0, 1, 0, 0),
    # elements that are set apart: menus, adverts, notices, comments, forms, page ends, within the article or not
    (1, 1.00, 0, 0.00, 1, 1.00, 1, 0, 0, 0), (1, 1.00, 1, 1.00, 9, 0.00, 1, 0, 0, 0), (8, 0.00, 1, 1.00, 12, 0.00, 1, 0, 0, 0),
    (45, 0.00, 1, 1.00, 9, 0.00, 1, 0, 0, 0), (70, 0.03, 60, 0.00, 22, 0.00, 1, 1, 0, 0), (22, 0.00, 70, 0.03, 0, 0.00, 1, 1, 0, 0),
    (11, 0.27, 33, 0.00, 0, 0.00, 1, 0, 0, 0), (5, 0.00, 52, 0.00, 8, 0.00, 1, 0, 1, 0), (3, 0.00, 90, 0.00, 41, 0.00, 1, 1, 1, 0),
    (2, 0.00, 3, 0.00, 1, 0.00, 1, 0, 0, 0), (130, 0.00, 2, 0.00, 6, 0.00, 1, 0, 0, 0), (1, 0.00, 80, 0.00, 80, 0.00, 1, 1, 0, 0),
    # pages without an element for the article: text by its words and those around it
    (58, 0.02, 44, 0.00, 66, 0.01, 0, 0, 0, 1), (35, 0.00, 4, 0.00, 80, 0.00, 0, 0, 0, 1), (90, 0.12, 3, 1.00, 40, 0.00, 0, 0, 0, 1),
    (18, 0.00, 55, 0.00, 61, 0.00, 0, 0, 0, 1), (6, 0.00, 72, 0.00, 47, 0.00, 0, 0, 0, 1), (12, 0.00, 60, 0.00, 3, 1.00, 0, 0, 0, 1),
    (28, 0.00, 30, 0.00, 5, 0.20, 0, 0, 0, 1), (7, 0.00, 2, 1.00, 64, 0.00, 0, 0, 1, 1), (5, 0.00, 48, 0.00, 52, 0.00, 0, 0, 1, 1),
    (15, 0.00, 30, 0.00, 0, 0.00, 0, 0, 0, 1), (11, 0.00, 40, 0.00, 0, 0.00, 0, 0, 0, 1), (26, 0.00, 14, 0.00, 2, 1.00, 0, 0, 0, 1),
    (40, 0.03, 4, 1.00, 3, 1.00, 0, 0, 0, 1), (24, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 1), (21, 0.00, 9, 0.00, 26, 0.00, 0, 0, 0, 1),
    # and what is around it there
    (2, 1.00, 2, 1.00, 3, 1.00, 0, 0, 0, 0), (3, 1.00, 0, 0.00, 2, 1.00, 0, 0, 0, 0), (6, 0.00, 2, 1.00, 3, 1.00, 0, 0, 0, 0),
    (9, 0.33, 52, 0.00, 0, 0.00, 0, 0, 0, 0), (4, 0.00, 3, 0.00, 2, 1.00, 0, 0, 0, 0), (16, 0.75, 7, 1.00, 9, 0.90, 0, 0, 0, 0),
    (11, 0.55, 58, 0.00, 2, 1.00, 0, 0, 0, 0), (2, 0.00, 2, 1.00, 1, 1.00, 0, 0, 1, 0), (5, 0.00, 4, 0.00, 3, 0.00, 0, 0, 0, 0),
    (30, 0.80, 4, 1.00, 45, 0.00, 0, 0, 0, 0), (3, 0.00, 1, 0.00, 0, 0.00, 0, 0, 0, 0), (1, 1.00, 1, 1.00, 58, 0.00, 0, 0, 0, 0),
    (2, 1.00, 3, 1.00, 90, 0.00, 0, 0, 0, 0), (4, 1.00, 0, 0.00, 40, 0.00, 0, 0, 0, 0), (3, 1.00, 55, 0.00, 60, 0.00, 0, 0, 0, 0),
)


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    apart: bool
    in_article: bool
    heading: bool


class Node(NamedTuple):
    """A leaf has a share of article blocks, an inner node a feature and what is at most its threshold on the left."""

    share: float
    feature: int = -1
    at: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """A decision tree by Gini impurity; of equal splits that of the first feature and the lowest threshold."""
    share, best = float(y.mean()), (0.0, -1, 0.0)
    if depth and 0 < share < 1:
        gini = lambda part: 2 * part.mean() * (1 - part.mean()) * len(part)
        for feature in range(x.shape[1]):
            values = np.unique(x[:, feature])
            for at in (values[:-1] + values[1:]) / 2:
                low = x[:, feature] <= at
                gain = gini(y) - gini(y[low]) - gini(y[~low])
                if gain > best[0] + 1e-9:
                    best = (gain, feature, float(at))
    if best[1] < 0:
        return Node(share)
    low = x[:, best[1]] <= best[2]
    return Node(share, best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


@cache
def trained() -> Node:
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def shares(node: Node, x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x))
    pending = [(node, np.arange(len(x)))]
    while pending:
        node, rows = pending.pop()
        if node.feature < 0:
            out[rows] = node.share
        elif len(rows):
            low = x[rows, node.feature] <= node.at
            pending += [(node.left, rows[low]), (node.right, rows[~low])]
    return out


class _Element(NamedTuple):
    tag: str
    apart: bool
    in_article: bool


def _entered(tag: str, attributes: str, around: _Element) -> _Element:
    """What an element says of its content, and those around it said."""
    apart, in_article = around.apart, around.in_article
    names: set[str] = set()
    if tag not in WHOLE and attributes:
        for kind, *values in _NAMED.findall(attributes):
            names.update(_WORD.findall("".join(values).lower()))
    own_article = tag in ARTICLE or (names & ARTICLE_WORDS and not names & APART_WORDS)
    head = tag == "header" or names & PAGE_HEAD or "header" in names
    if tag in APART or (head and not in_article and not own_article) or (tag not in ARTICLE and names & APART_WORDS - PAGE_HEAD):
        apart = True
    if attributes and tag not in WHOLE and _HIDDEN.search(attributes):
        apart = True
    return _Element(tag, apart, in_article or bool(own_article))


def blocks(page: str) -> list[Block]:
    """The flat blocks of a page in order, white space turned into single spaces and character references decoded."""
    out: list[Block] = []
    stack, text, linked = [_Element("", False, False)], [], 0
    in_link, heading, at = 0, False, 0

    def close() -> None:
        nonlocal linked
        words = "".join(text).split()
        if words:
            out.append(Block(" ".join(words), len(words), min(linked, len(words)), stack[-1].apart, stack[-1].in_article, heading))
        text.clear()
        linked = 0

    # behind the last > there is no tag, which keeps the search linear; a comment may begin there and hide the rest
    end = page.rfind(">") + 1
    hidden = page.find("<!--", end)
    page = page if hidden < 0 else page[:hidden]
    for m in _TOKEN.finditer(page, 0, end):
        if m.start() > at:
            piece = html.unescape(page[at : m.start()])
            text.append(piece)
            if in_link:
                linked += len(piece.split())
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag == "a":
            in_link = 0 if m[2] else 1
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCKS:
            close()
            heading = tag in HEADINGS and not m[2]
            if tag in VOID:
                continue
            if m[2]:
                in_link = 0
                if any(e.tag == tag for e in stack):
                    while stack.pop().tag != tag:
                        pass
            elif not m[4].endswith("/"):
                if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack[-1].tag == tag:
                    stack.pop()
                stack.append(_entered(tag, m[4], stack[-1]))
    if at < len(page):
        text.append(html.unescape(page[at:]))
    close()
    return out


def features(found: Sequence[Block]) -> np.ndarray:
    """One row of FEATURES per block of a page; before the first and after the last one there is an empty block."""
    own = np.array([(b.words, b.linked / b.words) for b in found], float).reshape(-1, 2)
    padded = np.vstack((np.zeros((1, 2)), own, np.zeros((1, 2))))
    flags = np.array([(b.apart, b.in_article, b.heading) for b in found], float).reshape(-1, 3)
    return np.hstack((own, padded[:-2], padded[2:], flags))


def main_text(page: str) -> tuple[str, int, int]:
    """Text of a page, its number of blocks and how many of them are in the text."""
    found = blocks(page)
    if not found:
        return "", 0, 0
    kept = [b.text for b, share in zip(found, shares(trained(), features(found)).tolist()) if share > 0.5]
    return "\n\n".join(kept), len(found), len(kept)


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html", keep: Sequence[str] = ("url",)) -> DataFrame:
    """Rows (page_id, text, n_chars, n_blocks, n_kept) and the columns ``keep``, one for each row of ``pages``.

    A null, empty or blank page, and one without an article, has the empty text. Markup that is cut off or not closed is read
    as far as it goes: a comment or script without an end hides what follows. Pages are taken whole, repeated ones each by
    itself; other columns of ``pages`` play no part, whatever their names.
    """
    own = pages.select(F.col(page_id).alias("page_id"), F.col(html).cast("string").alias("html"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)))

    def rows(part: pa.RecordBatch) -> dict:
        found = [main_text(t.decode("utf-8", "replace")) for t in text_bytes(part["html"])]
        out = {"page_id": part["page_id"], "text": pa.array([f[0] for f in found], pa.string()), "n_chars": pa.array([len(f[0]) for f in found], pa.int64())}
        out |= {name: pa.array([f[k] for f in found], pa.int32()) for name, k in (("n_blocks", 1), ("n_kept", 2))}
        return out | {f"_{i}": part[f"_{i}"] for i in range(len(keep))}

    kinds = dict(own.dtypes)
    schema = f"page_id {kinds['page_id']}, text string, n_chars long, n_blocks int, n_kept int"
    found = map_texts(own, rows, schema + "".join(f", _{i} {kinds[f'_{i}']}" for i in range(len(keep))))
    return found.select("page_id", *(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "text", "n_chars", "n_blocks", "n_kept")
