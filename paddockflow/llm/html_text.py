"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks of text between block-level tags.  A block is described by its
number of words and share of linked words, the same of its neighbours, and what its ancestors
say about themselves.  Elements and names that only page furniture has (navigation, footer,
advert, comment ...) count fully, names that articles use as well (alert, legal, social ...)
by half, and only where a whole class or id is made of such names; article, main and their like
are a feature of their own.  A small decision tree, trained here on the labelled table below,
tells main text from the rest.

A null page gives an empty text; empty pages have none; long pages take time in proportion to
their length; repeated rows stay; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|object|canvas)\b(?:[^<>\"']|\"[^<\"]*\"|'[^<']*')*+>"
    r".*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z|(?=<))",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names and the words by which containers name themselves.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img picture source area map".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text.
_RAW = frozenset("script style noscript template textarea title svg iframe object canvas".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FURNITURE = frozenset("nav footer aside form menu dialog button select head fieldset".split())
_ARTICLE = frozenset("article main".split())
_FURNITURE_NAMES = frozenset(
    "nav navbar navigation navigationbar menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts "
    "advertisement adslot adbox adunit adsense adsbygoogle sponsor sponsored cookie cookies consent gdpr popup modal "
    "overlay newsletter subscribe signup login related recommended comment comments reply "
    "replies discussion disqus pagination pager toolbar skip contentinfo complementary".split()
)
#: Names of furniture that parts of an article have too.
_WEAK_NAMES = frozenset(
    "alert notice legal social search share sharing promo promotion banner widget copyright disclaimer".split()
)
#: Words that only say where or how an element stands.
_PLACE_NAMES = frozenset(
    "slot box area bar list item wrapper wrap container block section unit inner outer top bottom left right site page "
    "global primary secondary form link links icon icons button buttons panel row col column group text title info "
    "message small large fixed sticky mobile desktop".split()
)
#: A name that starts with one of these tells what an element is about or has, not what it is.
_ABOUT = frozenset("has no not with without category cat tag tagged".split())
_ARTICLE_NAMES = frozenset("article post entry story main content body".split())

#: Features of a block, in the order of the table.
FEATURES = (
    "words", "link_share", "previous_words", "previous_link_share", "next_words", "next_link_share",
    "furniture", "article", "heading",
)

#: Labelled blocks: features as above, then 1 for main text.
TRAINING = (
    # paragraphs of an article, long and short, beside other paragraphs or at its edges
    (85, 0.0, 60, 0.0, 72, 0.0, 0, 1, 0, 1), (4, 0.0, 60, 0.0, 72, 0.0, 0, 1, 0, 1),
    (2, 0.0, 3, 0.0, 9, 0.0, 0, 1, 0, 1), (12, 0.0, 9, 0.0, 20, 0.0, 0, 1, 0, 1),
    (40, 0.1, 55, 0.0, 30, 0.05, 0, 1, 0, 1), (30, 0.3, 44, 0.0, 61, 0.0, 0, 1, 0, 1),
    (1, 0.0, 1, 0.0, 12, 0.0, 0, 1, 0, 1), (150, 0.02, 10, 0.0, 0, 0.0, 0, 1, 0, 1),
    (6, 0.0, 14, 0.0, 5, 1.0, 0, 1, 0, 1), (25, 0.0, 1, 1.0, 90, 0.0, 0, 1, 0, 1),
    (3, 1.0, 70, 0.0, 64, 0.0, 0, 1, 0, 1), (18, 0.0, 8, 0.0, 11, 0.0, 0, 1, 0, 1),
    # after or between paragraphs and lists with many links
    (80, 0.0, 20, 0.4, 30, 0.0, 0, 1, 0, 1), (5, 0.0, 4, 0.5, 0, 0.0, 0, 1, 0, 1),
    (30, 0.0, 12, 0.8, 40, 0.9, 0, 1, 0, 1), (7, 0.0, 3, 1.0, 4, 1.0, 0, 1, 0, 1),
    (2, 0.0, 0, 0.0, 2, 1.0, 0, 1, 0, 1), (14, 0.2, 30, 0.3, 25, 0.4, 0, 1, 0, 1),
    (60, 0.0, 9, 0.6, 0, 0.0, 0, 1, 0, 1), (10, 0.6, 60, 0.0, 3, 1.0, 0, 1, 0, 1),
    (6, 0.0, 2, 1.0, 1, 1.0, 0, 1, 0, 1), (4, 0.0, 3, 1.0, 2, 1.0, 0, 1, 1, 1),
    # their headings
    (8, 0.0, 12, 0.0, 85, 0.0, 0, 1, 1, 1), (9, 0.0, 1, 1.0, 20, 0.0, 0, 1, 1, 1),
    (3, 0.0, 90, 0.0, 55, 0.0, 0, 1, 1, 1), (1, 0.0, 7, 0.0, 2, 0.0, 0, 1, 1, 1),
    (10, 0.0, 9, 0.0, 8, 0.0, 0, 1, 1, 1), (5, 1.0, 3, 1.0, 60, 0.0, 0, 1, 1, 1),
    # menus, footers, adverts, notices, forms and comments, also inside an article
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (3, 1.0, 2, 1.0, 1, 1.0, 1, 0, 0, 0),
    (12, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0), (25, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0, 0),
    (20, 0.1, 70, 0.0, 0, 0.0, 1, 0, 0, 0), (60, 0.0, 44, 0.0, 0, 0.0, 1, 0, 0, 0),
    (40, 0.0, 90, 0.0, 35, 0.0, 1, 1, 0, 0), (90, 0.0, 80, 0.0, 35, 0.0, 1, 1, 0, 0),
    (2, 0.0, 90, 0.0, 35, 0.0, 1, 1, 0, 0), (7, 0.0, 2, 1.0, 30, 0.0, 1, 0, 1, 0),
    (4, 0.0, 50, 0.0, 3, 1.0, 1, 1, 1, 0), (15, 0.5, 50, 0.0, 3, 1.0, 1, 1, 0, 0),
    (150, 0.0, 90, 0.0, 60, 0.0, 1, 0, 0, 0), (8, 0.0, 10, 0.0, 9, 0.0, 1, 1, 0, 0),
    # parts of an article whose names furniture has too: long text without links is the article's
    (80, 0.0, 60, 0.0, 70, 0.0, 0.5, 1, 0, 1), (45, 0.0, 0, 0.0, 60, 0.0, 0.5, 1, 0, 1),
    (120, 0.1, 90, 0.0, 0, 0.0, 0.5, 1, 0, 1), (60, 0.0, 12, 0.0, 9, 0.0, 0.5, 1, 0, 1),
    (40, 0.0, 3, 1.0, 2, 1.0, 0.5, 1, 0, 1), (80, 0.0, 0, 0.0, 0, 0.0, 0.5, 1, 0, 1),
    (12, 0.0, 60, 0.0, 70, 0.0, 0.5, 1, 0, 0), (25, 0.0, 90, 0.0, 40, 0.0, 0.5, 1, 0, 0),
    (4, 1.0, 60, 0.0, 3, 1.0, 0.5, 1, 0, 0), (30, 0.6, 60, 0.0, 40, 0.0, 0.5, 1, 0, 0),
    (2, 0.0, 90, 0.0, 2, 0.0, 0.5, 1, 0, 0), (5, 0.0, 70, 0.0, 9, 0.0, 0.5, 1, 1, 0),
    (12, 0.0, 1, 1.0, 60, 0.0, 0.5, 0, 0, 0), (40, 0.0, 2, 1.0, 60, 0.0, 0.5, 0, 0, 0),
    (90, 0.0, 3, 1.0, 40, 0.0, 0.5, 0, 0, 0), (60, 0.2, 50, 0.0, 0, 0.0, 0.5, 0, 0, 0),
    # pages that do not name their parts: long text with few links, and what stands by it
    (80, 0.0, 3, 1.0, 60, 0.0, 0, 0, 0, 1), (45, 0.05, 80, 0.0, 70, 0.0, 0, 0, 0, 1),
    (33, 0.1, 60, 0.0, 2, 1.0, 0, 0, 0, 1), (120, 0.0, 4, 1.0, 3, 1.0, 0, 0, 0, 1),
    (9, 0.0, 60, 0.0, 58, 0.0, 0, 0, 0, 1), (4, 0.0, 75, 0.0, 41, 0.0, 0, 0, 0, 1),
    (5, 0.0, 3, 1.0, 80, 0.0, 0, 0, 1, 1), (8, 0.0, 50, 0.0, 66, 0.0, 0, 0, 1, 1),
    (14, 0.0, 40, 0.0, 22, 0.0, 0, 0, 0, 1), (20, 0.0, 35, 0.0, 28, 0.0, 0, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (4, 1.0, 60, 0.0, 2, 1.0, 0, 0, 0, 0),
    (3, 1.0, 2, 1.0, 70, 0.0, 0, 0, 0, 0), (6, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0),
    (30, 0.9, 12, 0.8, 40, 0.9, 0, 0, 0, 0), (10, 0.6, 60, 0.0, 3, 1.0, 0, 0, 0, 0),
    (5, 0.0, 4, 0.5, 0, 0.0, 0, 0, 0, 0), (7, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 0),
    (2, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (4, 0.0, 3, 1.0, 2, 1.0, 0, 0, 1, 0),
)


class DecisionTree:
    """Binary splits that lower the Gini impurity most; grown until pure or ``depth``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1):
        self.value = float(y.mean())
        self.split = None
        if depth == 0 or len(y) < 2 * least or self.value in (0.0, 1.0):
            return
        best = None
        for feature in range(x.shape[1]):
            levels = np.unique(x[:, feature])
            for cut in (levels[1:] + levels[:-1]) / 2:
                left = x[:, feature] <= cut
                n = int(left.sum())
                if min(n, len(y) - n) < least:
                    continue
                p, q = y[left].mean(), y[~left].mean()
                impurity = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, feature, float(cut), left)
        if best is None:
            return
        _, feature, cut, left = best
        self.split = (feature, cut)
        self.low = DecisionTree(x[left], y[left], depth - 1, least)
        self.high = DecisionTree(x[~left], y[~left], depth - 1, least)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Share of main text in each row's leaf."""
        if self.split is None:
            return np.full(len(x), self.value)
        feature, cut = self.split
        low = x[:, feature] <= cut
        out = np.empty(len(x))
        out[low], out[~low] = self.low.predict(x[low]), self.high.predict(x[~low])
        return out


@functools.cache
def trained() -> DecisionTree:
    table = np.array(TRAINING, float)
    return DecisionTree(table[:, :-1], table[:, -1])


def _named(value: str, in_article: bool) -> tuple[float, bool]:
    """(furniture, article) by the names in a class, id or role.

    A name is one token, such as ``cookie-notice``.  It is furniture's if all its words are, or
    say no more than where it stands; one word among others tells nothing (``legal-history``).
    """
    furniture, article = 0.0, False
    for token in value.split():
        words = [w.lower() for w in _WORDS.findall(token)]
        if not words or words[0] in _ABOUT and len(words) > 1:
            continue
        own = set(words)
        if own & _ARTICLE_NAMES:
            article = True  # "post-header" is the article's own, like a header inside it
            own -= {"header"}
        strong = own & _FURNITURE_NAMES - ({"header"} if in_article else set())
        weak = own & _WEAK_NAMES
        if (strong or weak) and own <= _FURNITURE_NAMES | _WEAK_NAMES | _PLACE_NAMES | _ARTICLE_NAMES:
            if not own & _ARTICLE_NAMES or strong:
                furniture = max(furniture, 1.0 if strong else 0.5)
    return furniture, article


def _hints(tag: str, attributes: str, in_article: bool) -> tuple[float, bool]:
    """(furniture, article) as an element's name and attributes have it; furniture is 0, 0.5 or 1."""
    furniture, article = float(tag in _FURNITURE), tag in _ARTICLE
    if tag == "header" and not in_article:
        furniture = 1.0
    if attributes and not attributes.isspace():
        for name, *values in _ATTRIBUTE.findall(attributes):
            value, name = "".join(values), name.lower()
            if name in ("class", "id", "role"):
                wrong, named = _named(value, in_article or article)
                if tag not in ("body", "html", *_ARTICLE):
                    furniture = max(furniture, wrong)
                article |= named and wrong < 1
            elif name == "hidden" and not value or name == "aria-hidden" and value == "true":
                furniture = 1.0
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                furniture = 1.0
    return furniture, article


def flat_blocks(page: str) -> list[tuple[str, int, int, float, bool, bool]]:
    """(text, words, linked words, furniture, article, heading) of a page's blocks in order."""
    blocks = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, float, bool]] = []
    opened: Counter = Counter()
    links, breaks, heading = 0, 0, False

    def close() -> None:
        nonlocal parts
        text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
        if text:
            linked = sum(len(html.unescape(t).split()) for t, is_link in parts if is_link)
            furniture, article = stack[-1][1:] if stack else (0.0, False)
            blocks.append((text, len(text.split()), linked, furniture, article, heading))
        parts = []

    at, raw = 0, ""
    for token in _TOKEN.finditer(page):
        if raw:
            if token[3] and token[2] == "/" and token[3].lower() == raw:
                at, raw = token.end(), ""
            continue
        if token.start() > at:
            piece = page[at : token.start()]
            parts.append((piece, links > 0))
            if breaks and not piece.isspace():
                breaks = 0
        at = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag, closing = tag.lower(), token[2] == "/"
        if tag in _RAW and not closing and not token[4].endswith("/"):
            raw = tag  # with attributes that its own pattern does not take
            continue
        if tag == "br":
            breaks += 1
            if breaks > 1:
                close()
            parts.append((" ", False))
            continue
        if tag in _INLINE:
            if tag == "a":
                links = max(0, links - 1) if closing else 1
            continue
        close()
        breaks = 0
        if tag in _HEADINGS:
            heading = not closing
        if tag in _VOID or token[4].endswith("/") or tag in ("p", "li", "tr", "td", "th", "dt", "dd") and not token[4].strip():
            if not closing and tag in ("p", "li", "td", "th", "dt", "dd"):
                links = 0
            continue
        if not closing:
            inside = stack[-1] if stack else ("", 0.0, False)
            furniture, article = _hints(tag, token[4], inside[2])
            stack.append((tag, max(furniture, inside[1]), article or inside[2]))
            opened[tag] += 1
        elif opened[tag]:
            while True:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == tag:
                    break
            links = 0
    if at < len(page) and not raw:
        parts.append((page[at:], links > 0))
    close()
    return blocks


def main_text(page: str | None) -> str:
    """Main text of a page: blocks in page order, an empty line between; empty if none."""
    blocks = flat_blocks(page or "")
    if not blocks:
        return ""
    words = np.array([b[1] for b in blocks], float)
    share = np.array([min(1.0, b[2] / b[1]) for b in blocks])
    earlier = lambda v: np.concatenate(([0.0], v[:-1]))
    later = lambda v: np.concatenate((v[1:], [0.0]))
    x = np.stack(
        [words, share, earlier(words), earlier(share), later(words), later(share),
         *(np.array([float(b[k]) for b in blocks]) for k in (3, 4, 5))],
        axis=1,
    )
    good = trained().predict(x) >= 0.5
    return "\n\n".join(b[0] for b, keep in zip(blocks, good.tolist(), strict=True) if keep)


def extracted(pages: DataFrame, column: str = "html") -> DataFrame:
    """``row`` (all columns as a struct) and ``main_text`` of every page; a null page gives an empty text."""
    spec = pages.select(F.struct("*").alias("row"))
    schema = T.StructType(list(spec.schema.fields)).add("main_text", "string")

    def run(batches):
        for batch in batches:
            found = batch.column("row").field(column)
            texts = [main_text(found[i].as_py()) for i in range(len(found))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "main_text"])

    return spec.mapInArrow(run, schema)
