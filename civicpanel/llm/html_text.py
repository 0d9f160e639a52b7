"""Main text of web pages from flat text blocks and a decision tree.

A page is cut at every block-level tag into flat blocks of text. Each block is described by
its number of words and its link density (share of words inside links), the same of the
block before and after it, and what its surroundings say of themselves: elements such as
``nav`` or ``footer`` and class or id names such as ``sidebar`` mark boilerplate, ``article``
and ``main`` mark content. Spark trains a decision tree on the labelled blocks below; the
tree, a few nodes, classifies every block of every page inside the task that reads the page.

Scripts, styles, comments and tags give no text, character references are decoded, white
space becomes one space. Broken markup is read as browsers do in the simple cases: unclosed
paragraphs end at the next one, stray end tags are ignored, a tag cut off by the end of the
page is dropped. NULL and empty pages have empty texts; every row gives a row.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.llm.common import small_batches

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "zone", "heading"]

# Small labelled table: the features in the order above (zone: -1 boilerplate, 1 content, 0 says
# nothing; heading: 0 or 1), then whether the block belongs to the article.
LABELLED = [
    # marked as content: whatever its size, first, last and in between
    (9, 0.0, 1, 1.0, 30, 0.0, 1, 1, 1),
    (1, 0.0, 12, 0.0, 1, 0.0, 1, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1),
    (2, 1.0, 40, 0.0, 35, 0.1, 1, 0, 1),
    (1, 1.0, 0, 0.0, 14, 0.0, 1, 0, 1),
    (60, 0.2, 9, 0.0, 45, 0.0, 1, 0, 1),
    (55, 0.0, 60, 0.0, 8, 0.0, 1, 0, 1),
    (4, 0.5, 3, 0.3, 2, 1.0, 1, 0, 1),
    (300, 0.05, 80, 0.0, 3, 0.0, 1, 0, 1),
    (12, 0.9, 25, 0.0, 25, 0.0, 1, 0, 1),
    # marked as boilerplate: menus, footers, adverts, notices, forms, reader comments
    (1, 1.0, 0, 0.0, 1, 1.0, -1, 0, 0),
    (2, 1.0, 1, 1.0, 1, 1.0, -1, 0, 0),
    (1, 0.0, 1, 1.0, 9, 0.0, -1, 0, 0),
    (8, 0.0, 1, 1.0, 10, 0.0, -1, 0, 0),
    (7, 0.1, 60, 0.0, 0, 0.0, -1, 0, 0),
    (12, 0.0, 70, 0.0, 0, 0.0, -1, 0, 0),
    (45, 0.0, 3, 0.0, 40, 0.0, -1, 0, 0),
    (80, 0.02, 45, 0.0, 50, 0.0, -1, 0, 0),
    (250, 0.0, 60, 0.0, 60, 0.0, -1, 0, 0),
    (3, 0.0, 80, 0.0, 25, 0.0, -1, 1, 0),
    (6, 0.5, 90, 0.0, 4, 0.3, -1, 0, 0),
    (30, 0.4, 12, 0.6, 9, 1.0, -1, 0, 0),
    # unmarked: long and little linked is article
    (25, 0.0, 30, 0.0, 40, 0.0, 0, 0, 1),
    (45, 0.05, 8, 0.0, 60, 0.0, 0, 0, 1),
    (70, 0.1, 3, 1.0, 55, 0.1, 0, 0, 1),
    (120, 0.0, 90, 0.0, 4, 1.0, 0, 0, 1),
    (18, 0.0, 40, 0.0, 5, 1.0, 0, 0, 1),
    (33, 0.2, 1, 1.0, 2, 1.0, 0, 0, 1),
    (22, 0.0, 6, 0.0, 28, 0.0, 0, 0, 1),
    # unmarked and short: article where its neighbours are, headings before a long block
    (4, 0.0, 40, 0.0, 45, 0.0, 0, 0, 1),
    (2, 0.0, 30, 0.0, 60, 0.0, 0, 0, 1),
    (8, 0.0, 2, 1.0, 40, 0.0, 0, 1, 1),
    (6, 0.0, 0, 0.0, 50, 0.0, 0, 1, 1),
    (5, 0.0, 50, 0.0, 30, 0.0, 0, 1, 1),
    (7, 0.1, 28, 0.0, 33, 0.0, 0, 0, 1),
    # unmarked and short among short or linked blocks, or linked itself: not article
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0),
    (3, 1.0, 40, 0.0, 2, 1.0, 0, 0, 0),
    (2, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0),
    (4, 0.0, 3, 0.6, 1, 1.0, 0, 0, 0),
    (5, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0),
    (3, 0.3, 2, 0.0, 3, 0.0, 0, 0, 0),
    (9, 0.8, 30, 0.0, 30, 0.0, 0, 0, 0),
    (15, 0.9, 2, 1.0, 12, 0.8, 0, 0, 0),
    (40, 0.8, 10, 1.0, 9, 1.0, 0, 0, 0),
    (60, 0.6, 4, 0.5, 3, 0.0, 0, 0, 0),
    (6, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 3, 1.0, 0, 1, 0),
]

# Fixed values of HTML.
#: Elements without markup inside: all up to their end tag, or to the end of the page, is no text.
RAW = "script|style|textarea"
#: Elements whose whole content is left out. Self-closed, or without an end tag further on, they are empty.
SKIPPED = set("noscript template svg math iframe object select canvas audio video".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
#: What an opening tag ends if it is still open, up to the nearest element that holds it.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

# Names that say what an element is for.
BOILERPLATE_TAGS = set("nav footer aside form button head title dialog menu fieldset".split())
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_NAMES = set(
    "ad ads advert adverts advertisement advertisements adsense banner breadcrumb breadcrumbs comment comments cookie "
    "cookies consent disclaimer footer form header login masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices notification popup promo promotion related reader replies responses share sharing sidebar signup "
    "skyscraper social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
CONTENT_NAMES = set("article content entry main post story".split())
BOILERPLATE_ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>"""
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
SKIPPED_END = re.compile(rf"</({'|'.join(sorted(SKIPPED))})(?=[\s/>])", re.I)
NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


def zone_of(tag: str, rest: str, inside: int, in_article: bool) -> int:
    """-1 in boilerplate, 1 in content, 0 elsewhere, for what an element holds."""
    if inside < 0 or tag in BOILERPLATE_TAGS or tag == "header" and not in_article:
        return -1
    found = 1 if tag in CONTENT_TAGS else inside
    for kind, *values in NAME.findall(rest):
        value = next(filter(None, values), "")
        if kind.lower() == "role":
            if value.lower() in BOILERPLATE_ROLES:
                return -1
            found = 1 if value.lower() in ("main", "article") else found
            continue
        if tag in ("html", "body") or in_article and tag in CONTENT_TAGS:
            continue
        for name in value.split():
            words = {w.lower() for w in WORD.findall(name)}
            if words & BOILERPLATE_NAMES and not (tag in CONTENT_TAGS and words & CONTENT_NAMES):
                return -1
            if words & CONTENT_NAMES:
                found = 1
    return found


@dataclass
class Block:
    text: str
    words: int
    linked: int
    zone: int
    heading: bool


@dataclass
class Blocks:
    """Collects the flat blocks of one page."""

    found: list[Block] = field(default_factory=list)
    #: Open elements: tag, zone outside, whether it is a link.
    stack: list[tuple[str, int]] = field(default_factory=list)
    pieces: list[tuple[str, bool]] = field(default_factory=list)
    zone: int = 0
    links: int = 0
    heading: bool = False
    #: Open elements of ``SKIPPED``.
    skipped: int = 0

    def text(self, raw: str) -> None:
        if raw and not self.skipped:
            self.pieces.append((raw, self.links > 0))

    def flush(self) -> None:
        if not self.pieces:
            return
        pieces, self.pieces = self.pieces, []
        # References can be cut by no tag, so each piece is decoded alone.
        words = html.unescape("".join(p for p, _ in pieces)) if len(pieces) == 1 else "".join(html.unescape(p) for p, _ in pieces)
        split = words.split()
        if split:
            linked = sum(len(html.unescape(p).split()) for p, link in pieces if link)
            self.found.append(Block(" ".join(split), len(split), min(linked, len(split)), self.zone, self.heading))

    def close_to(self, at: int) -> None:
        for tag, outside in reversed(self.stack[at:]):
            self.zone = outside
            if tag in SKIPPED:
                self.skipped -= 1
            elif tag in HEADINGS and not self.skipped:
                self.heading = False
        del self.stack[at:]

    def close_open(self, tags: set[str], until: set[str]) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] in tags:
                self.close_to(at)
                return
            if self.stack[at][0] in until:
                return

    def open(self, tag: str, rest: str) -> None:
        if tag in SKIPPED or self.skipped:
            if tag not in VOID | INLINE and not rest.endswith("/"):
                self.stack.append((tag, self.zone))
                self.skipped += tag in SKIPPED
            return
        if tag == "a":
            self.links = 1
            return
        if tag in INLINE:
            if not rest or tag in VOID or rest.endswith("/"):
                return
            inner = zone_of(tag, rest, self.zone, True)
            if inner == self.zone:
                return
            self.flush()
            self.stack.append((tag, self.zone))
            self.zone = inner
            return
        self.flush()
        if tag in VOID:
            return
        if tag in ENDS:
            self.close_open(ENDS[tag], {"ul", "ol", "dl", "table", "tr" if tag in ("td", "th") else "table"})
        else:
            self.close_open({"p"}, {"td", "th", "li", "button", "div", "section", "article"} - {"p"})
        if tag in HEADINGS:
            self.heading = True
        in_article = any(t in CONTENT_TAGS for t, _ in self.stack)
        self.stack.append((tag, self.zone))
        self.zone = zone_of(tag, rest, self.zone, in_article)

    def close(self, tag: str) -> None:
        if self.skipped and tag in INLINE:
            return
        if tag == "a":
            self.links = 0
            return
        if tag not in INLINE and tag not in SKIPPED and not self.skipped:
            self.flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                if tag not in SKIPPED and not any(t in SKIPPED for t, _ in self.stack[:at]):
                    self.flush()
                self.close_to(at)
                return


def blocks(page: str) -> list[Block]:
    """Flat blocks of a page in order."""
    out, at = Blocks(), 0
    ends = {m[1].lower(): m.start() for m in SKIPPED_END.finditer(page)}
    for m in TOKEN.finditer(page):
        out.text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            out.close(tag)
        elif tag not in SKIPPED or ends.get(tag, -1) >= at:
            out.open(tag, m["rest"])
    out.text(page[at:])
    out.flush()
    return out.found


def features(found: list[Block]) -> np.ndarray:
    """One line of ``FEATURES`` per block."""
    words = np.array([0, *(b.words for b in found), 0], float)
    links = np.array([0, *(b.linked for b in found), 0], float) / np.maximum(words, 1)
    zone, heading = [b.zone for b in found], [b.heading for b in found]
    return np.column_stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], zone, heading])


def trained(spark: SparkSession, labelled: list[tuple] = LABELLED) -> list[tuple[int, float, int, int, float]]:
    """Nodes of the tree that Spark learns from ``labelled``: feature (-1 in a leaf), threshold, children, prediction."""
    rows = spark.createDataFrame([tuple(map(float, r)) for r in labelled], [*FEATURES, "label"])
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = DecisionTreeClassifier(maxDepth=6, minInstancesPerNode=1, seed=1).fit(rows)
    nodes: list[tuple[int, float, int, int, float]] = []

    def add(node) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, 0, 0, node.prediction()))
        if node.subtreeDepth():
            split = node.split()
            left, right = add(node.leftChild()), add(node.rightChild())
            nodes[at] = (split.featureIndex(), split.threshold(), left, right, node.prediction())
        return at

    add(model._call_java("rootNode"))
    return nodes


def classify(tree: list[tuple[int, float, int, int, float]], x: np.ndarray) -> np.ndarray:
    """Which lines of ``x`` the tree calls article."""
    at = np.zeros(len(x), int)
    feature, threshold, left, right, value = (np.array(c) for c in zip(*tree))
    while (feature[at] >= 0).any():
        inner = feature[at] >= 0
        low = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= threshold[at]
        at = np.where(inner, np.where(low, left[at], right[at]), at)
    return value[at] > 0.5


def main_text(page: str, tree: list[tuple[int, float, int, int, float]]) -> str:
    found = blocks(page)
    if not found:
        return ""
    return " ".join(b.text for b, keep in zip(found, classify(tree, features(found))) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    tree = trained(pages.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page, tree) for page in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    small_batches(pages.sparkSession)
    narrow = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html")
    )
    return narrow.mapInPandas(read, "page_id long, url string, text string, n_chars long")
