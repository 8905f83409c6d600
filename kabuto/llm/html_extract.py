"""HTML extraction (operator 2): the maximum-scoring subsequence of words and tags.

A page is read into tokens: tags, and blocks of words with the context they stand in (the nearest
enclosing boilerplate marker, such as ``nav`` or a class "sidebar", below the elements that hold
the page's core, or else the block's tag). Tags
score negative, words by the log odds of their context lying in the main content, and words in
boilerplate as nothing. A linear scan
finds the contiguous stretch with the largest sum; its blocks in positive contexts are the text.

The weights come from labelled pages: pages that mark their main content with one ``article`` or
``main`` element label each of their tokens as inside or outside of it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kabuto.llm.common import prepare

LABELLED_PAGES = 4000  # pages the weights are fitted on, at most (those of smallest hash)
#: Elements whose content is never text.
OPAQUE = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "audio", "video", "select", "textarea", "button", "head", "title"}
RAW = ("script", "style", "textarea", "title")  # their content holds no tags
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Elements, and words in classes, ids and roles, that mark boilerplate.
MARKER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
MARKER_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "byline", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disqus", "footer", "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pagination", "popup", "promo", "promoted", "promotion", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
ROOTS = ("article", "main")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that carry an article's own text: a class or id of theirs marks them only if it says nothing else.
TEXTS = HEADINGS | {"p", "li", "dd", "dt", "section", "blockquote", "figcaption", "pre", "td", "th"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


def marker(name: str, attributes: str, article: bool = False) -> str | None:
    """The boilerplate marker that an element carries, if any.

    In an ``article``, elements of its own text (``TEXTS``) are marked by a class or id of marker words alone
    ("notice", "ad-banner", not "social-history" or "related-work"), and headings not by an id, which is
    made of what they say."""
    if name in MARKER_TAGS:
        return name
    if attributes and "=" in attributes and name not in ("body", "html"):
        strict = article and name in TEXTS
        for m in _ATTRIBUTE.finditer(attributes):
            if strict and name in HEADINGS and m[1].lower() == "id":
                continue
            value = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[2] or m[3] or m[4] or "")
            for part in value.lower().split():
                words = _WORDS.findall(part)
                if strict and not all(w in MARKER_WORDS for w in words):
                    continue
                for w in words:
                    if w in MARKER_WORDS:
                        return w
    return None


class Element:
    """An open element: its marker, its parent, and the words below it (once the page is read)."""

    __slots__ = ("name", "mark", "parent", "words", "context")

    def __init__(self, name: str, mark: str | None, parent: Element | None):
        self.name, self.mark, self.parent, self.words, self.context = name, mark, parent, 0, None


def settle(elements: list[Element]) -> None:
    """Give every element (in document order) its context: the nearest marker on it or above it.

    The markers of layouts ("has-sidebar", a form around the page) don't count: those on the page's
    core and around it, and on elements that hold more than half of the core's words. The core is
    the longest article, or else the longest main, or else the page. An article below a marked
    element (a comment) is not the core, unless that holds more than half of the main or page.
    """
    page = Element("", None, None)
    for e in reversed(elements):
        (e.parent or page).words += e.words

    def fits(e: Element) -> bool:
        up, marked = e.parent, None
        while up and up.name != "main":
            marked = marked or (up if up.mark else None)  # the nearest holds the fewest words
            up = up.parent
        return marked is None or 2 * marked.words > (up or page).words

    articles, mains = ([e for e in elements if e.name == name] for name in ("article", "main"))
    core = max([e for e in articles if fits(e)] or mains, key=lambda e: e.words, default=page)
    plain, up = set(), core
    while up:
        plain.add(id(up))
        up = up.parent
    inside = {id(core)}
    for e in elements:
        if e.parent is None and core is page or id(e.parent) in inside:
            inside.add(id(e))
            if 2 * e.words > core.words:
                plain.add(id(e))
        e.context = None if id(e) in plain else e.mark or (e.parent.context if e.parent else None)


class Block:
    __slots__ = ("element", "tag", "text", "root")

    def __init__(self, element: Element | None, tag: str, root: bool):
        self.element, self.tag, self.root, self.text = element, tag, root, []

    @property
    def context(self) -> str:
        mark = self.element.context if self.element else None
        return f"in {mark}" if mark else self.tag


def read_tokens(page: str) -> list:
    """The page's tokens in order: tag names as strings, and ``Block``s of text pieces."""
    out: list = []
    stack: list[Element] = []  # open elements
    elements: list[Element] = []  # all so far
    opaque = roots = articles = 0
    block: Block | None = None
    at, end = 0, len(page)

    def text(piece: str) -> None:
        nonlocal block
        if opaque or (block is None and not piece.strip()):
            return
        if block is None:
            tag = next((e.name for e in reversed(stack) if e.name in BLOCKS), "none")
            block = Block(stack[-1] if stack else None, tag, roots > 0)
            out.append(block)
        block.text.append(piece)
        if stack:
            stack[-1].words += len(piece.split())

    def close(k: int) -> None:
        nonlocal opaque, roots, articles
        for e in stack[k:]:
            opaque -= e.name in OPAQUE
            roots -= e.name in ROOTS
            articles -= e.name == "article"
        del stack[k:]

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if name in BLOCKS:
            block = None
        elif name == "br":
            text(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == name:
                    close(k)
                    break
            if not opaque:
                out.append("/" + name)
            continue
        if name in ("p", "li", "td", "th", "tr", "dt", "dd") or name in BLOCKS:
            for k in range(len(stack) - 1, -1, -1):  # an open paragraph ends where a block begins
                if stack[k].name == "p" or stack[k].name == name != "div" and name in ("li", "td", "th", "tr", "dt", "dd"):
                    close(k)
                    break
                if stack[k].name in BLOCKS:
                    break
        if name == "body":
            for k, e in enumerate(stack):
                if e.name == "head":
                    close(k)
                    break
        if not opaque:
            out.append(name)
        if name in VOID or attributes.endswith("/"):
            continue
        stack.append(Element(name, marker(name, attributes, articles > 0), stack[-1] if stack else None))
        elements.append(stack[-1])
        opaque += name in OPAQUE
        roots += name in ROOTS
        articles += name == "article"
        if name in RAW:
            ends = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = ends.start() if ends else end
    settle(elements)
    return out


def block_text(block: Block) -> str:
    """The block's text: character references decoded, white space runs as one space, trimmed."""
    joined = "".join(block.text)
    return " ".join((html.unescape(joined) if "&" in joined else joined).split())


def count_labels(page: str, into: Counter) -> None:
    """Add the page's (feature, inside) counts, if it is a labelled one. Words in boilerplate
    markers are not counted."""
    names = re.findall(r"<(article|main)\b", page, re.I)
    if len(names) != 1:
        return
    inside = False
    for t in read_tokens(page):
        if isinstance(t, Block):
            if not t.context.startswith("in "):
                into["word " + t.context, t.root] += sum(len(x.split()) for x in t.text)
        else:
            inside = t in ROOTS or inside and t.lstrip("/") not in ROOTS
            into["tag " + t, inside] += 1


class Weights:
    """Scores of tokens: smoothed log odds; words in markers count as nothing, tags are negative."""

    def __init__(self, counts: dict[tuple[str, bool], int]):
        self.counts = dict(counts)
        self.known: dict[str, float] = {}

    def odds(self, feature: str, inside: float, outside: float) -> float:
        return math.log((self.counts.get((feature, True), 0) + inside) / (self.counts.get((feature, False), 0) + outside))

    def word(self, context: str) -> float:
        w = self.known.get(context)
        if w is None:
            # A form or notice inside an article is left out, and must not part what stands around it.
            w = 0.0 if context.startswith("in ") else max(-2.0, min(self.odds("word " + context, 6, 2), 4.0))
            self.known[context] = w
        return w

    def tag(self, name: str) -> float:
        key = "tag " + name
        w = self.known.get(key)
        if w is None:
            w = self.known[key] = max(-1.5, min(-0.05, self.odds(key, 2, 3)))
        return w


def extract(page: str | None, weights: Weights) -> str:
    """The main text of one page: blocks of the best stretch, joined by an empty line."""
    if not page:
        return ""
    tokens = [(t, block_text(t)) if isinstance(t, Block) else (t, None) for t in read_tokens(page)]
    best = total = 0.0
    begin, span = 0, (0, 0)
    for k, (t, text) in enumerate(tokens):
        total += weights.tag(t) if text is None else weights.word(t.context) * len(text.split())
        if total <= 0:
            total, begin = 0.0, k + 1
        elif total > best:
            best, span = total, (begin, k + 1)
    return "\n\n".join(text for t, text in tokens[span[0] : span[1]] if text and weights.word(t.context) > 0)


def fit_weights(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", max_pages: int = LABELLED_PAGES) -> Weights:
    """Weights from at most ``max_pages`` pages (those whose id has the smallest hash). Token counts
    are summed by Spark; only one row per feature and side, a bounded vocabulary, comes back. With
    no labelled page the priors alone decide."""
    prepare(pages.sparkSession)
    rows = pages.select(F.xxhash64(F.col(id_col)).alias("_h"), F.col(html_col).alias("_html"))
    cut = rows.select("_h").orderBy("_h").limit(max_pages).agg(F.max("_h")).first()[0]
    if cut is None:
        return Weights({})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                if page.is_valid:
                    count_labels(page.as_py(), into)
        kept = [(f, i, n) for (f, i), n in into.items() if f.removeprefix("tag ").lstrip("/") in BLOCKS | VOID | {"a", "b", "i", "em", "strong", "span", "code", "u", "s", "small", "sub", "sup"} or f.startswith("word ")]
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*kept, strict=True)], names=["feature", "inside", "n"])

    counts = rows.where(F.col("_h") <= cut).select("_html").mapInArrow(count, "feature string, inside boolean, n long")
    return Weights({(r.feature, r.inside): r.n for r in counts.groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect()})


def extract_text(pages: DataFrame, weights: Weights, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in the column ``out`` (replaced if there; a null or empty page
    gives the empty text). One row per row, whole pages, no shuffle."""
    counts = weights.counts
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = Weights(counts)
        for batch in batches:
            yield pa.array([extract(p.as_py(), fitted) for p in batch], pa.string())

    return pages.withColumn(out, F.arrow_udf(run, "string")(F.col(html_col)))
