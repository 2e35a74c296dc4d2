"""HTML extraction by tag-path ratios.

A page is cut into text blocks, each with the path of block elements above it.
Per path, text length and punctuation per node are aggregated, smoothed over
neighbouring blocks, fused with link density and what the elements say about
themselves, and thresholded.  The blocks of the paths above the threshold make up the text,
with the other blocks of the content container, such as headings.  On a page
with an article or main element that holds the content, blocks outside it are left out.

Defined cases: a null or empty page gives an empty text; so does a page with
no block outside menus, forms and the like.  Unclosed and stray tags are
accepted, a cut-off page gives what it holds.  Raw text (scripts, styles) is
never read as markup.  Repeated rows get equal results; other columns pass
through, and a column named like a result is replaced.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every part is possessive and stops at the next "<", so that no text makes the search backtrack.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>"""
    r"""|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>=]++|=\s*+(?:"[^"]{0,2000}+"|'[^']{0,2000}+')?+)*+)>""",
    re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORDS = re.compile(r"[a-z]+")

# HTML element names by their meaning in the HTML standard.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp
small span strike strong sub sup time tt u var wbr img""".split())
BOILERPLATE = frozenset("""head nav aside footer form fieldset button select option menu dialog script style noscript
template svg math canvas object audio video iframe map""".split())
MAIN = frozenset("article main".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
LIST_ROOTS = frozenset("ul ol dl table select article section div body main aside nav".split())

# Words in class, id and role that name something other than the article.
NOT_CONTENT = frozenset("""ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner
nav navigation navbar menu breadcrumb breadcrumbs pagination pager toolbar sidebar side aside widget related recommended
footer foot header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
subscribe subscription signup login share sharing social comment comments reply replies discussion disqus respond
form search complementary contentinfo skip hidden""".split())
CONTENT = frozenset("article articlebody content main post story entry body text".split())

PUNCTUATION = re.compile(r"[.,;:!?。，…]")

#: A path is content above this share of the mean fused score of the page's paths, weighted by text.
THRESHOLD = 0.5
#: Blocks on either side that smooth a ratio, and the width of the Gaussian.
RADIUS, SIGMA = 2, 1.0
_KERNEL = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)]


class Element:
    """An open block element: its name in the path, and what it says about its text."""

    __slots__ = ("tag", "name", "dead", "main", "path")

    def __init__(self, tag: str, attributes: str, parent: "Element | None"):
        self.tag, self.name = tag, tag
        self.dead = parent is not None and parent.dead or tag in BOILERPLATE
        self.main = parent is not None and parent.main or tag in MAIN
        if tag == "header" and not (parent is not None and parent.main):
            self.dead = True
        if attributes and "=" in attributes:
            for key, *values in ATTRIBUTE.findall(attributes):
                key = key.lower()
                if key in ("class", "id", "role", "itemprop"):
                    value = "".join(values).lower()
                    words = WORDS.findall(value)
                    self.name += "." + "-".join(value.split())
                    if tag not in ("html", "body") and not NOT_CONTENT.isdisjoint(words):
                        self.dead = True
                    if key in ("role", "itemprop") and not CONTENT.isdisjoint(words):
                        self.main = True
                elif key == "hidden" or key == "aria-hidden" and "".join(values).lower() == "true":
                    self.dead = True
        self.path = (parent.path if parent is not None else ()) + (self.name,)


class Block:
    """Text between two block boundaries."""

    __slots__ = ("path", "text", "linked", "main")

    def __init__(self, path: tuple[str, ...], text: str, linked: int, main: bool):
        self.path, self.text, self.linked, self.main = path, text, linked, main


def blocks_of(html: str) -> list[Block]:
    """The page's text blocks outside boilerplate elements, in page order."""
    root = Element("", "", None)
    stack, blocks = [root], []
    parts: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal parts, linked, in_link
        if parts:
            if not stack[-1].dead:
                text = " ".join(unescape("".join(parts)).split())
                if text:
                    blocks.append(Block(stack[-1].path, text, min(linked, len(text)), stack[-1].main))
            parts = []
        linked, in_link = 0, False

    at, end = 0, len(html)
    while at < end:
        token = TOKEN.search(html, at)
        stop = token.start() if token else end
        if stop > at and not stack[-1].dead:
            parts.append(html[at:stop])
            if in_link:
                linked += stop - at
        if not token:
            break
        at = token.end()
        tag = token[2]
        if tag is None:
            if token[0].startswith("<![CDATA["):
                parts.append(token[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not token[1]
            continue
        flush()
        if token[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}", re.I).search(html, at)
            at = close.start() if close else end
            if close:
                at = html.find(">", at) + 1 or end
            continue
        if tag in VOID or token[3].endswith("/") and tag not in ("p", "div"):
            continue
        if tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSES[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in LIST_ROOTS:
                    break
        elif len(stack) > 1 and stack[-1].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
            stack.pop()  # a block element ends an open paragraph or heading
        stack.append(Element(tag, token[3], stack[-1]))
    flush()
    return blocks


def path_scores(blocks: list[Block]) -> dict[tuple[str, ...], float]:
    """The smoothed, fused ratio of every path."""
    nodes: dict[tuple[str, ...], list[float]] = {}
    for b in blocks:
        sums = nodes.setdefault(b.path, [0, 0, 0, 0])
        sums[0] += 1
        sums[1] += len(b.text)
        sums[2] += len(PUNCTUATION.findall(b.text))
        sums[3] += b.linked
    length = [nodes[b.path][1] / nodes[b.path][0] for b in blocks]
    marks = [nodes[b.path][2] / nodes[b.path][0] for b in blocks]

    def smooth(values: list[float]) -> list[float]:
        out = []
        for k in range(len(values)):
            lo, hi = max(0, k - RADIUS), min(len(values), k + RADIUS + 1)
            weights = _KERNEL[lo - k + RADIUS:hi - k + RADIUS]
            out.append(sum(w * v for w, v in zip(weights, values[lo:hi])) / sum(weights))
        return out

    fused: dict[tuple[str, ...], list[float]] = {}
    for b, n, p in zip(blocks, smooth(length), smooth(marks)):
        _, chars, _, links = nodes[b.path]
        prior = 8.0 if b.main else 1.0
        fused.setdefault(b.path, []).append(math.log1p(n) * (1.0 + math.log1p(p)) * (1.0 - links / chars) * prior)
    return {path: sum(v) / len(v) for path, v in fused.items()}


def select(blocks: list[Block]) -> list[Block]:
    """The blocks that make up the article."""
    if not blocks:
        return []
    score = path_scores(blocks)
    total = sum(len(b.text) for b in blocks)
    cut = THRESHOLD * sum(score[b.path] * len(b.text) for b in blocks) / total
    content = [b for b in blocks if score[b.path] >= cut] or blocks
    # The container: the element right above most of the content's text.
    weight: dict[tuple[str, ...], float] = {}
    for b in content:
        weight[b.path[:-1]] = weight.get(b.path[:-1], 0) + score[b.path] * len(b.text)
    container = max(weight, key=lambda path: (weight[path], -len(path)))
    for k, name in enumerate(container):
        if name.split(".")[0] in MAIN:
            container = container[:k + 1]
            break
    while len(container) > 1 and sum(w for p, w in weight.items() if p[:len(container)] == container) < 0.5 * sum(weight.values()):
        container = container[:-1]
    n = len(container)
    wide = n <= 3 and not any(name.split(".")[0] in MAIN for name in container)  # html, body: other blocks must earn it
    kept = set(map(id, content))
    inside = any(name.split(".")[0] in MAIN for name in container)  # article, main: the page says where its text ends
    return [b for b in blocks if not inside and id(b) in kept
            or b.path[:n] == container and (not wide or len(b.path) <= n + 1)]


def main_text(html: str) -> str:
    """The article of a page: its blocks in page order, joined by one space."""
    return " ".join(b.text for b in select(blocks_of(html)))


def extract(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of each page."""

    def batch(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(h) if h else "" for h in pages.to_pylist()], pa.string())

    return pages.withColumn(into, F.arrow_udf(batch, "string")(F.col(html_col).cast("string")))


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length in code points."""
    text: Column = F.col("text")
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length(text).cast("long").alias("n_chars"))
