"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into blocks of text at its block-level tags; inline tags and line breaks stay
inside a block. Each block is described by its words and link density, those of its
neighbours, and by the elements around it. A decision tree, grown from the small labelled
table below, says which blocks are article text. Kept blocks are joined in page order by an
empty line; nothing else is dropped or cut.

Null and empty pages, and pages without article text, give an empty text. Elements that are
never closed end with what encloses them; a tag that the end of the page cuts off is no text.
Repeated rows each get their own result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RESULT = "page_id bigint, url string, text string, n_chars bigint"
PAGE_RUN = 500

# Names of elements, and words in class, id and role that tell boilerplate
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HIDDEN = frozenset("head noscript template svg select option button canvas object datalist dialog map audio video math".split())
CONTENT = frozenset("article main".split())
BOILERPLATE = frozenset("nav header footer aside form menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
BODY = frozenset("body article main nav header footer aside section div p h1 h2 h3 ul ol table form".split())
HINTS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "dialog disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notification pager pagination "
    "popup privacy promo recommended related replies reply respond rss search share sharing sidebar signup social sponsor sponsored subscribe tags "
    "teaser toolbar warning widget widgets alert complementary contentinfo".split()
)

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|textarea|iframe|noembed|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-z][a-z0-9:-]*)([^>]*)>|<[!?][^>]*(?:>|\Z)|</?[a-z][^>]*\Z",
    re.IGNORECASE | re.DOTALL,
)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN_ATTRIBUTE = re.compile(r"\shidden(?:\s|=|$)|display\s*:\s*none", re.IGNORECASE)
SPACES = re.compile(r"\s+")


class Block:
    __slots__ = ("bad", "content", "heading", "links", "text", "words")

    def __init__(self, text: str, words: int, links: int, content: int, bad: int, heading: int):
        self.text, self.words, self.links = text, words, links
        self.content, self.bad, self.heading = content, bad, heading


def hinted(attributes: str) -> bool:
    names = " ".join("".join(m) for m in NAMES.findall(attributes))
    return any(part in HINTS for part in re.split(r"[\s_-]+", names.lower()))


def blocks(page: str) -> list[Block]:
    """The texts between block-level tags, with what stands around each."""
    out: list[Block] = []
    # open elements: name, content, boilerplate, hidden
    stack: list[tuple[str, int, int, bool]] = []
    pieces: list[str] = []
    linked: list[str] = []
    in_link = 0

    def flush() -> None:
        text = SPACES.sub(" ", "".join(pieces)).strip()
        if text:
            top = stack[-1] if stack else ("", 0, 0, False)
            heading = int(any(e[0] in HEADINGS for e in stack[-2:]))
            out.append(Block(text, text.count(" ") + 1, len("".join(linked).split()), top[1], top[2], heading))
        pieces.clear()
        linked.clear()

    def add(raw: str) -> None:
        if raw and not (stack and stack[-1][3]):
            text = html.unescape(raw)
            pieces.append(text)
            if in_link:
                linked.append(text + " ")

    at = 0
    for m in TAG.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        closing, attributes = (m[2] or m[5]) == "/", (m[4] if m[3] else m[7]) or ""
        if name == "a":
            in_link = 0 if closing else 1
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    in_link = 0
                    break
            continue
        if name in BODY:
            while stack and stack[-1][0] == "head":
                stack.pop()
            while stack and stack[-1][0] == "p":
                stack.pop()
        while stack and stack[-1][0] in CLOSES_ITSELF.get(name, ()):
            stack.pop()
        if name in VOID or attributes.endswith("/") and name in HIDDEN:
            continue
        content, bad, hidden = stack[-1][1:] if stack else (0, 0, False)
        whole = name in CONTENT or name in ("html", "body")
        # an article's own header is part of it
        if name in BOILERPLATE and not (name == "header" and content) or hinted(attributes) and (not whole or name == "article" and bool(content)):
            bad += 1
        stack.append((name, int(content or name in CONTENT), bad, hidden or name in HIDDEN or bool(HIDDEN_ATTRIBUTE.search(" " + attributes))))
    add(page[at:])
    flush()
    return out


FEATURES = ("words", "link density", "words before", "density before", "words after", "density after", "in content", "boilerplate around", "heading", "page has content")


def described(found: list[Block]) -> np.ndarray:
    """A row of features for each block of a page."""
    table = np.zeros((len(found), len(FEATURES)))
    if not found:
        return table
    words = np.array([b.words for b in found], float)
    density = np.minimum(1.0, np.array([b.links for b in found]) / words)
    table[:, 0], table[:, 1] = words, density
    table[1:, 2], table[1:, 3] = words[:-1], density[:-1]
    table[:-1, 4], table[:-1, 5] = words[1:], density[1:]
    table[:, 6] = [b.content for b in found]
    table[:, 7] = [b.bad for b in found]
    table[:, 8] = [b.heading for b in found]
    table[:, 9] = table[:, 6].max()
    return table


#: Labelled pages: (place, words, linked words, is article text) of each block in page order.
#: Places: c in an article or main element, b in boilerplate, cb in boilerplate within an
#: article, x in neither; h is a heading.
LABELLED = [
    [("b", 1, 1, 0), ("b", 2, 2, 0), ("b", 1, 1, 0), ("b", 8, 0, 0), ("ch", 7, 0, 1), ("c", 40, 0, 1), ("c", 1, 0, 1), ("c", 120, 3, 1), ("c", 6, 6, 1), ("cb", 9, 0, 0), ("c", 30, 0, 1), ("b", 12, 0, 0)],
    [("b", 3, 3, 0), ("b", 30, 0, 0), ("ch", 4, 0, 1), ("c", 2, 0, 1), ("c", 3, 0, 1), ("c", 15, 15, 1), ("cb", 60, 0, 0), ("cb", 4, 4, 0), ("b", 25, 2, 0), ("b", 70, 0, 0), ("x", 14, 0, 0), ("x", 40, 0, 0)],
    [("x", 5, 5, 0), ("c", 90, 0, 1), ("ch", 3, 0, 1), ("c", 1, 1, 1), ("c", 200, 9, 1), ("cbh", 2, 0, 0), ("cb", 35, 0, 0), ("cb", 80, 1, 0), ("xh", 2, 0, 0), ("x", 9, 9, 0), ("x", 22, 1, 0)],
    [("x", 1, 1, 0), ("x", 2, 2, 0), ("x", 1, 1, 0), ("xh", 6, 0, 1), ("x", 60, 1, 1), ("x", 45, 0, 1), ("x", 12, 0, 1), ("x", 80, 2, 1), ("x", 3, 3, 0), ("x", 2, 2, 0), ("x", 5, 2, 0)],
    [("b", 2, 2, 0), ("x", 4, 4, 0), ("xh", 9, 0, 1), ("x", 25, 0, 1), ("x", 8, 0, 1), ("x", 33, 1, 1), ("xh", 3, 0, 1), ("x", 55, 0, 1), ("b", 40, 0, 0), ("b", 20, 20, 0), ("x", 6, 6, 0)],
    [("b", 50, 0, 0), ("b", 16, 1, 0), ("bh", 3, 0, 0), ("x", 18, 0, 1), ("x", 70, 0, 1), ("b", 5, 0, 0), ("x", 28, 2, 1), ("x", 10, 9, 0), ("x", 7, 7, 0), ("b", 110, 4, 0)],
    [("x", 3, 3, 0), ("x", 3, 3, 0), ("x", 2, 2, 0), ("x", 4, 4, 0), ("x", 6, 5, 0), ("b", 9, 0, 0)],
    [("x", 35, 0, 1), ("x", 5, 0, 1), ("x", 50, 0, 1), ("x", 1, 1, 0), ("x", 1, 1, 0)],
    [("ch", 12, 0, 1), ("c", 400, 0, 1), ("c", 90, 0, 1), ("c", 2, 0, 1), ("c", 300, 0, 1), ("c", 75, 0, 1)],
    [("b", 6, 6, 0), ("ch", 5, 0, 1), ("c", 70, 70, 1), ("c", 160, 80, 1), ("c", 1, 0, 1), ("c", 88, 0, 1), ("x", 45, 0, 0), ("x", 130, 0, 0), ("x", 3, 0, 0)],
    [("x", 95, 0, 0), ("x", 28, 28, 0), ("c", 150, 0, 1), ("c", 33, 0, 1), ("c", 4, 4, 1), ("c", 260, 12, 1), ("x", 66, 3, 0), ("xh", 4, 0, 0), ("x", 110, 0, 0)],
    [("xh", 8, 0, 0), ("x", 70, 0, 0), ("ch", 9, 0, 1), ("c", 34, 0, 1), ("c", 500, 0, 1), ("c", 20, 18, 1), ("c", 3, 0, 1), ("x", 15, 15, 0)],
    [("c", 45, 0, 1)], [("c", 250, 0, 1), ("c", 41, 0, 1)], [("x", 50, 0, 0), ("c", 40, 0, 1)], [("c", 80, 2, 1), ("x", 120, 0, 0)],
    [("x", 90, 0, 1), ("x", 100, 0, 1), ("x", 35, 0, 1), ("x", 64, 0, 1), ("x", 48, 1, 1)],
    [("x", 55, 0, 1), ("x", 45, 4, 1), ("x", 80, 10, 1), ("x", 60, 9, 1), ("x", 70, 5, 1), ("x", 6, 6, 0), ("x", 30, 28, 0), ("x", 40, 36, 0)],
    [("c", 1, 0, 1)], [("c", 2, 2, 1)], [("x", 20, 0, 1)], [("x", 3, 3, 0)], [("b", 20, 0, 0)],
]


def training_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in LABELLED:
        found = [Block("", words, links, int("c" in where), int("b" in where), int("h" in where)) for where, words, links, _ in page]
        rows.append(described(found))
        labels += [label for *_, label in page]
    return np.concatenate(rows), np.array(labels, float)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 7):
    """A classification tree: (feature, threshold, left, right) or the share of article text."""
    if depth == 0 or len(set(y)) == 1:
        return float(y.mean())
    best = (2.0 * y.mean() * (1 - y.mean()) * len(y) - 1e-9, None, None)
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for threshold in (values[1:] + values[:-1]) / 2:
            left = x[:, k] < threshold
            impurity = sum(2.0 * p.mean() * (1 - p.mean()) * len(p) for p in (y[left], y[~left]))
            if impurity < best[0]:
                best = (impurity, k, threshold)
    if best[1] is None:
        return float(y.mean())
    left = x[:, best[1]] < best[2]
    return (best[1], best[2], grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1))


def judged(tree, x: np.ndarray) -> np.ndarray:
    """Share of article text in the leaf of each row."""
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    k, threshold, low, high = tree
    left = x[:, k] < threshold
    out = np.empty(len(x))
    out[left], out[~left] = judged(low, x[left]), judged(high, x[~left])
    return out


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = judged(tree, described(found)) >= 0.5
    return "\n\n".join(b.text for b, k in zip(found, keep.tolist(), strict=True) if k)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length for every page."""
    tree = grow(*training_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGE_RUN):
                piece = batch.slice(at, PAGE_RUN)
                texts = [main_text(page, tree) for page in piece.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, RESULT)
