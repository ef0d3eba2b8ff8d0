"""Main text of web pages from flat text blocks and a decision tree.

The markup is read once into blocks, the runs of text between block tags. A
block is described by its words, the share of them in links, the same of the blocks
before and after it, and what the elements around it are or are called. A small
decision tree, trained in numpy on the labelled pages of ``html_table``, tells
main text from the rest.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .html_table import PAGES

#: A comment, a declaration, a tag (quoted values may hold ``>``), or a tag that the end of the page cuts off.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*+)(?:>|\Z)|</?\Z", re.S)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
PART = re.compile(r"[a-z]+")

#: Elements whose content is no text of the page. Those of the second set end with what is around them if they are not closed.
UNREAD = frozenset("script style noscript template iframe textarea title svg object select canvas audio video".split())
BROKEN_OFF = frozenset("svg object select canvas audio video".split())
#: Elements that go with the text around them.
INLINE = frozenset(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr
    math mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup mover munder munderover mstyle mpadded semantics""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and names around a block that tell what it is.
OTHER_ELEMENTS = frozenset("nav footer aside form button menu dialog head".split())
OTHER_NAMES = frozenset(
    """ad ads advert advertisement banner sponsor sponsored promo nav navigation navbar menu breadcrumb breadcrumbs pagination
    sidebar widget related recommended comment comments replies respond disqus cookie cookies consent gdpr notice newsletter
    subscribe popup modal footer copyright topbar masthead share social login search""".split())
MAIN_ELEMENTS = frozenset("article main".split())
MAIN_NAMES = frozenset("article content main post entry story maincontent".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag ends when it is innermost; every other block tag ends the last set.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
    "option": {"option"}}
ENDED = BROKEN_OFF | {"p"}
#: First parts of class names that say what a page has elsewhere.
BESIDE = frozenset("has with without no".split())


@dataclass
class Block:
    start: int
    text: str
    words: int
    linked: int
    other: bool
    main: bool
    heading: bool


def _kind(name: str, rest: str, inside_main: bool) -> tuple[bool, bool]:
    """Whether an element stands for other content, and whether for main content."""
    other = name in OTHER_ELEMENTS or (name == "header" and not inside_main)
    main = name in MAIN_ELEMENTS
    if rest and name not in ("body", "html"):
        for value in NAMED.findall(rest):
            for word in value.lower().split():
                parts = PART.findall(word)
                if parts and parts[0] not in BESIDE:
                    other = other or not OTHER_NAMES.isdisjoint(parts)
                    main = main or not MAIN_NAMES.isdisjoint(parts)
    return other, main and not other


def blocks(page: str) -> list[Block]:
    """Text blocks in page order: references decoded, white space as one space, empty ones left out.

    One pass whose work is linear in the page, however deep it is nested: an open
    element carries what it and all around it stand for.
    """
    out: list[Block] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool]] = []
    open_names: dict[str, int] = {}
    # Where the search for an end tag came to the end of the page: later ones need no search.
    unclosed: set[str] = set()
    begun, heading, in_link, at = 0, False, 0, 0

    def push(name: str, other: bool, main: bool) -> None:
        above = stack[-1] if stack else ("", False, False)
        stack.append((name, above[1] or other, above[2] or main))
        open_names[name] = open_names.get(name, 0) + 1

    def pop() -> None:
        open_names[stack.pop()[0]] -= 1

    def finish(to: int) -> None:
        nonlocal text, linked, begun
        if text:
            words = entities.unescape("".join(text)).split()
            if words:
                _, other, main = stack[-1] if stack else ("", False, False)
                out.append(Block(begun, " ".join(words), len(words), len(entities.unescape("".join(linked)).split()), other, main and not other, heading))
            text, linked = [], []
        begun = to

    while at < len(page):
        m = TOKEN.search(page, at)
        stop = m.start() if m else len(page)
        if stop > at:
            text.append(page[at:stop])
            if in_link:
                linked.append(page[at:stop])
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing, rest = bool(m["end"] or m["end2"]), m["rest"] or m["rest2"] or ""
        if not closing and name in UNREAD:
            end = None
            if not rest.endswith("/"):
                if name not in unclosed:
                    end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if end:
                    at = end.end()
                elif name not in BROKEN_OFF:
                    at = len(page)
                else:
                    unclosed.add(name)
                    finish(m.start())
                    push(name, True, False)
            text.append(" ")
            continue
        if name in INLINE:
            if name == "br":
                text.append(" ")
            elif name == "a":
                in_link = 0 if closing else 1
                linked.append(" ")
            continue
        finish(m.start())
        heading = not closing and name in HEADINGS
        in_link = 0 if name in HEADINGS or name in ("p", "li", "div", "td") else in_link
        if closing:
            if open_names.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
        elif name not in VOID and not rest.endswith("/"):
            while stack and (stack[-1][0] in ENDED or stack[-1][0] in ENDS.get(name, ())):
                pop()
            push(name, *_kind(name, rest, bool(stack) and stack[-1][2]))
    finish(len(page))
    return out


def features(found: list[Block]) -> np.ndarray:
    """A row per block: own, previous and next words and link density, then the flags."""
    n = len(found)
    words = np.array([0, *(b.words for b in found), 0], dtype=np.float64)
    density = np.array([0, *(min(b.linked / b.words, 1) for b in found), 0], dtype=np.float64)
    flags = np.array([(b.other, b.main, b.heading, "©" in b.text[:2]) for b in found], dtype=np.float64).reshape(n, 4)
    near = np.stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]], axis=1)
    return np.concatenate([near, flags], axis=1)


# The tree -------------------------------------------------------------------------

#: ``(feature, threshold, at most, above)`` of a branch, or the label of a leaf.
Node = tuple | int


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> Node:
    """Splits by Gini impurity; of equal splits the first feature and lowest threshold."""
    label = int(2 * y.sum() > len(y))
    if depth == 0 or y.min() == y.max():
        return label
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y) + 1)
        cut = np.flatnonzero((v[1:] > v[:-1]) & (n[:-1] >= least) & (len(y) - n[:-1] >= least))
        if not len(cut):
            continue
        a, b = ones[cut] / n[cut], (ones[-1] - ones[cut]) / (len(y) - n[cut])
        impurity = n[cut] * a * (1 - a) + (len(y) - n[cut]) * b * (1 - b)
        i = int(impurity.argmin())
        if best is None or impurity[i] < best[0] - 1e-12:
            best = (impurity[i], f, (v[cut[i]] + v[cut[i] + 1]) / 2)
    if best is None:
        return label
    below = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[below], y[below], depth - 1, least), grow(x[~below], y[~below], depth - 1, least)


def classify(node: Node, x: np.ndarray) -> np.ndarray:
    if isinstance(node, int):
        return np.full(len(x), node, dtype=bool)
    f, threshold, low, high = node
    return np.where(x[:, f] <= threshold, classify(low, x), classify(high, x))


def labelled(pages: str = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages."""
    xs, ys = [], []
    for page in pages.split("\n\n"):
        markup, starts, labels = "", [], []
        for line in page.splitlines():
            starts.append(len(markup))
            labels.append(int(line[0]))
            line = re.sub(r"\{a:(\d+)\}", r'<a href="/l">{\1}</a>', line[2:])
            markup += re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), line)
        found = blocks(markup)
        xs.append(features(found))
        ys += [labels[int(np.searchsorted(starts, b.start, side="right")) - 1] for b in found]
    return np.concatenate(xs), np.array(ys)


def train() -> Node:
    return grow(*labelled())


def main_text(page: str | None, tree: Node) -> str:
    """Main blocks of a page, one per line; a NULL or empty page has none."""
    found = blocks(page) if page else []
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, classify(tree, features(found))) if keep)


def extract(html: Column, tree: Node | None = None) -> Column:
    tree = train() if tree is None else tree

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, tree) for page in batch], dtype=object)

    return run(html)


def extract_pages(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every page.

    The whole page is read, at a cost linear in it also where elements nest deeply or do
    not close. NULL and empty pages give the empty text; repeated rows give repeated
    results; other columns are not read.
    """
    found = pages.select(*keep, extract(F.col(html)).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
