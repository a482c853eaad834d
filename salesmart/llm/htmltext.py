"""Main text of web pages from flat text blocks, judged by a decision tree.

A page is cut into blocks at block-level tags, without building a document tree.
Each block is described by its words and link density, those of its neighbours,
and a few marks of where it stands. A small decision tree, trained on the
labelled blocks in ``labelled_pages``, tells article text from the rest.

Cases: NULL or empty html gives an empty text; scripts, styles, comments and tags
that are never closed end with the page; pictures, frames, choices and templates that
are never closed end with the block around them, and the blocks in them stay; repeated
rows are judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.labelled_pages import LABELLED_PAGES

# Elements whose content is no markup, and others whose content is no text of the page.
_RAW = "script|style|textarea|title"
_DROPPED = frozenset("svg foreignobject canvas iframe select noscript template annotation annotation-xml".split())
_TOKEN = re.compile(
    rf"<!--(?P<comment>)|<(?P<raw>{_RAW})\b|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|</?[a-z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.I,
)
_RAW_START = {n: re.compile(rf"<{n}\b", re.I) for n in _RAW.split("|")}
_RAW_END = {n: re.compile(rf"</{n}\s*+[^>]*+(?:>|\Z)", re.I) for n in _RAW.split("|")}
_TAG_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*?(?:>|\Z)")
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend "
    "li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OUTSIDE = frozenset("nav footer aside form button label dialog menu fieldset head".split())
_INSIDE = frozenset("article main".split())
_ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++))?""")
_NAMING = frozenset("class id role aria-label".split())
_NO_DISPLAY = re.compile(r"(?i)display\s*:\s*none")
# Class words that say what a wrapper has or lacks, not what it is.
_HAVING = re.compile(r"(?i)(?<![^\s\"'])(?:has|no|with|without)[-_]\S+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline "
    "comment comments consent contentinfo cookie cookies copyright discussion disqus feedback footer "
    "form gdpr header login masthead menu modal nav navbar navigation newsletter notice notification "
    "overlay pagination pager popup promo promoted promotion recommended related replies reply "
    "respond responses search share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription tags toolbar topbar widget".split()
)
_INSIDE_NAMES = frozenset("article content entry main post story text".split())
# Marks by a name end at an article or main tag, and at these names; some names only at
# the tags, and those of texts that have articles of their own, by readers or on other
# pages, not at all.
_ENDING_NAMES = frozenset("article content entry main post story".split())
_ASIDE_NAMES = frozenset("cookie cookies footer newsletter sidebar".split())
_OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising comment comments discussion disqus promoted "
    "recommended related replies reply respond responses sponsored".split()
)
_BY_NAME, _BY_ASIDE, _FIRM = 1, 2, 3
_SENTENCE = re.compile(r"[.!?…。]['\"»”)]*(?:\s|$)")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    marks: tuple[int, ...]
    label: int | None = None


@dataclass
class _Open:
    name: str
    inside: bool
    # 0, or how firmly it is marked as outside of the article.
    outside: int
    label: int | None


@dataclass
class _Drop:
    """An open dropped element, and what stood before it."""

    name: str
    depth: int
    blocks: int
    parts: list[str]
    linked: list[str]
    links: int
    # A block has begun in it, which stays if the element is never closed.
    held: bool = False


@dataclass
class _Cutter:
    """Collects blocks while tags go by."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    links: int = 0
    drops: list[_Drop] = field(default_factory=list)

    def text(self, raw: str) -> None:
        if raw and (not self.drops or self.drops[-1].held):
            self.parts.append(raw)
            if self.links:
                self.linked.append(raw)

    def flush(self) -> None:
        if not self.parts:
            return
        words = unescape("".join(self.parts)).split()
        if words:
            linked = len(unescape(" ".join(self.linked)).split())
            at = self.stack[-1] if self.stack else _Open("", False, 0, None)
            heading = any(o.name in _HEADINGS for o in self.stack[-3:])
            item = any(o.name in ("li", "td", "th", "dt", "dd", "option") for o in self.stack[-3:])
            text = " ".join(words)
            marks = (at.inside, at.outside > 0, heading, item, bool(_SENTENCE.search(text)), "©" in text)
            self.blocks.append(
                Block(text, len(words), min(linked, len(words)), tuple(map(int, marks)), at.label)
            )
        self.parts, self.linked = [], []

    def drop(self, name: str) -> None:
        self.drops.append(
            _Drop(name, len(self.stack), len(self.blocks), self.parts, self.linked, self.links)
        )
        self.parts, self.linked = [], []

    def dropped(self, name: str) -> None:
        """The end tag of a dropped element: all in it goes."""
        for k in range(len(self.drops) - 1, -1, -1):
            at = self.drops[k]
            if at.name == name:
                del self.drops[k:], self.blocks[at.blocks :], self.stack[at.depth :]
                self.parts, self.linked, self.links = at.parts, at.linked, at.links
                return

    def undrop(self) -> None:
        """The innermost dropped element has no end tag: blocks that began in it stay."""
        at = self.drops.pop()
        if at.held:
            self.flush()
            if at.parts:
                inner, deeper = self.blocks[at.blocks :], self.stack[at.depth :]
                del self.blocks[at.blocks :], self.stack[at.depth :]
                self.parts, self.linked = at.parts, at.linked
                self.flush()
                self.blocks += inner
                self.stack += deeper
        else:
            self.parts, self.linked, self.links = at.parts, at.linked, at.links

    def start(self, name: str, rest: str) -> None:
        if name in _DROPPED:
            if not rest.endswith("/"):
                self.drop(name)
            return
        if self.drops and name in _BLOCKS:
            if self.drops[-1].name == "select" and name == "option":
                return
            if self.drops[-1].name == "svg":
                # As in browsers: no picture holds a block of text.
                self.undrop()
            else:
                self.drops[-1].held = True
        if name == "a":
            self.links = 1
        if name == "br":
            self.text(" ")
        if name not in _BLOCKS:
            return
        self.flush()
        if name in _VOID:
            return
        if name == "p":
            self.close("p", within=_BLOCKS - {"p"})
        above = self.stack[-1] if self.stack else _Open("", False, 0, None)
        names: set[str] = set()
        label, hidden = above.label, False
        for key, value in _ATTRIBUTE.findall(rest) if rest else ():
            key = key.lower()
            if key in _NAMING:
                value = _HAVING.sub(" ", value) if key == "class" else value
                names |= {p.lower() for p in _PARTS.findall(value)}
            elif key == "hidden":
                hidden = True
            elif key == "aria-hidden":
                hidden |= value.strip("\"' ").lower() == "true"
            elif key == "style":
                hidden |= bool(_NO_DISPLAY.search(value))
            elif key == "data-main":
                label = int(value.strip("\"'") == "1")
        other = not names.isdisjoint(_OTHER_NAMES)
        outside = 0
        if name in _OUTSIDE or (name == "header" and not above.inside) or other:
            outside = _FIRM
        elif not names.isdisjoint(_ASIDE_NAMES):
            outside = _BY_ASIDE
        elif not names.isdisjoint(_OUTSIDE_NAMES):
            outside = _BY_NAME
        if name in ("article", "main", "body", "html"):
            # The whole of a page is not an advert because of a class of its body.
            outside = 0
        inherited = above.outside
        if name in _INSIDE and not other:
            ended = _BY_ASIDE
        else:
            ended = 0 if outside or names.isdisjoint(_ENDING_NAMES) else _BY_NAME
        if inherited <= ended:
            inherited = 0
        outside = _FIRM if hidden else max(outside, inherited)
        inside = above.inside or name in _INSIDE or not names.isdisjoint(_INSIDE_NAMES)
        self.stack.append(_Open(name, inside, outside, label))

    def end(self, name: str) -> None:
        if name in _DROPPED:
            self.dropped(name)
            return
        if name == "a":
            self.links = 0
        if name in _BLOCKS:
            self.close(name)

    def close(self, name: str, within: frozenset[str] = frozenset()) -> None:
        # A paragraph that begins in a dropped element ends none outside of it.
        least = self.drops[-1].depth if within and self.drops else 0
        for k in range(len(self.stack) - 1, least - 1, -1):
            if self.stack[k].name == name:
                while self.drops and self.drops[-1].depth > k:
                    self.undrop()
                self.flush()
                del self.stack[k:]
                return
            if self.stack[k].name in within:
                break
        if not self.drops or self.drops[-1].held:
            self.flush()


def cut(html: str) -> list[Block]:
    """Text blocks of a page in order."""
    cutter, done = _Cutter(), 0
    closes: dict[str, tuple[int, int]] = {}
    found = _TOKEN.search(html)
    while found:
        cutter.text(html[done : found.start()])
        done = found.end()
        if found["comment"] is not None:
            close = html.find("-->", done)
            done = close + 3 if close >= 0 else len(html)
        elif found["raw"]:
            if done < len(html) and html[done] not in " \t\r\n\f/>":
                # A name that only begins like it, such as <title-bar>.
                done = _TAG_END.match(html, done).end()
            else:
                name = found["raw"].lower()
                if name not in closes or closes[name][0] < done:
                    close = _RAW_END[name].search(html, done)
                    closes[name] = close.span() if close else (len(html), len(html))
                tag = html.find(">", done)
                if tag >= 0 and html[tag - 1] == "/":
                    # Empty, as in XHTML, unless its end tag comes before the next of its name.
                    other = _RAW_START[name].search(html, tag, closes[name][0])
                    empty = other or closes[name][0] == len(html)
                else:
                    empty = False
                done = tag + 1 if empty else closes[name][1]
        elif found["name"]:
            name = found["name"].lower()
            (cutter.end(name) if found["end"] else cutter.start(name, found["rest"]))
        found = _TOKEN.search(html, done)
    cutter.text(html[done:])
    while cutter.drops:
        cutter.undrop()
    cutter.flush()
    return cutter.blocks


FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after",
    "link_density_after", "inside", "outside", "heading", "item", "sentence", "copyright",
)


def features(blocks: list[Block]) -> np.ndarray:
    words = np.array([0, *(b.words for b in blocks), 0], float)
    density = np.array([0, *(b.linked / b.words for b in blocks), 0], float)
    marks = np.array([b.marks for b in blocks], float).reshape(len(blocks), -1)
    near = [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]]
    return np.column_stack([*near, marks])


@dataclass
class Tree:
    """A binary decision tree; leaves have feature -1."""

    feature: np.ndarray
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    main: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        while (inner := self.feature[at] >= 0).any():
            value = rows[np.arange(len(rows)), np.maximum(self.feature[at], 0)]
            step = np.where(value <= self.limit[at], self.low[at], self.high[at])
            at = np.where(inner, step, at)
        return self.main[at]


def train(rows: np.ndarray, labels: np.ndarray, depth: int = 6, least: int = 2) -> Tree:
    """Splits by the Gini index; ties go to the first feature and the smallest limit."""
    nodes: list[list] = []

    def impurity(y: np.ndarray) -> float:
        share = y.mean()
        return 2 * share * (1 - share) * len(y)

    def grow(x: np.ndarray, y: np.ndarray, left: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, bool(y.mean() > 0.5)])
        best = impurity(y) - 1e-9
        split = None
        for f in range(x.shape[1]) if left else ():
            values = np.unique(x[:, f])
            for limit in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= limit
                if min(low.sum(), (~low).sum()) >= least:
                    cost = impurity(y[low]) + impurity(y[~low])
                    if cost < best - 1e-9:
                        best, split = cost, (f, limit, low)
        if split:
            f, limit, low = split
            nodes[at][:2] = f, limit
            nodes[at][2] = grow(x[low], y[low], left - 1)
            nodes[at][3] = grow(x[~low], y[~low], left - 1)
        return at

    grow(rows, labels, depth)
    columns = list(zip(*nodes))
    return Tree(*(np.array(c) for c in columns))


def trained_tree(pages: tuple[str, ...] = LABELLED_PAGES) -> Tree:
    """The tree for pages whose blocks carry ``data-main`` (0 or 1)."""
    cuts = [cut(p) for p in pages]
    rows = np.concatenate([features(blocks) for blocks in cuts])
    labels = np.array([b.label for blocks in cuts for b in blocks])
    return train(rows, labels.astype(float))


def main_text(html: str, tree: Tree) -> str:
    blocks = cut(html)
    if not blocks:
        return ""
    return "\n\n".join(b.text for b, main in zip(blocks, tree.predict(features(blocks))) if main)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    judge = tree or trained_tree()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = [main_text(h.as_py() or "", judge) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return narrow.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
