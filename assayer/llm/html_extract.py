"""Main text of web pages by a tree-structured graphical model.

A page is parsed into its element tree. Every element has a hidden state, content or not, with
a potential from its own features (tag, words of its class, id and role and of the nearest named
element above, the landmark it lies in, text and link lengths, share of the page's text, paragraphs
beside and below it) and, for every edge, a potential for the states of parent and child that depends
on the kind of the child's tag. Sum-product messages pass once upward and once downward and give
exact marginals. Potentials are trained from labelled pages: own potentials by logistic regression,
edge potentials from counts. An edge's influence is bounded, so that no depth of wrappers outweighs
what a paragraph says of itself.

An element's text belongs to the nearest block around it; blocks whose element has a marginal
over one half are the article. Character references are decoded, white space inside a block
becomes one space, blocks are joined by line feeds in page order. Scripts, styles, templates and
the head hold no text. Unclosed and misnested tags are read as browsers do in the common cases:
a block closes an open paragraph, and a closing tag closes what is open inside it.

Null and empty pages, and pages without content, give an empty text. Broken markup never fails.
Rows are independent; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.subwords import live

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
SILENT = frozenset("head script style template noscript svg object iframe canvas audio video select textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table caption tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "tbody", "tfoot", "thead", "tr", "caption", "option", "optgroup", "legend"}
# An opening tag ends these open ones, up to the elements that hold them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
SPACE = re.compile(r"\s+")
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",  # a quote that never closes
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_WORDS = re.compile(r"[a-z]+")


class Page:
    """The element tree in document order: tag, parent, name words, and pieces of text."""

    def __init__(self, html: str | None):
        self.tags, self.parents, self.names, self.hidden = ["#page"], [-1], [()], [False]
        self.texts: list[tuple[int, str]] = []  # (element, decoded text), in page order
        if html:
            self._parse(html)

    def _parse(self, html: str) -> None:
        open_: list[int] = [0]
        at, size = 0, len(html)
        while at < size:
            found = TAG.search(html, at)
            if found is None:
                self._text(open_[-1], html[at:])
                return
            if found.start() > at:
                self._text(open_[-1], html[at : found.start()])
            at = found.end()
            tag = found.group(2) or found.group(5)
            if tag is None:
                continue
            tag = tag.lower()
            attributes = found.group(3) or found.group(6) or ""
            if found.group(1) or found.group(4):
                self._close(open_, tag)
                continue
            if tag in CLOSES_P:
                self._end(open_, {"p"}, {"table", "td", "th", "button", "article", "section", "div", "main", "aside"})
            if tag in ENDS:
                self._end(open_, *ENDS[tag])
            node = self._element(tag, open_[-1], attributes)
            if tag in VOID:
                if tag in ("br", "hr"):
                    self.texts.append((open_[-1], " "))
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*(?:>|/|\Z)", re.I).search(html, at)
                stop = end.start() if end else size
                self._text(node, html[at:stop])
                at = html.find(">", stop) + 1 if end and html.find(">", stop) >= 0 else size if not end else end.end()
                continue
            if not (attributes.rstrip().endswith("/") and tag in ("svg", "path", "math")):
                open_.append(node)

    def _element(self, tag: str, parent: int, attributes: str) -> int:
        words: list[str] = []
        hidden = self.hidden[parent] or tag in SILENT
        if attributes and attributes.strip():
            for m in ATTRIBUTE.finditer(attributes):
                name = m.group(1).lower()
                value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
                if name in ("class", "id", "role", "itemprop", "aria-label"):
                    words += NAME_WORDS.findall(value)
                elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "")):
                    hidden = True
        self.tags.append(tag)
        self.parents.append(parent)
        self.names.append(tuple(words))
        self.hidden.append(hidden)
        return len(self.tags) - 1

    def _text(self, node: int, raw: str) -> None:
        if not self.hidden[node]:
            self.texts.append((node, unescape(raw)))

    def _end(self, open_: list[int], ended: set[str], stop: set[str]) -> None:
        for k in range(len(open_) - 1, 0, -1):
            tag = self.tags[open_[k]]
            if tag in ended:
                del open_[k:]
                return
            if tag in stop:
                return

    def _close(self, open_: list[int], tag: str) -> None:
        for k in range(len(open_) - 1, 0, -1):
            if self.tags[open_[k]] == tag:
                del open_[k:]
                return

    def block_of(self) -> list[int]:
        """The nearest block element at or above every element."""
        out: list[int] = []
        for node, tag in enumerate(self.tags):
            out.append(node if node == 0 or tag in BLOCK else out[self.parents[node]])
        return out


FEATURES = 1 << 14


def _feature(name: str) -> int:
    value = 2_166_136_261
    for c in name:
        value = ((value ^ ord(c)) * 16_777_619) & 0xFFFF_FFFF
    return (value ^ value >> 13) % FEATURES


_KNOWN: dict[str, int] = {}


def _known(name: str) -> int:
    """:func:`_feature`, remembered for short names up to a fixed number."""
    if name not in _KNOWN:
        if len(_KNOWN) > 10_000 or len(name) > 40:
            return _feature(name)
        _KNOWN[name] = _feature(name)
    return _KNOWN[name]


#: Elements that say what lies in them; the nearest one above is a feature.
LANDMARKS = frozenset("article main nav aside header footer form dialog".split())

#: Kinds of tags; every kind has an edge potential of its own.
KINDS = (
    frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption dl dt dd".split()),
    frozenset("div section center hgroup details summary main article".split()),
    frozenset("ul ol li menu table thead tbody tfoot tr td th caption".split()),
    LANDMARKS - {"main", "article"},
)


def tag_kind(tag: str) -> int:
    """The number of the tag's kind; what is in none is inline."""
    return next((k for k, tags in enumerate(KINDS) if tag in tags), len(KINDS))


def page_features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """``(element, feature)`` pairs, all of value 1."""
    n = len(page.tags)
    own, link = [0] * n, [0] * n
    inside_link = [False] * n
    for node in range(1, n):
        inside_link[node] = page.tags[node] == "a" or inside_link[page.parents[node]]
    for node, text in page.texts:
        size = len(text.strip())
        own[node] += size
        if inside_link[node]:
            link[node] += size
    for node in range(n - 1, 0, -1):  # children come after their parents
        own[page.parents[node]] += own[node]
        link[page.parents[node]] += link[node]
    paragraphs, headings = [0] * n, [0] * n  # among the children
    landmark, named = ["none"] * n, [()] * n  # the nearest above
    for node in range(1, n):
        above, tag = page.parents[node], page.tags[node]
        paragraphs[above] += tag == "p"
        headings[above] += tag in ("h1", "h2", "h3")
        landmark[node] = page.tags[above] if page.tags[above] in LANDMARKS else landmark[above]
        named[node] = page.names[above] or named[above]
    whole = max(own[0], 1)
    few = lambda count: min(count, 7).bit_length()
    rows, cols = [], []
    for node in range(n):
        size, tag, above = own[node], page.tags[node], max(page.parents[node], 0)
        kind = tag_kind(tag)
        found = {
            _known("bias"), _known(f"tag {tag}"), *(_known(f"name {w}") for w in page.names[node]),
            _known(f"size {min(size, 4096).bit_length()}"),
            _known(f"links {'none' if size == 0 else 5 * link[node] // size}"),
            _known(f"in {landmark[node]}"), _known(f"kind {kind} in {landmark[node]}"),
            *(_known(f"under {w}") for w in named[node]),
            _known(f"share {kind} {4 * size // whole}"),
            _known(f"share above {4 * own[above] // whole} links {4 * link[above] // max(own[above], 1)}"),
            _known(f"beside {kind} {few(paragraphs[above])} {few(headings[above])}"),
            _known(f"below {kind} {few(paragraphs[node])} {few(headings[node])}"),
        }
        rows += [node] * len(found)
        cols += found
    return np.array(rows, np.int32), np.array(cols, np.int32)


@dataclass(frozen=True)
class TreeModel:
    """Log odds per feature, and ``edge[child's kind, parent state, child state]`` in logs."""

    weights: np.ndarray
    edge: np.ndarray

    def marginals(self, parents: np.ndarray, own: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Probability of content of every element; ``own`` has its log odds, parents come first.

        Elements of equal depth pass their messages together, up from the deepest and down again.
        """
        depth = np.zeros(len(parents), np.int32)
        for node, parent in enumerate(parents.tolist()):
            if parent >= 0:
                depth[node] = depth[parent] + 1
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        score = np.stack([-own / 2, own / 2], axis=1)
        up = np.zeros_like(score)  # message from an element to its parent
        gathered = score.copy()
        for level in reversed(levels[1:]):
            both = self.edge[kinds[level]] + gathered[level][:, None, :]
            up[level] = np.logaddexp(both[:, :, 0], both[:, :, 1])
            np.add.at(gathered, parents[level], up[level])
        belief = gathered.copy()
        for level in levels[1:]:
            above = belief[parents[level]] - up[level]
            both = self.edge[kinds[level]] + above[:, :, None]
            belief[level] = gathered[level] + np.logaddexp(both[:, 0], both[:, 1])
        return 1.0 / (1.0 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))

    def extract(self, pages: Sequence[str | None]) -> list[str]:
        """The main texts of some pages; their trees are solved together."""
        trees = [Page(html) for html in pages]
        sizes = np.array([len(t.tags) for t in trees], np.int64)
        firsts = np.cumsum(sizes) - sizes
        parents = np.full(int(sizes.sum()), -1, np.int64)
        own = np.zeros(len(parents))
        kinds = np.array([tag_kind(tag) for t in trees for tag in t.tags], np.int64)
        for first, tree in zip(firsts.tolist(), trees):
            n = len(tree.tags)
            parents[first + 1 : first + n] = np.array(tree.parents[1:], np.int64) + first
            rows, cols = page_features(tree)
            own[first : first + n] = np.bincount(rows, self.weights[cols], minlength=n)
        content = self.marginals(parents, own, kinds) > 0.5 if len(parents) else np.zeros(0, bool)
        return [join_blocks(t, content[f : f + len(t.tags)]) for f, t in zip(firsts.tolist(), trees)]


def join_blocks(page: Page, content: np.ndarray) -> str:
    """The texts of content blocks, a line each; text on either side of a block is its own line."""
    block = page.block_of()
    lines: list[str] = []
    current, pieces = -1, []

    def flush() -> None:
        line = SPACE.sub(" ", "".join(pieces)).strip()
        if line:
            lines.append(line)
        pieces.clear()

    for node, text in page.texts:
        owner = block[node]
        if owner != current:
            flush()
            current = owner
        # An inline element may be no content inside a content block.
        if content[owner] and (node == owner or content[node]):
            pieces.append(text)
        elif node != owner:
            pieces.append(" ")
    flush()
    return "\n".join(lines)


def train(pages: Sequence[tuple[str, Sequence[bool]]], passes: int = 300, l2: float = 0.02) -> TreeModel:
    """Fit potentials from ``(html, states)`` with one state per element of the parsed tree."""
    rows, cols, truth = [], [], []
    pairs = np.full((len(KINDS) + 1, 2, 2), 0.5)
    base = 0
    for html, states in pages:
        tree = Page(html)
        if len(states) != len(tree.tags):
            raise ValueError("a labelled page needs one state per element")
        r, c = page_features(tree)
        rows.append(r + base)
        cols.append(c)
        truth += [float(s) for s in states]
        for node in range(1, len(states)):
            pairs[tag_kind(tree.tags[node]), int(states[tree.parents[node]]), int(states[node])] += 1
        base += len(states)
    row, col, y = np.concatenate(rows), np.concatenate(cols), np.array(truth)
    weights = np.zeros(FEATURES)
    step = np.full(FEATURES, 1e-8)
    for _ in range(passes):
        p = 1.0 / (1.0 + np.exp(-np.bincount(row, weights[col], minlength=base)))
        slope = np.bincount(col, (p - y)[row], minlength=FEATURES) / 10 + l2 * weights
        step += slope * slope
        weights -= 0.5 * slope / np.sqrt(step)
    edge = np.log(pairs / pairs.sum(axis=2, keepdims=True))
    # The child's own share is in its own potential already.
    share = pairs.sum(axis=1, keepdims=True) / pairs.sum(axis=(1, 2), keepdims=True)
    return TreeModel(weights, edge - np.log(share))


def main_text(model: TreeModel, html: Column) -> Column:
    """The main text of every whole page."""
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = live(key, lambda: model)
        for batch in batches:
            pages = batch.tolist()
            out: list[str] = []
            for at in range(0, len(pages), 100):
                out += held.extract(pages[at : at + 100])
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, T.StringType())(html)
