"""HTML extraction by minimum-cut labelling.

A page becomes blocks of text in page order. A linear classifier over a block's own text (words, links, whether it ends like a sentence, whether it
is a heading) and over the nearest mark around it (a tag or name of content or of boilerplate) gives a score, whose positive part is the cost
of calling it boilerplate and whose negative part that of calling it content: the capacities to the two terminals. Marks of content are weak:
a menu inside of an article has a score below 0. Marked elements are nodes of the graph, too, without a score: the blocks below them are tied
to them, which is DOM proximity, so an element takes the side of most that is in it. Neighbours in page order, and blocks whose
containers are the same, are tied by smoothness edges, as far as they are from each other in the tree. The minimum cut, found by
maximum flow, is the labelling of least cost. Nodes whose score exceeds all their edges are settled first, which is exact and leaves
small graphs. Pages are labelled one by one inside Arrow batches, in time linear in the page but for the flow.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keeps_columns, text_of

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attr>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attr2>[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)|[^<]++|<",
    re.S,
)
_NAMES = re.compile(r"""(?:^|[\s"'])(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not text of the page.
RAW = frozenset("script style title textarea noscript template iframe svg canvas audio video select option datalist head annotation annotation-xml".split())
#: Those that run to the end of the page if they are not closed.
TO_END = frozenset("script style title textarea noscript iframe".split())
#: Where an unclosed svg is left.
_LEAVES = re.compile(r"(?=</?(?:p|div|body|h[1-6]|ul|ol|dl|li|table|blockquote|pre|section|article)[\s>/])", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img object param math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot munder mover munderover mstyle mpadded mspace semantics annotation annotation-xml".split())
#: What an opening tag closes, up to the nearest element of the second kind.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Around them a paragraph stays open.
SCOPE = frozenset("html body article section main div td th li table blockquote aside nav header footer form".split())

BAD_TAGS = frozenset("nav footer aside form button menu dialog fieldset legend input address".split())
GOOD_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense banner banners promo promos promotion promoted sponsor sponsored sponsors
    nav navbar navigation menu menus breadcrumb breadcrumbs toolbar topbar masthead header footer foot sidebar sidebars rail aside widget widgets
    notice notices cookie cookies consent gdpr alert alerts popup popups modal overlay dialog disclaimer copyright
    comment comments commentlist disqus respond reply replies discussion feedback
    share sharing social follow subscribe subscription newsletter signup login form search related recommended recommendations pagination pager skip
    complementary contentinfo navigation""".split()
)
#: On an article itself, words of the page's layout say nothing; on a heading, neither does "header", nor beside a good name.
LAYOUT = frozenset("nav navigation menu header masthead footer foot sidebar sidebars aside widget share sharing social follow form search notice related".split())
GOOD_NAMES = frozenset("article content main post entry story body text prose".split())
#: The classifier: what fit_weights gives over 1,500 pages, but for the bias, which is set: a few words that nothing marks are rarely prose.
WEIGHTS = {"word": 0.1, "links": -3.0, "no_sentence": -0.7, "heading": 1.8, "bias": -0.6}
MOST_WORDS = 40
#: What a mark adds to the score: bad ones (more than any text and its edges, as readers' comments are prose, too), article and main, and good names (weak: they don't outweigh text).
BAD, GOOD, NAMED = 8.0, 1.0, 1.0
#: The smoothness between a block and the marked element around it, between neighbours of one container, of near ones (beyond TOO_FAR steps in
#: the tree there is none), and between blocks of a container.
TIE, NEAR, FAR, SAME, TOO_FAR = 1.0, 1.5, 1.0, 0.75, 16


class Block(NamedTuple):
    """text; its element's tag and number, and that of the element around it (-1: none); link characters; and the marked element around it, with
    how strong the mark is, below 0 for boilerplate (0: none)."""

    text: str
    tag: str
    element: int
    holder: int
    links: int
    hub: int
    mark: float


def _names(attr: str) -> list[str]:
    out = []
    for m in _NAMES.finditer(attr):
        for word in (m[2] or m[3] or m[4] or "").replace("_", "-").split():
            out += [x.lower() for x in _PARTS.findall(word)]
    return out


def _mark(tag: str, attr: str) -> float:
    """What an element's tag and names say of what is in it."""
    names = _names(attr) if "=" in attr else []
    wrong, right = {x for x in names if x in BAD_NAMES}, any(x in GOOD_NAMES for x in names)
    if tag in GOOD_TAGS:
        wrong -= LAYOUT
    elif right or tag in HEADINGS:
        wrong -= {"header"}
    if tag in BAD_TAGS or _HIDDEN.search(attr) is not None or wrong and tag not in ("html", "body"):
        return -BAD
    return GOOD if tag in GOOD_TAGS else NAMED if right else 0.0


class Tree:
    """The blocks of a page and the tree of its block elements, from tokens in page order."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.parent: list[int] = []  # of block elements, by number
        self.depth: list[int] = []
        self.tags: list[str] = []
        self.stack: list[tuple[str, int, int, float, bool]] = []  # tag, block element, hub, mark, in an article
        self.open = Counter()
        self.buffer: list[str] = []
        self.links = self.hubs = 0
        self.seen: dict[tuple[str, str], float] = {}

    def text(self, s: str) -> None:
        self.buffer.append(s)
        if self.open["a"]:
            self.links += len(s.strip())

    def flush(self) -> None:
        if self.buffer:
            text = " ".join(html.unescape("".join(self.buffer)).split())
            if text:
                _, element, hub, mark, _ = self.stack[-1] if self.stack else ("", -1, -1, 0.0, False)
                holder = self.parent[element] if element >= 0 else -1
                self.blocks.append(Block(text, self.tags[element] if element >= 0 else "", element, holder, self.links, hub, mark))
            self.buffer.clear()
        self.links = 0

    def push(self, tag: str, attr: str) -> None:
        if (key := (tag, attr)) not in self.seen:
            self.seen[key] = _mark(tag, attr)
        _, element, hub, mark, inside = self.stack[-1] if self.stack else ("", -1, -1, 0.0, False)
        own = -BAD if tag == "header" and not inside else self.seen[key]
        if own and mark >= 0:  # what lies in boilerplate stays there
            hub, mark, self.hubs = self.hubs, own, self.hubs + 1
        if tag not in INLINE:
            self.parent.append(element)
            self.depth.append(self.depth[element] + 1 if element >= 0 else 0)
            self.tags.append(tag)
            element = len(self.parent) - 1
        self.stack.append((tag, element, hub, mark, inside or tag in GOOD_TAGS))
        self.open[tag] += 1

    def pop(self, to: int) -> None:
        if any(x[0] not in INLINE for x in self.stack[to:]):
            self.flush()
        self.open.subtract(x[0] for x in self.stack[to:])
        del self.stack[to:]

    def end(self, tag: str) -> None:
        at = next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag) if self.open[tag] > 0 else None
        if at is None:
            if tag == "br":
                self.buffer.append(" ")
            elif tag not in INLINE:
                self.flush()
        elif tag not in INLINE or not any(x[0] in SCOPE for x in self.stack[at + 1 :]):
            self.pop(at)

    def closes(self, tag: str) -> None:
        """What the opening tag of a block element closes."""
        kinds, until = CLOSES.get(tag, ({"p"}, SCOPE))
        if all(self.open[k] <= 0 for k in kinds):
            return
        at = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in kinds:
                at = i
            if self.stack[i][0] in until:
                break
        if at is not None:
            self.pop(at)

    def apart(self, a: int, b: int) -> int:
        """Steps between two block elements in the tree, TOO_FAR at most."""
        steps = 0
        while a != b and steps < TOO_FAR:
            da, db = (self.depth[x] if x >= 0 else -1 for x in (a, b))
            if da >= db:
                a = self.parent[a]
                steps += 1
            if db >= da:
                b = self.parent[b]
                steps += 1
        return min(steps, TOO_FAR)


def tree_of(page: str) -> Tree:
    tree = Tree()
    pos, n = 0, len(page)
    while pos < n:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            s = m[0]
            if s[0] != "<" or s == "<":
                tree.text(s)
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            tree.end(tag)
            continue
        attr = m["attr"] if m["tag"] else m["attr2"] or ""
        if tag in RAW and not attr.endswith("/"):
            if tag == "head":
                end = re.compile(r"</head\s*>|(?=<body[\s>])", re.I).search(page, pos)
                if end:
                    pos = end.end()
                continue
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, pos)
            if end or tag in TO_END:
                pos = end.end() if end else n
            elif tag == "svg":
                pos = m.end() if (m := _LEAVES.search(page, pos)) else n
            if tag not in INLINE:
                tree.flush()
            continue
        if tag == "br":
            tree.buffer.append(" ")
            continue
        if tag in VOID:
            if tag not in INLINE:
                tree.flush()
            continue
        if tag not in INLINE:
            tree.flush()
            tree.closes(tag)
        if attr.endswith("/") and tag in ("path", "use"):
            continue
        tree.push(tag, attr)
    tree.flush()
    return tree


def blocks_of(page: str) -> list[Block]:
    """The blocks with text, in page order."""
    return tree_of(page).blocks


def features(block: Block) -> list[float]:
    """What the classifier sees, in the order of WEIGHTS: the block's own text, and whether it is a heading."""
    words = min(block.text.count(" ") + 1, MOST_WORDS)
    ends = re.search(r"[.!?…。！？:;\"'”’)][\s\"'”’)]*$", block.text)
    return [float(words), min(1.0, block.links / len(block.text)), float(not ends), float(block.tag in HEADINGS), 1.0]


def text_score(block: Block) -> float:
    """Above 0: content, as far as its own text tells."""
    return sum(w * x for w, x in zip(WEIGHTS.values(), features(block), strict=True))


def score(block: Block) -> float:
    """Above 0: content, as far as its own text and its mark tell."""
    return text_score(block) + block.mark


def fit_weights(pages: list[str], steps: int = 3000, strength: float = 0.003) -> dict[str, float]:
    """The weights of a logistic regression that tells blocks in elements marked as content from those in elements marked as boilerplate."""
    found = [b for page in pages for b in blocks_of(page) if b.mark]
    x, y = np.asarray([features(b) for b in found]).reshape(-1, len(WEIGHTS)), np.asarray([float(b.mark > 0) for b in found])
    scale = np.asarray([10.0, 1.0, 1.0, 1.0, 1.0])
    x, w = x / scale, np.zeros(len(WEIGHTS))
    for _ in range(steps):
        w -= x.T @ (1 / (1 + np.exp(-x @ w)) - y) / max(1, len(y)) + strength * np.append(w[:-1], 0.0)
    return dict(zip(WEIGHTS, (w / scale).tolist(), strict=True))


def min_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """The labelling (True: content) of least total of |score| where the label contradicts it and of edges between labels."""
    n = len(scores)
    w = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), c in edges.items():
        near[i][j] = near[i].get(j, 0.0) + c
        near[j][i] = near[j].get(i, 0.0) + c
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # a score beyond all the edges of a block settles it
        i = todo.popleft()
        if label[i] is None and abs(w[i]) >= sum(near[i].values()):
            label[i] = w[i] > 0
            for j, c in near[i].items():
                w[j] += c if label[i] else -c
                del near[j][i]
                if label[j] is None:
                    todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if not rest:
        return label
    # Maximum flow from the source (content) over shortest paths; s and t are n and n + 1.
    s, t = n, n + 1
    cap: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
    cap[s], cap[t] = {}, {}
    for i in rest:
        cap[s][i], cap[i][s] = max(w[i], 0.0), 0.0
        cap[i][t], cap[t][i] = max(-w[i], 0.0), 0.0
    while True:
        depth, queue = {s: 0}, deque([s])
        while queue:
            i = queue.popleft()
            for j, c in cap[i].items():
                if c > 1e-9 and j not in depth:
                    depth[j] = depth[i] + 1
                    queue.append(j)
        if t not in depth:
            break
        left = {i: iter(list(cap[i])) for i in depth}
        path = [s]
        while path:  # a blocking flow of the layers
            i = path[-1]
            if i == t:
                pairs = list(zip(path, path[1:], strict=False))
                least = min(cap[a][b] for a, b in pairs)
                for a, b in pairs:
                    cap[a][b] -= least
                    cap[b][a] = cap[b].get(a, 0.0) + least
                cutoff = next(k for k, (a, b) in enumerate(pairs) if cap[a][b] <= 1e-9)
                del path[cutoff + 1 :]
                continue
            for j in left[i]:
                if cap[i][j] > 1e-9 and depth.get(j) == depth[i] + 1:
                    path.append(j)
                    break
            else:
                path.pop()
                if path:
                    depth[i] = -1
    for i in rest:
        label[i] = i in depth and depth[i] != -1
    return label


def graph_of(tree: Tree) -> tuple[list[float], dict[tuple[int, int], float]]:
    """Scores of the blocks and, behind them, of the marked elements; and edges."""
    found = tree.blocks
    scores, edges, last, hubs = [score(b) for b in found], {}, {}, {}
    for i, b in enumerate(found):
        if i:
            other = found[i - 1]
            apart = tree.apart(other.element, b.element)
            if apart < TOO_FAR:
                edges[i - 1, i] = NEAR if apart <= 2 and other.tag == b.tag else FAR / (apart + 1)
        if b.holder in last and last[b.holder] != i - 1:
            edges[last[b.holder], i] = SAME
        last[b.holder] = i
        if b.mark:
            if b.hub not in hubs:
                hubs[b.hub] = len(scores)
                scores.append(0.0)  # its blocks alone decide its side
            edges[i, hubs[b.hub]] = TIE
    return scores, edges


def labelled(page: str) -> list[tuple[str, bool]]:
    """The blocks of a page in order, each with whether it is content."""
    tree = tree_of(page)
    return [(b.text, x) for b, x in zip(tree.blocks, min_cut(*graph_of(tree)), strict=False)]  # marked elements have no text


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_blocks", T.LongType()), T.StructField("n_content", T.LongType())]))
def _extract(pages: pd.Series) -> pd.DataFrame:
    rows = []
    for page in pages:
        found = labelled(page)
        kept = [text for text, content in found if content]
        rows.append((" ".join(kept), len(found), len(kept)))
    return pd.DataFrame(rows, columns=["text", "n_blocks", "n_content"])


@keeps_columns
def extract_pages(pages: DataFrame, *, html_col: str = "html") -> DataFrame:
    """pages without html, with text (the content blocks joined by a space), n_blocks and n_content.

    Null, empty or markup-only html: empty text. Unclosed and misnested tags, cut-off pages and bare & are read as
    browsers read them. Rows are independent; repeated rows give equal results. Input columns text, n_blocks and
    n_content are replaced, others pass through.
    """
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_blocks", "n_content", "_got")]
    return pages.select(*rest, _extract(text_of(html_col)).alias("_got")).select(*rest, "_got.*")
