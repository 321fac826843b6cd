"""Main text of web pages: boosted trees over the nodes of the page, decoded along the tree.

Every element of a page is a node with features (tag, tokens of its attributes and of those above,
depth, siblings, density of its subtree). Gradient-boosted trees, trained by Spark, give the odds that a
node is part of the main text. The decision is taken for the whole tree at once: on the way down a page
is outside, then inside the text, then inside something that does not belong to it, and there is no way
back, so a block inside a menu cannot be text and a node of the text cannot lie in a comment. The best
such labelling of all nodes follows from one pass up and one pass down.

The trees are trained on ``TRAIN_PAGES`` pages with known labels, put together from usual layouts and
sentences of ``SAMPLE_PAGES`` given pages; both numbers are bounds and do not grow with the input. Every
page is then parsed and decided in its own task; there is no shuffle.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm.common import bound_batches, column, text_of

SAMPLE_PAGES = 100
PAGE_SENTENCES = 200
TRAIN_PAGES = 800
TREES = 16
DEPTH = 5
STEP = 0.3
BATCH_NODES = 20_000
# What it costs to begin a text and to begin something foreign within it, in log odds.
ENTER, LEAVE = 2.0, 1.0

# Element names of HTML.
VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed xmp".split())
UNSEEN = frozenset("head title script style template iframe noembed textarea select option button svg math object noscript".split())
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
SCOPE = frozenset("html body table td th caption button object template".split())
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "head", "title", "html", "body"}
# An element of the first kind ends an open one of the second kinds, up to one of the third.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}

# Tag groups and attribute tokens that features count.
TAG_GROUPS = (
    ("heading", "h1 h2 h3 h4 h5 h6 hgroup"), ("paragraph", "p pre blockquote"), ("item", "li dd dt"), ("list", "ul ol dl menu"),
    ("link", "a"), ("article", "article"), ("main", "main"), ("section", "section"), ("div", "div center"), ("nav", "nav"),
    ("header", "header"), ("footer", "footer"), ("aside", "aside"), ("form", "form fieldset input label legend"),
    ("table", "table tbody thead tr td th"), ("figure", "figure figcaption img picture"), ("page", "html body"),
)
TOKEN_GROUPS = (
    ("text", "article content post entry story main body text page hentry blog document copy paragraph prose"),
    ("menu", "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination pager tabs toc skip links"),
    ("header", "header head masthead top branding logo hero sitename"),
    ("footer", "footer foot bottom copyright colophon legal imprint"),
    ("side", "sidebar side aside widget rail secondary complementary related recommended popular trending more teaser"),
    ("notice", "notice cookie cookies consent gdpr banner alert message warning popup modal overlay announcement disclaimer toast"),
    ("advert", "ad ads adv advert advertisement adbox sponsor sponsored promo promotion affiliate dfp outbrain taboola commercial"),
    ("comment", "comment comments reply replies respond discussion disqus commentlist thread reader feedback reviews guestbook"),
    ("form", "form login signin signup search subscribe newsletter share social sharing buttons contact register tools"),
)
_GROUP_OF_TAG = {t: i for i, (_, tags) in enumerate(TAG_GROUPS) for t in tags.split()}
_GROUPS_OF_TOKEN = {t: i for i, (_, tokens) in enumerate(TOKEN_GROUPS) for t in tokens.split()}
N_TAGS, N_TOKENS = len(TAG_GROUPS), len(TOKEN_GROUPS)
FIGURES = (
    "depth", "siblings", "place", "like_siblings", "sibling_chars", "chars", "own_chars", "share", "tags", "density",
    "link_share", "paragraphs", "block_chars", "stops", "begin", "end", "children", "foreign_child", "parent_chars",
    "mark", "mark_above", "foreign_above", "text_above",
)
FOREIGN_TAGS = frozenset("nav aside footer header form".split())
TEXT_TAGS = frozenset("article main".split())
N_FEATURES = 2 * N_TAGS + 2 * N_TOKENS + len(FIGURES)

_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*)")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# What html.unescape cannot read: Python's int() takes no more than 4,300 digits.
_LONG_REF = re.compile(r"&#([0-9]{4000,})")
_SPACES = re.compile(r"[ \t\n\x0b\x0c\r\xa0]+")


@dataclass
class Page:
    """The elements of a page in document order, and its text: (node, text), node -1 for a break."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    tokens: list[tuple[int, ...]] = field(default_factory=list)
    gold: list[int | None] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)


def _unescape(piece: str) -> str:
    # Eight digits are beyond all characters already.
    return html.unescape(_LONG_REF.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), piece) if "&#" in piece else piece)


def parse(source: str) -> Page:
    """Elements and text of a page. Takes any string: unknown end tags are passed over, open elements
    end with the page, a head also with the first element or text that cannot stand in it, an unfinished tag at the end is dropped, ``</`` before anything but an ASCII
    letter begins a comment up to the next ``>``, and a ``data-gold`` other than 0 and 1 says nothing."""
    page, stack, at, n = Page(), [], 0, len(source)
    # Depths of the open elements of each name, and of the open blocks: nothing walks the stack.
    depths: dict[str, list[int]] = {}
    block_depths: list[int] = []

    def nearest(kinds: Iterable[str]) -> int:
        return max((depths[k][-1] for k in kinds if depths.get(k)), default=-1)

    def text(piece: str) -> None:
        if stack and page.tags[stack[-1]] == "head" and piece.strip():
            close(len(stack) - 1)
        if piece and stack:
            page.runs.append((stack[-1], _unescape(piece)))
        elif piece.strip():
            open_element("body", "")
            page.runs.append((stack[-1], _unescape(piece)))

    def open_element(tag: str, attrs: str) -> None:
        found, gold = [], None
        if attrs:
            for name, value in _ATTR.findall(attrs):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id", "role", "itemprop", "aria-label"):
                    found += [_GROUPS_OF_TOKEN[t] for t in map(str.lower, _TOKEN.findall(value)) if t in _GROUPS_OF_TOKEN]
                elif name == "data-gold" and value in ("0", "1"):
                    gold = int(value)
        page.tags.append(tag)
        page.parents.append(stack[-1] if stack else -1)
        page.tokens.append(tuple(found))
        page.gold.append(gold)
        if tag in BLOCK:
            page.runs.append((-1, ""))
        if tag not in VOID:
            depths.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                block_depths.append(len(stack))
            stack.append(len(page.tags) - 1)

    def close(depth: int) -> None:
        if block_depths and block_depths[-1] >= depth:
            page.runs.append((-1, ""))
        while len(stack) > depth:
            tag = page.tags[stack.pop()]
            depths[tag].pop()
            if tag in BLOCK:
                block_depths.pop()

    def end_open(kinds: frozenset, bounds: frozenset) -> None:
        depth = nearest(kinds)
        if depth > nearest(bounds):
            close(depth)

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            text(source[at:])
            break
        after = source[lt + 1 : lt + 2]
        first = source[lt + 2 : lt + 3] if after == "/" else after
        is_tag = first.isalpha() and first.isascii()
        if after == "!" or after == "?" or after == "/" and first and not is_tag:
            text(source[at:lt])
            stop = source.find("-->", lt + 4) if source.startswith("<!--", lt) else source.find(">", lt)
            at = n if stop < 0 else stop + (3 if source.startswith("<!--", lt) else 1)
            continue
        if not is_tag:
            text(source[at : lt + 1])
            at = lt + 1
            continue
        text(source[at:lt])
        m = _TAG.match(source, lt)
        if m is None:
            stop = source.find(">", lt)
            if stop < 0:
                break
            m = re.match(r"</?([A-Za-z][^\s/>]*)([^>]*)>", source[lt : stop + 1])
            at = stop + 1
        else:
            at = m.end()
        tag, attrs = m[1].lower(), m[2]
        if after == "/":
            depth = nearest([tag])
            # An inline element cannot be ended from within a block that it holds.
            if depth >= 0 and (tag in BLOCK or not block_depths or depth > block_depths[-1]):
                close(depth)
            continue
        # The end tag of a head may be missing: it ends with what cannot stand in it.
        if tag == "body":
            end_open(frozenset(["head"]), frozenset(["template"]))
        elif stack and page.tags[stack[-1]] == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag in CLOSES_P:
            end_open(frozenset(["p"]), SCOPE)
        if tag in ENDS:
            end_open(*ENDS[tag])
        open_element(tag, attrs)
        if tag in RAW:
            low = re.compile(f"</{tag}[\\s/>]", re.I).search(source, at)
            stop = low.start() if low else n
            text(source[at:stop])
            at = stop
    return page


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tags)
    x = np.zeros((n, N_FEATURES), dtype=np.float32)
    parents = page.parents
    own, begin = [0] * n, [None] * n
    stops = [0] * n
    seen = 0
    hidden = [False] * n
    depth = [0] * n
    # What tag and tokens say of a node alone, the nearest such word above it, and how often it is said.
    marks, nearest, foreign_above, text_above = [0] * n, [0] * n, [0] * n, [0] * n
    for i, p in enumerate(parents):
        says = page.tokens[i]
        marks[i] = -1 if page.tags[i] in FOREIGN_TAGS or any(says) else 1 if says or page.tags[i] in TEXT_TAGS else 0
        nearest[i] = marks[i] or (nearest[p] if p >= 0 else 0)
        if p >= 0:
            foreign_above[i], text_above[i] = foreign_above[p] + (marks[p] < 0), text_above[p] + (marks[p] > 0)
        hidden[i] = page.tags[i] in UNSEEN or (p >= 0 and hidden[p])
        depth[i] = 0 if p < 0 else depth[p] + 1
    for node, piece in page.runs:
        if node >= 0 and not hidden[node]:
            size = len(piece.strip())
            own[node] += size
            stops[node] += piece.count(".") + piece.count(",")
            seen += size
    chars, tags, links, paragraphs, blocks, all_stops = own[:], [1] * n, [0] * n, [0] * n, [0] * n, stops[:]
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, -1, -1):
        tag = page.tags[i]
        if tag == "a":
            links[i] = chars[i]
        paragraphs[i] += tag == "p"
        blocks[i] += tag in BLOCK
        p = parents[i]
        if p >= 0:
            children[p].append(i)
            chars[p] += chars[i]
            tags[p] += tags[i]
            links[p] += links[i]
            paragraphs[p] += paragraphs[i]
            blocks[p] += blocks[i]
            all_stops[p] += all_stops[i]
    for kin in children:
        kin.reverse()
    passed = 0
    starts = [0] * n
    order: dict[int, int] = {}
    for node, piece in page.runs:
        if node >= 0 and not hidden[node]:
            order.setdefault(node, passed)
            passed += len(piece.strip())
    for i in range(n - 1, -1, -1):
        first = [starts[c] for c in children[i]]
        if i in order:
            first.append(order[i])
        starts[i] = min(first) if first else passed
    total = max(1, seen)
    alike = Counter(zip(parents, page.tags))
    base_tok, base_up = N_TAGS, 2 * N_TAGS + N_TOKENS
    for i in range(n):
        row, p = x[i], parents[i]
        group = _GROUP_OF_TAG.get(page.tags[i])
        if group is not None:
            row[group] = 1
        for t in page.tokens[i]:
            row[base_tok + t] += 1
        if p >= 0:
            up = x[p]
            # What stands above: tag groups and tokens of all ancestors.
            row[N_TAGS + N_TOKENS : base_up] = np.maximum(up[N_TAGS + N_TOKENS : base_up], up[:N_TAGS])
            row[base_up : base_up + N_TOKENS] = up[base_up : base_up + N_TOKENS] + up[base_tok : base_tok + N_TOKENS]
        kin = children[p] if p >= 0 else [i]
        like = alike[p, page.tags[i]] if p >= 0 else 1
        foreign = sum(marks[c] < 0 for c in children[i])
        row[base_up + N_TOKENS :] = (
            depth[i], math.log1p(len(kin)), (i - kin[0]) / max(1, kin[-1] - kin[0]), like / len(kin),
            math.log1p((chars[p] if p >= 0 else chars[i]) / len(kin)), math.log1p(chars[i]), math.log1p(own[i]), chars[i] / total,
            math.log1p(tags[i]), chars[i] / tags[i], links[i] / max(1, chars[i]), math.log1p(paragraphs[i]),
            chars[i] / max(1, blocks[i]), 100 * all_stops[i] / max(1, chars[i]), starts[i] / total, (starts[i] + chars[i]) / total,
            math.log1p(len(children[i])), foreign, math.log1p(chars[p]) if p >= 0 else 0.0,
            marks[i], nearest[p] if p >= 0 else 0, foreign_above[i], text_above[i],
        )
    return x


def decide(page: Page, odds: np.ndarray) -> list[bool]:
    """For every node whether it is text: the labelling with the highest sum of log odds among those
    that go outside, text, foreign on every way down."""
    n = len(page.tags)
    own = [0] * n
    for node, piece in page.runs:
        if node >= 0:
            own[node] += len(piece)
    weight = [1.0 + min(own[i], 400) / 40.0 for i in range(n)]
    gain = [weight[i] * float(odds[i]) for i in range(n)]
    # Best sum of the subtree if the node is outside or text; foreign is 0 everywhere.
    out, text = [0.0] * n, gain[:]
    for i in range(n - 1, -1, -1):
        if page.tags[i] in UNSEEN:
            out[i], text[i] = 0.0, -math.inf
        p = page.parents[i]
        if p >= 0:
            out[p] += max(out[i], text[i] - ENTER)
            text[p] += max(text[i], -LEAVE)
    state = [0] * n  # 0 outside, 1 text, 2 foreign
    for i in range(n):
        p = page.parents[i]
        above = state[p] if p >= 0 else 0
        if above == 0:
            state[i] = 1 if text[i] - ENTER > out[i] else 0
        elif above == 1:
            state[i] = 1 if text[i] > -LEAVE else 2
        else:
            state[i] = 2
    return [s == 1 for s in state]


def blocks(page: Page, kept: list[bool]) -> list[str]:
    """The text of the kept nodes by block, white space as one space."""
    found, held = [], []
    for node, piece in [*page.runs, (-1, "")]:
        if node >= 0:
            if kept[node]:
                held.append(piece)
        elif held:
            block = _SPACES.sub(" ", "".join(held)).strip(" ")
            if block:
                found.append(block)
            held = []
    return found


@dataclass(frozen=True)
class Trees:
    """Regression trees side by side; leaves point to themselves."""

    weights: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t, weight in enumerate(self.weights):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                goes_left = x[rows, self.feature[t][at]] <= self.threshold[t][at]
                at = np.where(goes_left, self.left[t][at], self.right[t][at])
            total += weight * self.value[t][at]
        return 2 * total


_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


def _read_tree(lines: Iterator[str], nodes: list[list[float]]) -> int:
    """Read one subtree of a printed tree into ``nodes`` (feature, threshold, left, right, value)."""
    line, me = next(lines), len(nodes)
    if line.startswith("Predict:"):
        nodes.append([0, 0.0, me, me, float(line.split(":")[1])])
        return me
    m = _SPLIT.match(line)
    nodes.append([int(m[1]), float(m[2]), 0, 0, 0.0])
    nodes[me][2] = _read_tree(lines, nodes)
    next(lines)  # Else
    nodes[me][3] = _read_tree(lines, nodes)
    return me


def _trees(model) -> Trees:
    tables = []
    for tree in model.trees:
        lines = iter([s.strip() for s in tree.toDebugString.split("\n")[1:] if s.strip()])
        nodes: list[list[float]] = []
        _read_tree(lines, nodes)
        tables.append(nodes)
    size = max(map(len, tables))
    cells = np.array([t + [[0, 0.0, 0, 0, 0.0]] * (size - len(t)) for t in tables])
    ints = cells.astype(np.int64)
    return Trees(np.array(model.treeWeights), ints[:, :, 0], cells[:, :, 1].astype(np.float32), ints[:, :, 2], ints[:, :, 3], cells[:, :, 4])


# Names that layouts of the training pages use.
_CONTENT = ("article", "main", 'div class="content"', 'div id="main-content"', 'section class="post"', 'div class="entry-content"', 'article class="post"', "div", 'div class="story-body"', 'main id="content"')
_MENU = ("nav", 'div class="menu"', 'ul class="nav"', 'nav class="navbar"', 'div id="navigation"', 'nav class="breadcrumbs"', 'div role="navigation"')
_HEAD = ("header", 'div class="header"', 'header class="site-header"', 'div id="masthead"')
_FOOT = ("footer", 'div class="footer"', 'footer id="site-footer"', 'div id="footer"')
_SIDE = ("aside", 'div class="sidebar"', 'aside class="sidebar"', 'div id="side-column"', 'div class="related"', 'section class="related-posts"', 'div class="widget"')
_NOTE = ('div class="notice"', 'div class="cookie-banner"', 'div id="cookie-consent"', 'section class="notice"', 'p class="notice"', 'div class="alert"', 'div role="alert"', 'aside class="notice"')
_AD = ('div class="ad"', 'div class="advert"', 'aside class="ad"', 'div id="ad-top"', 'div class="sponsored"', 'section class="advertisement"', 'p class="ad"', 'div class="promo"')
_TALK = ('section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="commentlist"', 'section id="discussion"', 'div class="comments"', 'section class="reader-comments"')
_SAID = ('div class="comment"', 'li class="comment"', 'article class="comment"', "li", 'p class="comment"', "div", "p")
_FALLBACK = ("The river runs to the sea.", "It was a long day, and nobody came.", "Read more about the old town here.", "All of them went home before dark, as they had said.")


def _training_page(rng: random.Random, sentences: list[str]) -> str:
    """A page in a usual layout; ``data-gold`` says which subtrees are text (1) and which are not (0)."""

    def wrap(kind: str, inner: str, gold: int | None = None) -> str:
        mark = "" if gold is None else f' data-gold="{gold}"'
        return f"<{kind}{mark}>{inner}</{kind.split()[0]}>"

    def some(lo: int, hi: int) -> str:
        return " ".join(rng.choice(sentences) for _ in range(rng.randint(lo, hi)))

    def words(lo: int, hi: int) -> str:
        return " ".join(rng.choice(sentences).split()[: rng.randint(lo, hi)])

    def links(kind: str, lo: int, hi: int) -> str:
        items = "".join(f"<li><a href=/x>{words(1, 4)}</a></li>" for _ in range(rng.randint(lo, hi)))
        return wrap(kind, items if kind.startswith("ul") else f"<ul>{items}</ul>" if rng.random() < 0.7 else re.sub("</?li>", " ", items), 0)

    def side() -> str:
        kind = rng.choice(_SIDE)
        inner = f"<h3>{words(1, 3)}</h3>" + (links("ul", 2, 6) if rng.random() < 0.6 else f"<p>{some(1, 3)}</p>" * rng.randint(1, 2))
        return wrap(kind, inner, 0)

    def note() -> str:
        inner = some(1, 3)
        return wrap(rng.choice(_NOTE), inner if rng.random() < 0.5 else f"<span>{inner}</span><a href=#>{words(1, 2)}</a>", 0)

    def ad() -> str:
        inner = some(1, 3)
        return wrap(kind := rng.choice(_AD), inner if rng.random() < 0.6 or kind[0] == "p" else f"<p>{inner}</p>", 0)

    def form() -> str:
        return wrap("form", f"<label>{words(1, 3)}</label><input name=q><p>{some(1, 1)}</p><button>{words(1, 1)}</button>", 0)

    def talk() -> str:
        kind, one = rng.choice(_TALK), rng.choice(_SAID)
        said = ""
        for _ in range(rng.randint(1, 6)):
            body = some(1, 4)
            said += wrap(one, body if one.startswith("p") or rng.random() < 0.4 else f"<b>{words(1, 2)}</b><p>{body}</p>")
        return wrap(kind, (f"<h2>{words(1, 2)}</h2>" if kind.split()[0] != "ol" and rng.random() < 0.6 else "") + said, 0)

    def paragraph() -> str:
        r = rng.random()
        if r < 0.08:
            return f"<p>{words(1, 3)}</p>"
        if r < 0.14:
            return f"<p><b>{some(1, 2)}<br>"
        if r < 0.72:
            body = some(1, 8)
            if rng.random() < 0.3:
                body = f"<b>{words(2, 6)}</b> {body}"
            if rng.random() < 0.2:
                body += f" <a href=/y>{words(1, 3)}</a> {some(1, 1)}"
            return f"<p>{body}</p>" if rng.random() < 0.9 else f"<p>{body}<br>"
        if r < 0.82:
            return f"<h2>{words(2, 6)}</h2>"
        if r < 0.9:
            return "<ul>" + "".join(f"<li>{some(1, 2)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if r < 0.95:
            return f"<blockquote><p>{some(1, 3)}</p></blockquote>"
        return "<table><tr><td>" + "</td><td>".join(words(1, 4) for _ in range(3)) + "</td></tr></table>"

    inner = [f"<h1>{words(2, 8)}</h1>"] + [paragraph() for _ in range(rng.choice((1, 2, 3, 5, 8, 12, 20, 40)))]
    for piece, odds in ((ad, 0.3), (note, 0.15), (side, 0.1), (form, 0.1)):
        if rng.random() < odds:
            inner.insert(rng.randint(1, len(inner)), piece())
    if rng.random() < 0.25:
        inner.append(talk())
    plain = rng.random() < 0.08
    content = "".join(inner) if plain else wrap(rng.choice(_CONTENT), "".join(inner), 1)
    if not plain and rng.random() < 0.2:
        content = wrap(rng.choice(("div", 'div class="container"', 'div id="page"', "main")), content + (side() if rng.random() < 0.5 else ""))
    above = [wrap(rng.choice(_HEAD), f"<a href=/>{words(1, 3)}</a><p>{some(1, 1)}</p>", 0)] if rng.random() < 0.4 else []
    above += [links(rng.choice(_MENU), 2, 8)] if rng.random() < 0.85 else []
    above += [piece() for piece, odds in ((ad, 0.4), (note, 0.3), (side, 0.2), (form, 0.2)) if rng.random() < odds]
    rng.shuffle(above)
    below = [piece() for piece, odds in ((side, 0.4), (talk, 0.4), (form, 0.2), (ad, 0.3), (note, 0.15)) if rng.random() < odds]
    rng.shuffle(below)
    if rng.random() < 0.8:
        below.append(wrap(rng.choice(_FOOT), "&copy; " + some(1, 2), 0))
    body = "".join(above) + content + "".join(below)
    return f"<html><head><title>{words(2, 6)}</title></head><body{' data-gold=1' if plain else ''}>{body}</body></html>"


def _labels(page: Page) -> list[float]:
    out: list[float] = []
    for gold, p in zip(page.gold, page.parents):
        out.append(float(gold) if gold is not None else out[p] if p >= 0 else 0.0)
    return out


def sentences(source: str) -> list[str]:
    """Sentences of a page, escaped for a page: at most ``PAGE_SENTENCES`` of less than 400 characters."""
    page, found = parse(source), []
    for block in blocks(page, [True] * len(page.tags)):
        found += [html.escape(s) for s in re.findall(r"[^.]+\.", block)[:40] if len(s) < 400]
    return found[:PAGE_SENTENCES]


def sampled_sentences(pages: DataFrame, id_col: str, html_col: str) -> list[list[str]]:
    """The sentences of ``SAMPLE_PAGES`` pages at most, those whose ids have the smallest hashes.

    Of the rows of one id that with the smallest hash counts, whatever files the table lies in. Pages
    stay on the executors; the driver gets ids and at most ``PAGE_SENTENCES`` sentences a page.
    """
    key = F.xxhash64(F.lit(9), column(pages, id_col).cast("string"))
    drawn = [r[0] for r in pages.select(key.alias("key")).distinct().orderBy("key").limit(SAMPLE_PAGES).collect()]

    @F.pandas_udf("array<string>")
    def cut(batch: pd.Series) -> pd.Series:
        return pd.Series([sentences(source) for source in batch], dtype=object)

    rows = pages.select(key.alias("key"), text_of(column(pages, html_col)).alias("html")).where(F.col("key").isin(drawn))
    one = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("html").alias("hash"), F.col("html"))).alias("page"))
    return [r["found"] for r in one.select("key", cut(F.col("page.html")).alias("found")).orderBy("key").collect()]


def training_rows(found: list[list[str]], n_pages: int = TRAIN_PAGES, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of the nodes of ``n_pages`` made-up pages with the sentences of given ones."""
    x, y = zip(*_training_nodes(found, n_pages, seed))
    return np.concatenate(x), np.concatenate(y)


def _training_nodes(found: list[list[str]], n_pages: int, seed: int = 9) -> Iterator[tuple[np.ndarray, list[float]]]:
    """(features, labels) of the nodes of each of ``n_pages`` made-up pages with the sentences of given ones."""
    pool = [s for page in found for s in page] or list(_FALLBACK)
    rng = random.Random(seed)
    for _ in range(n_pages):
        page = parse(_training_page(rng, pool))
        yield features(page), _labels(page)


def training_frame(spark: SparkSession, found: list[list[str]], n_pages: int = TRAIN_PAGES) -> DataFrame:
    """(features, label) of the nodes of the training pages. They are made page by page in the task that the
    learner reads: rows that the driver gave would travel with every task of every tree."""

    def made(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _training_nodes(found, n_pages):
            cells = pa.FixedSizeListArray.from_arrays(pa.array(x.astype(float).ravel()), N_FEATURES).cast(pa.list_(pa.float64()))
            yield pa.record_batch({"array": cells, "label": pa.array(y, pa.float64())})

    rows = spark.range(0, 1, 1, 1).mapInArrow(made, "array array<double>, label double")
    return rows.select(array_to_vector("array").alias("features"), "label")


def fit(spark: SparkSession, found: list[list[str]], n_pages: int = TRAIN_PAGES) -> Trees:
    """Fit the trees with Spark on the nodes of the training pages, made of the sentences ``found``."""
    rows = training_frame(spark, found, n_pages).persist()
    try:
        return _trees(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1, maxBins=64).fit(rows))
    finally:
        rows.unpersist()


def extract(sources: list[str], trees: Trees) -> list[list[str]]:
    """The text blocks of each page; features of many pages meet the trees at once."""
    out: list[list[str]] = []
    held: list[Page] = []
    n = 0
    for source in [*sources, None]:
        if source is not None:
            held.append(parse(source))
            n += len(held[-1].tags)
        if held and (source is None or n >= BATCH_NODES):
            odds = trees.odds(np.concatenate([features(p) for p in held])) if n else np.empty(0)
            at = 0
            for page in held:
                mine = odds[at : at + len(page.tags)]
                at += len(page.tags)
                out.append(blocks(page, decide(page, mine)) if page.tags else [])
            held, n = [], 0
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", trees: Trees | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every row of ``pages``.

    Blocks come in page order, joined by one space; inside a block white space is one space. Null and
    empty pages have an empty text. Null ids and urls and repeated rows are kept as they are; other
    columns play no part. Without ``trees`` they are trained; an empty table trains on made-up
    sentences only and gives no rows.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    if trees is None:
        trees = fit(spark, sampled_sentences(pages, id_col, html_col))
    model = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("string")
    def text(batch: pd.Series) -> pd.Series:
        return pd.Series([" ".join(b) for b in extract(batch.tolist(), model.value)], dtype=object)

    found = pages.select(column(pages, id_col).alias("page_id"), column(pages, url_col).alias("url"), text(text_of(column(pages, html_col))).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
