"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is parsed into block-level nodes. Boosted trees judge each node by what its subtree holds (text, links,
density), its tag and attribute tokens, its depth, and how it compares with its siblings and ancestors. A node is
cut out or kept as a whole choice along the tree: what is below a node that is cut is cut too, and a node is kept if
the log odds of the nodes kept with it are positive in sum; so no kept node lies in one that is cut.

The trees are fitted on pages written by a rule: known layouts around sentences from a bounded sample of the pages.
"""

from __future__ import annotations

import html
import itertools
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelens.llm.support import worker_memo

#: Pages whose sentences fill the training pages, at most; training pages; trees, their depth and step.
SAMPLE_PAGES, TRAINING_PAGES, TREES, DEPTH, RATE = 64, 500, 40, 4, 0.3

# Fixed values of HTML: elements without content, with raw content, without readable text, within a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style"}
#: Elements whose content is text up to their end tag, if it is there, and those that stand within a line though nothing in them is read.
RAW_IF_CLOSED = {"iframe", "noembed", "noframes", "textarea"}
FLOWING = set("script style template noscript svg iframe object canvas math select textarea".split())
UNREAD = set("script style template noscript head title svg iframe object canvas math select option datalist textarea".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Start tags that end an open element: an open element of the first set ends when one of the second starts.
CLOSES = [({"p"}, None), ({"li"}, {"li"}), ({"dt", "dd"}, {"dt", "dd"}), ({"tr"}, {"tr", "tbody", "tfoot"}), ({"td", "th"}, {"td", "th", "tr", "tbody", "tfoot"}), ({"option"}, {"option"})]
#: Start tags that may stand in a head; any other ends it.
IN_HEAD = set("html head base basefont bgsound link meta noframes noscript script style template title".split())
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())

TAG_GROUPS = [
    {"article", "main"}, {"nav", "menu"}, {"header"}, {"footer", "address"}, {"aside", "dialog"}, {"form", "button", "label", "fieldset", "input", "legend"},
    {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"table", "tbody", "thead", "tr", "td", "th"}, {"figure", "figcaption", "blockquote", "pre"},
]
TOKEN_GROUPS = [
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip tabs",
    "footer copyright legal colophon bottom header masthead topbar banner logo site",
    "sidebar aside widget related recommended popular trending archive tags rail",
    "ad ads advert advertisement adsense sponsor sponsored promo promoted dfp commercial outbrain taboola",
    "cookie cookies consent gdpr notice alert popup modal overlay privacy notification",
    "comment comments reply replies disqus respond discussion reader",
    "form search login signup subscribe newsletter share social follow button",
    "article content post entry story main body text prose richtext",
]
TOKEN_OF = {t: i for i, group in enumerate(TOKEN_GROUPS) for t in group.split()}
#: Attributes that features look at, and the mark of a block's end among a page's pieces.
ATTRIBUTES, BLOCK_END = {"class", "id", "role", "data-main"}, (-1, "")
_NAME = re.compile(r"[A-Za-z][^\t\n\f\r />]*")
_NEXT = re.compile(r"[\t\n\f\r /]*([^\t\n\f\r />][^\t\n\f\r />=]*)?[\t\n\f\r ]*")
_SPACE = re.compile(r"[\t\n\f\r ]*")
_BARE = re.compile(r"[^\t\n\f\r >]*")
_COMMENT_END = re.compile(r"--!?>")
_SPLIT = re.compile(r"[^a-z]+")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    place: int
    tokens: str = ""
    main: bool = False
    chars: int = 0
    links: int = 0
    marks: int = 0
    tags: int = 1
    before: int = 0
    children: list = field(default_factory=list)


def open_head(stack: list[tuple[str, int]], head: int) -> int:
    """``head``, the place where one was opened, if it is open still; 0 if not, or if what is open belongs to a template in it."""
    is_open = 0 < head < len(stack) and stack[head][0] == "head"
    return head if is_open and not any(name == "template" for name, _ in stack[head:]) else 0


def read_tag(page: str, at: int) -> tuple[str | None, list[tuple[str, str]], bool, int]:
    """Name, wanted attributes, whether it closes itself, and end of a tag whose name begins at ``at``; no name if the page ends in it.

    A quote counts only where a value begins, as HTML says.
    """
    found = _NAME.match(page, at)
    name, at, n, wanted = found.group(), found.end(), len(page), []
    while True:
        found = _NEXT.match(page, at)
        at, key = found.end(), found.group(1)
        if at >= n:
            return None, [], False, n
        if key is None:
            return name.lower() if name.isascii() else name, wanted, page[at - 1] == "/" and found.end() > found.start(), at + 1
        value = ""
        if page[at] == "=":
            at = _SPACE.match(page, at + 1).end()
            quote = page[at : at + 1]
            if quote in ('"', "'"):
                end = page.find(quote, at + 1)
                if end < 0:
                    return None, [], False, n
                value, at = page[at + 1 : end], end + 1
            else:
                found = _BARE.match(page, at)
                value, at = found.group(), found.end()
        if key.lower() in ATTRIBUTES:
            wanted.append((key.lower(), value))


def after_markup(page: str, at: int) -> int:
    """Where a comment, a declaration or other markup that is no tag ends; ``at`` is the place of its ``<``. The place itself if it is text."""
    c = page[at + 1 : at + 2]
    if page.startswith("<!--", at):
        if page.startswith(">", at + 4) or page.startswith("->", at + 4):
            return page.index(">", at) + 1
        end = _COMMENT_END.search(page, at + 4)
        return end.end() if end else len(page)
    if c in ("!", "?", "/") and c:
        end = page.find(">", at + 2)
        return end + 1 if end >= 0 else len(page) if c != "/" or at + 2 < len(page) else at
    return at


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block-level nodes in page order (the root is 0), and the page's text as (node, piece); ``BLOCK_END`` ends a block.

    ``<`` begins a tag before a letter, or before ``/`` and a letter; before ``!``, ``?`` and ``/`` it begins other markup, else it is
    text. Open elements end as HTML says for paragraphs, list items, table parts and the head; an end tag closes up to its
    element, or nothing if none is open; what is open at the end ends there. The work is linear in the page.
    """
    nodes = [Node("#", -1, 0, 0)]
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("#", 0)]  # open elements with the block they belong to
    opened: dict[str, int] = {}  # how many elements of a name are open
    unclosed_raw: set[str] = set()  # names whose end tag no longer comes
    seen, linked, unread, at, head = 0, 0, 0, 0, 0
    n = len(page)

    def close(i: int) -> None:
        nonlocal linked, unread
        for name, _ in stack[i:]:
            opened[name] -= 1
            linked -= name == "a"
            unread -= name in UNREAD
        del stack[i:]

    def put(tag: str, node: int) -> None:
        opened[tag] = opened.get(tag, 0) + 1
        stack.append((tag, node))

    while at < n:
        start = page.find("<", at)
        piece, ending = "", False
        if start != at:
            piece, at = page[at : start if start >= 0 else n], start if start >= 0 else n
        elif page[at + 1 : at + 2].isascii() and page[at + 1 : at + 2].isalpha():
            pass
        elif page[at + 1 : at + 2] == "/" and page[at + 2 : at + 3].isascii() and page[at + 2 : at + 3].isalpha():
            ending = True
        else:
            end = after_markup(page, at)
            if end > at:
                at = end
                continue
            piece, at = "<", at + 1
        if piece:
            if unread and stack[-1][0] == "head" and piece != "<" and piece.strip():
                close(len(stack) - 1)
            if not unread:
                text = html.unescape(piece)
                node = nodes[stack[-1][1]]
                size = len(text.strip())
                node.chars += size
                seen += size
                if linked:
                    node.links += size
                node.marks += text.count(".") + text.count(",")
                out.append((stack[-1][1], text))
            continue
        tag, attributes, closed, at = read_tag(page, at + 1 + ending)
        if tag is None:
            break
        if ending:
            if opened.get(tag):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        # What closes inside of something unread, or within a line, ends no block.
                        names = itertools.takewhile(lambda name: name not in FLOWING, (name for name, _ in stack[i:]))
                        ends = any(name not in INLINE for name in names)
                        close(i)
                        if ends and not unread:
                            out.append(BLOCK_END)
                        break
            continue
        if unread and tag not in IN_HEAD and open_head(stack, head):
            close(head)
        if tag in INLINE:
            nodes[stack[-1][1]].tags += 1
            if tag == "br":
                out.append((stack[-1][1], " "))
            if tag not in VOID and not closed:
                linked += tag == "a"
                put(tag, stack[-1][1])
            continue
        for open_, starts in CLOSES:
            if tag in (ENDS_P if starts is None else starts) and any(opened.get(name) for name in open_):
                for i in range(len(stack) - 1, 0, -1):
                    name = stack[i][0]
                    if name in open_:
                        close(i)
                        break
                    if name not in INLINE and name not in ("tr", "td", "th", "p"):
                        break
        if tag not in FLOWING and not unread:
            out.append(BLOCK_END)
        if tag in VOID:
            nodes[stack[-1][1]].tags += 1
            continue
        parent = stack[-1][1]
        node = Node(tag, parent, nodes[parent].depth + 1, len(nodes[parent].children), before=seen)
        for name, value in attributes:
            if name == "data-main":
                node.main = True
            else:
                node.tokens += f" {value}".lower()
        nodes[parent].children.append(len(nodes))
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\t\n\f\r />])", re.I).search(page, at)
            at = end.start() if end else n
        elif tag in RAW_IF_CLOSED and tag not in unclosed_raw:
            end = re.compile(rf"</{tag}(?=[\t\n\f\r />])", re.I).search(page, at)
            if end:
                at = end.start()
            else:
                unclosed_raw.add(tag)
        elif tag in ("title", "noscript") and unread and open_head(stack, head):
            # Tags in them are not the head's, if their end tag is there.
            end = re.compile(rf"</?{tag}\b" if tag == "title" else r"</?noscript\b|</head\b|<body\b", re.I).search(page, at)
            at = end.start() if end and end.group().lower() == f"</{tag}" else at
        if not closed:
            unread += tag in UNREAD
            if tag == "head" and not open_head(stack, head):
                head = len(stack)
            put(tag, len(nodes) - 1)
    return nodes, out


_GROUP = {t: i for i, g in enumerate(TAG_GROUPS) for t in g}
N_GROUPS = len(TAG_GROUPS)


N_TOKENS = len(TOKEN_GROUPS)


def _token_counts(tokens: str) -> list[float]:
    out = [0.0] * N_TOKENS
    for t in _SPLIT.split(tokens):
        g = TOKEN_OF.get(t, TOKEN_OF.get(t[:-1], -1) if t else -1)
        if g >= 0:
            out[g] += 1
    return out


def node_features(pages: list[list[Node]]) -> np.ndarray:
    """A row of numbers per node, for the nodes of several pages one after the other."""
    nodes = [x for page in pages for x in page]
    size = np.array([len(p) for p in pages])
    root = np.repeat(np.cumsum(size) - size, size)
    n = len(nodes)
    group = np.array([_GROUP.get(x.tag, N_GROUPS) for x in nodes])
    base = np.array([(x.chars, x.links, x.marks, x.tags, x.depth, x.place, len(x.children), x.before, x.parent) for x in nodes], float).reshape(-1, 9)
    is_root = base[:, 8] < 0
    parent = np.where(is_root, np.arange(n), base[:, 8].astype(np.int64) + root)
    own, depth = base[:, 0], base[:, 4].astype(np.int64)
    sums, best = base[:, :4].copy(), own.copy()
    tokens = np.zeros((n, N_TOKENS))
    for i, x in enumerate(nodes):
        if x.tokens:
            tokens[i] = _token_counts(x.tokens)
    # Upwards by depth: what subtrees hold. Downwards: what stands above.
    sorted_ = np.argsort(depth, kind="stable")
    by_depth = np.split(sorted_, np.searchsorted(depth[sorted_], np.arange(1, depth.max(initial=0) + 1)))
    for at in by_depth[:0:-1]:
        np.add.at(sums, parent[at], sums[at])
        np.maximum.at(best, parent[at], best[at])
    above, tag_above = np.zeros((n, N_TOKENS)), np.zeros((n, 6))
    boiler = group[:, None] == np.arange(6)
    for at in by_depth[1:]:
        up = parent[at]
        above[at] = np.maximum(above[up], tokens[up] > 0)
        tag_above[at] = np.maximum(tag_above[up], boiler[up])
    chars, links, marks, tags = sums.T
    total, visible = np.maximum(1, chars[root]), np.maximum(chars, 1)
    siblings = base[parent, 6]
    columns = [
        np.log1p(chars), np.log1p(own), chars / total, links / visible, np.log1p(chars / np.maximum(tags, 1)), marks / visible * 100, np.log1p(tags),
        base[:, 4], base[:, 6], base[:, 5] / np.maximum(siblings, 1), siblings, chars / np.maximum(chars[parent], 1), base[:, 7] / total, np.log1p(best),
        (group == group[parent]).astype(float), group[parent].astype(float),
    ]
    one_hot = group[:, None] == np.arange(N_GROUPS)
    return np.concatenate([np.stack(columns, 1), one_hot, tokens, above, tag_above], axis=1)


@dataclass
class Trees:
    """Complete trees of one depth: feature, threshold of the inner nodes and value of the leaves, tree by tree."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - inner]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Boost regression trees on the gradient of the logistic loss, splits from histograms of binned features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    score, inner = np.full(len(y), base), 2**depth - 1
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            low, wide = 2**level - 1, 2**level
            best = np.full(wide, 1e-6)
            gs, hs = np.bincount(at - low, g, wide), np.bincount(at - low, h, wide)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                key = (at - low) * (len(e) + 1) + code[:, j]
                left_g = np.bincount(key, g, wide * (len(e) + 1)).reshape(wide, -1).cumsum(1)[:, :-1]
                left_h = np.bincount(key, h, wide * (len(e) + 1)).reshape(wide, -1).cumsum(1)[:, :-1]
                gain = left_g**2 / (left_h + ridge) + (gs[:, None] - left_g) ** 2 / (hs[:, None] - left_h + ridge) - (gs**2 / (hs + ridge))[:, None]
                k = gain.argmax(1)
                better = gain[np.arange(wide), k] > best
                best[better] = gain[np.arange(wide), k][better]
                f[low : low + wide][better] = j
                t[low : low + wide][better] = e[k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), f[at]] > t[at])
        leaf = at - inner
        v = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        score += v[leaf]
        features.append(f)
        thresholds.append(t)
        values.append(v)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: those of the best choice in which nothing is kept below a node that is cut."""
    gain = odds.copy()
    for i in range(len(nodes) - 1, 0, -1):
        if gain[i] > 0:
            gain[nodes[i].parent] += gain[i]
    keep = gain > 0
    for i in range(1, len(nodes)):
        keep[i] &= keep[nodes[i].parent]
    return keep


def assemble(pieces: list[tuple[int, str]], keep: np.ndarray) -> str:
    """Blocks of the kept nodes, white space within them one space, joined by line ends."""
    blocks, held = [], []
    for node, piece in [*pieces, BLOCK_END]:
        if node < 0:
            if held:
                block = " ".join("".join(held).split())
                if block:
                    blocks.append(block)
                held = []
        elif keep[node]:
            held.append(piece)
    return "\n".join(blocks)


def training_pages(sentences: list[str], count: int = TRAINING_PAGES, seed: int = 3) -> list[str]:
    """Pages of many layouts whose main blocks carry the attribute ``data-main``."""
    rng = np.random.default_rng(seed)
    pick = lambda a: a[int(rng.integers(len(a)))]
    yes = lambda p: rng.random() < p
    words = lambda a, b: " ".join(pick(sentences).split()[: int(rng.integers(a, b + 1))]) or "more"
    long = lambda: " ".join(pick(sentences) for _ in range(int(rng.integers(1, 7))))
    links = lambda k: "".join(f"<li><a href='/x'>{words(1, 3)}</a></li>" for _ in range(k))
    token = lambda g: pick(TOKEN_GROUPS[g].split()) if yes(0.8) else pick(["c1", "x2", "wrap", "row", "col", "inner"])

    def box(tag: str, group: int, inner: str, sure: bool = False) -> str:
        name = pick(TOKEN_GROUPS[group].split()) if sure else token(group)
        return f'<{tag} {pick(["class", "id"])}="{name}">{inner}</{tag}>' if sure or yes(0.75) else f"<{tag}>{inner}</{tag}>"

    def menu() -> str:
        inner = f"<ul>{links(int(rng.integers(3, 12)))}</ul>" if yes(0.7) else " ".join(f"<a href='/y'>{words(1, 2)}</a>" for _ in range(5))
        return f"<nav>{inner}</nav>" if yes(0.5) else box("div", 0, inner, True)

    def noise() -> str:
        kind = int(rng.integers(8))
        if kind == 0:
            return box("div", 3, pick(sentences) if yes(0.7) else f"<p>{pick(sentences)}</p>", True)
        if kind == 1:
            return f"<aside>{words(2, 5)}<ul>{links(5)}</ul></aside>" if yes(0.5) else box("div", 2, f"<h3>{words(1, 4)}</h3><ul>{links(6)}</ul><p>{pick(sentences)}</p>", True)
        if kind == 2:
            return box(pick(["div", "section"]), 4, f"<p>{pick(sentences)}</p><button>{words(1, 2)}</button>", True)
        if kind == 3:
            return f"<form action='/s'><label>{words(1, 3)}</label><input name='q'><button>{words(1, 2)}</button></form>"
        if kind == 4:
            return box("div", 6, f"<p>{words(3, 9)}</p><form><input><button>{words(1, 2)}</button></form>", True)
        if kind == 5:
            return box("div", 6, " ".join(f"<a href='/z'>{words(1, 1)}</a>" for _ in range(4)), True)
        return box("div", 3, f"<span>{words(3, 12)}</span>", True) if kind == 6 else menu()

    def comments() -> str:
        each = "".join(f'<{t} class="comment"><b>{words(1, 2)}</b><p>{long()}</p></{t}>' for t in ["div", "li", "article"][: 1] * int(rng.integers(1, 6)))
        return f'<section class="{pick(["comments", "discussion", "replies"])}" id="comments"><h3>{words(1, 3)}</h3>{each}</section>'

    def body() -> str:
        parts = [f"<h1 data-main='1'>{words(3, 12)}</h1>"] if yes(0.9) else []
        for _ in range(int(rng.integers(1, 15))):
            kind = rng.random()
            if kind < 0.72:
                parts.append(f"<p data-main='1'>{long() if yes(0.8) else words(1, 6)}</p>")
            elif kind < 0.8:
                parts.append(f"<h2 data-main='1'>{words(2, 8)}</h2>")
            elif kind < 0.87:
                parts.append("<ul>" + "".join(f"<li data-main='1'>{words(3, 15)}</li>" for _ in range(4)) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote data-main='1'>{long()}</blockquote>")
            elif kind < 0.95:
                parts.append(f"<table><tr><td data-main='1'>{words(1, 4)}</td><td data-main='1'>{words(1, 9)}</td></tr></table>")
            else:
                parts.append(noise())
        return "".join(parts)

    out = []
    for _ in range(count):
        main = body()
        shell = rng.random()
        main = f"<article>{main}</article>" if shell < 0.45 else f"<main>{main}</main>" if shell < 0.6 else box("div", 7, main, shell < 0.85)
        top = (menu() if yes(0.8) else "") + (f"<header>{words(1, 4)}{menu() if yes(0.3) else ''}</header>" if yes(0.4) else "") + (noise() if yes(0.6) else "")
        end = (noise() if yes(0.5) else "") + (comments() if yes(0.3) else "")
        foot = f"&copy; {words(1, 3)} &middot; {pick(sentences) if yes(0.6) else words(2, 6)}"
        end += f"<footer>{foot}</footer>" if yes(0.6) else box("div", 1, f"<p>{foot}</p>", True)
        page = top + main + end
        page = box("div", 7, page) if yes(0.2) else f"<div>{page}</div>" if yes(0.2) else page
        out.append(f"<html><head><title>{words(2, 6)}</title></head><body>{page}</body></html>")
    return out


def fit_extractor(pages: DataFrame, most: int = SAMPLE_PAGES, html_column: str = "html") -> Trees:
    """Trees fitted on training pages with sentences from at most ``most`` pages, chosen by hash; fixed words if there are none."""
    # The hashes are chosen first, so that only the chosen pages themselves are sent; copies count once.
    hashed = pages.select(F.col(html_column).alias("h"), F.xxhash64(html_column).alias("k")).where("h is not null")
    chosen = hashed.select("k").distinct().orderBy("k").limit(most).collect()
    rows = hashed.where(F.col("k") <= chosen[-1].k).dropDuplicates(["k"]).orderBy("k").collect() if chosen else []
    sentences = sorted({" ".join(html.unescape(s).split()) for r in rows for s in re.findall(r">([^<>]{20,})<", r.h)})
    sentences = [s for s in sentences if s] or ["One line of some words, and then one more.", "Another line stands here, with words of its own."]
    parsed = [parse(p)[0] for p in training_pages(sentences)]
    x = node_features(parsed)
    y = []
    for nodes in parsed:
        main = np.array([n.main for n in nodes])
        for i in range(len(nodes) - 1, 0, -1):
            main[nodes[i].parent] |= main[i]
        y.append(main)
    return fit_trees(x, np.concatenate(y).astype(float))


def extract_text(page: str | None, trees: Trees) -> str:
    if not page:
        return ""
    nodes, pieces = parse(page)
    return assemble(pieces, decode(nodes, trees.log_odds(node_features([nodes]))))


def extract(pages: DataFrame, trees: Trees, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """The id, URL, ``text`` and ``n_chars`` (code points) of every row, in whatever HTML it has.

    A null or empty page gives the empty text. Rows are read one by one, so repeated rows give equal results; an empty
    table gives no rows; columns that are not named are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast((trees.base, trees.feature, trees.threshold, trees.value))
    name = f"extractor-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_memo(name, lambda: Trees(*shared.value))
        for batch in batches:
            parsed = [parse(p.as_py() or "") for p in batch.column(2)]
            texts, at = [], 0
            while at < len(parsed):  # trees judge some thousand nodes at a time
                end, size = at, 0
                while end < len(parsed) and (end == at or size < 20_000):
                    size += len(parsed[end][0])
                    end += 1
                odds = held.log_odds(node_features([nodes for nodes, _ in parsed[at:end]]))
                for nodes, pieces in parsed[at:end]:
                    texts.append(assemble(pieces, decode(nodes, odds[: len(nodes)])))
                    odds = odds[len(nodes) :]
                at = end
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [id_column, url_column, "text", "n_chars"])

    narrow = pages.select(id_column, url_column, html_column)
    kinds = [f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in (id_column, url_column)]
    return narrow.mapInArrow(run, f"{kinds[0]}, {kinds[1]}, text string, n_chars long")
