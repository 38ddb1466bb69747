"""Main text of web pages: gradient-boosted trees over DOM nodes with hierarchical decoding.

A page becomes a tree of block elements whose leaves are runs of inline text.  Boosted trees give each node the
probability that its subtree holds main text, from its tag, attribute tokens, subtree density, depth and siblings.
Decoding picks the most likely labelling in which no node is kept under a dropped one, by one pass up and one down
the tree; the kept runs, in page order, are the text.

The trees are trained on pages laid out from a bounded sample of the given pages' own text blocks, in many layouts
whose main and other blocks are known by construction.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship_package

#: Elements whose content is no markup: it goes on to the closing tag, whatever it looks like.
_RAW = {"script", "style", "iframe", "textarea", "title"}
#: Elements whose content is no text of the page; one that is not closed ends with the element it is in.
_SKIPPED = {"noscript", "template", "svg", "select", "button", "object", "canvas", "audio", "video", "math", "datalist"}
_CELLS = {"td", "th", "tr", "tbody", "thead", "tfoot"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
           "kbd", "label", "mark", "nobr", "output", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
           "strong", "sub", "sup", "time", "tt", "u", "var", "img", "input", "wbr", "picture", "center"}
#: Start tags that end an open element of the named kinds.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

#: Tag groups, each a feature of its own.
_GROUPS = ("run", "p", "heading", "li", "list", "div", "section", "main", "nav", "header", "footer", "aside", "form", "table",
           "quote", "other")
_GROUP = {**{f"h{i}": "heading" for i in range(1, 7)}, "p": "p", "li": "li", "dd": "li", "dt": "li", "ul": "list", "ol": "list",
          "menu": "list", "dl": "list", "div": "div", "section": "section", "article": "main", "main": "main", "nav": "nav",
          "header": "header", "footer": "footer", "aside": "aside", "form": "form", "fieldset": "form", "dialog": "form",
          "table": "table", "tbody": "table", "thead": "table", "tr": "table", "td": "table", "th": "table",
          "blockquote": "quote", "pre": "quote", "figure": "quote", "figcaption": "quote"}
_CODE = {g: i for i, g in enumerate(_GROUPS)}
_EDGE = {"nav", "header", "footer", "aside", "form"}
#: Attribute stems; short ones must be whole tokens.
_OTHER_STEMS = ("nav", "menu", "header", "masthead", "footer", "sidebar", "aside", "ad", "ads", "advert", "banner", "promo",
                "sponsor", "cookie", "consent", "notice", "gdpr", "popup", "modal", "overlay", "newsletter", "subscribe",
                "signup", "login", "search", "form", "comment", "reply", "replies", "disqus", "respond", "related",
                "recommend", "share", "social", "breadcrumb", "pagination", "pager", "widget", "copyright", "legal",
                "toolbar", "tags", "alert", "skip", "sticky", "contentinfo", "complementary", "dialog", "reader",
                "feedback", "discussion", "teaser", "more", "links", "hidden", "top", "bottom", "rail", "dfp", "taboola")
_MAIN_STEMS = ("article", "content", "main", "post", "entry", "story", "body", "text", "prose", "page")
_WHOLE = {"nav", "ad", "ads", "form", "more", "top", "bottom", "rail", "tags", "page", "text", "skip", "dfp", "links", "body"}

#: A quote opens a value only where the value starts; a quoted value may hold ``>``.
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)>"
                    r"|<[!?][^>]*>", re.S)
#: The same where a tag ends at the next ``<`` at the latest.
_SHORT = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/><]*)([^<>]*)>|<[!?][^<>]*>", re.S)
_OPENER = re.compile(r"</?[a-zA-Z]|<[!?]")
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|style|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Parts of class names that say what else a page holds or in which state it is, not what the element is.
_MODIFIER = re.compile(r"(?:^|[-_])(?:has|no|with|without|is)[-_].*$|^.*[-_](?:open|closed|free|enabled|disabled|on|off)$", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


def _attribute_tokens(raw: str) -> tuple[int, int, bool]:
    """How many stems of other and of main blocks the attributes name, and whether the element is hidden."""
    other = main = 0
    hidden = False
    for m in _ATTRIBUTE.finditer(raw):
        value = m[2] or m[3] or m[4] or ""
        name = m[1].lower()
        if name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            continue
        if name in ("class", "id"):
            value = " ".join(_MODIFIER.sub("", x) for x in value.split())
        for word in re.split(r"[^A-Za-z]+", value):
            parts = {p.lower() for p in _PART.findall(word)} | {word.lower()}
            other += any(s in parts or s not in _WHOLE and any(s in p for p in parts) for s in _OTHER_STEMS)
            main += any(s in parts or s not in _WHOLE and any(s in p for p in parts) for s in _MAIN_STEMS)
    return other, main, hidden


def _tokens(page: str, done):
    """Comments, declarations and tags in page order, from ``done()`` on (a raw element's content is passed over).

    A tag that nothing closes was looked for up to the end of the page.  That is done once: from there on, tags end at the
    next ``<``, so the whole page takes time in proportion to its length."""
    pattern, at = _TOKEN, 0
    while (at := page.find("<", max(at, done()))) >= 0:
        m = pattern.match(page, at)
        if m:
            at = m.end()
            yield m
        elif pattern is _TOKEN and _OPENER.match(page, at):
            pattern = _SHORT
        else:
            at += 1


class Tree:
    """Nodes of one page in document order; a node's subtree is the range from it up to ``end``."""

    __slots__ = ("parent", "end", "group", "other", "main", "above", "text", "links", "depth", "index")

    def __init__(self):
        self.parent, self.end, self.group, self.other, self.main, self.above = [], [], [], [], [], []
        self.text, self.links, self.depth, self.index = [], [], [], []


_CACHE: dict[str, tuple[int, int, bool]] = {}


def parse(page: str) -> Tree:
    """The tree of a page; broken markup is repaired the way browsers do for paragraphs, list items and cells.

    Elements may nest to any depth."""
    t = Tree()
    stack: list[tuple[str, int]] = []  # tag and node of each open element
    opened: Counter[str] = Counter()  # how many of each tag are on it
    children: list[int] = []
    edge: list[tuple[int, int, int, int]] = []  # of each open node: stems above and semantic tags above
    buffer: list[str] = []
    linked = 0
    link_at = -1
    inline: Counter[str] = Counter()  # inline elements that are open
    skip: list[str] = []  # open elements from a dropped one on
    inside: Counter[str] = Counter()  # how many of each tag are in it

    def add(group: str, other: int, main: int) -> int:
        n = len(t.parent)
        p = stack[-1][1] if stack else -1
        t.parent.append(p)
        t.end.append(n + 1)
        t.group.append(_CODE[group])
        t.other.append(other)
        t.main.append(main)
        a = edge[-1] if edge else (0, 0, 0, 0)
        t.above.append(a)
        t.text.append("")
        t.links.append(0)
        t.depth.append(len(stack))
        t.index.append(children[-1] if children else 0)
        if children:
            children[-1] += 1
        return n

    def flush() -> None:
        nonlocal linked
        if buffer:
            raw = "".join(buffer)
            if "&" in raw:
                raw = html.unescape(raw)
            text = _SPACE.sub(" ", raw).strip()
            if text:
                n = add("run", 0, 0)
                t.text[n], t.links[n] = text, min(linked, len(text))
            buffer.clear()
        linked = 0

    def push(tag: str, attributes: str) -> None:
        if attributes:
            known = _CACHE.get(attributes)
            if known is None:
                if len(_CACHE) > 20_000:
                    _CACHE.clear()
                known = _CACHE[attributes] = _attribute_tokens(attributes)
            other, main, hidden = known
            other += 3 * hidden
        else:
            other = main = 0
        group = _GROUP.get(tag, "other")
        n = add(group, other, main)
        a = edge[-1] if edge else (0, 0, 0, 0)
        edge.append((a[0] + other, a[1] + main, a[2] + (group in _EDGE), a[3] + (group == "main")))
        stack.append((tag, n))
        opened[tag] += 1
        children.append(0)

    def pop() -> str:
        nonlocal link_at
        tag, n = stack.pop()
        opened[tag] -= 1
        t.end[n] = len(t.parent)
        edge.pop()
        children.pop()
        if link_at > len(stack):
            link_at = -1
        return tag

    def unskip(tag: str) -> None:
        while True:
            last = skip.pop()
            inside[last] -= 1
            if last == tag:
                return

    push("html", "")
    at = 0
    for m in _tokens(page, lambda: at):
        if m.start() > at and not skip:
            piece = page[at:m.start()]
            buffer.append(piece)
            if link_at >= 0:
                linked += len(piece)
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), m[1]
        if tag in _RAW and not closing and not (tag == "title" and skip and (inside["svg"] or inside["math"])):
            if not m[3].endswith("/"):
                # everything up to the closing tag is its content, whatever it looks like
                found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = found.end() if found else len(page)
            continue
        if skip:
            if closing and inside[tag]:
                unskip(tag)
                continue
            if closing:
                if not inline[tag] and not opened[tag]:
                    continue
                ended = True
            else:
                ended = tag in _CELLS and not inside["table"] and opened["table"] > 0
            if not ended:
                if tag in ("button", "select") and inside[tag]:  # one does not hold another
                    unskip(tag)
                if tag not in _VOID and not m[3].endswith("/"):
                    skip.append(tag)
                    inside[tag] += 1
                continue
            skip.clear()
            inside.clear()
        if tag in _SKIPPED and not closing:
            if not m[3].endswith("/"):
                skip.append(tag)
                inside[tag] += 1
            continue
        if tag in _INLINE and tag not in _VOID:
            inline[tag] = max(0, inline[tag] + (-1 if closing else 1))
        if tag == "a":
            link_at = -1 if closing else len(stack)
            continue
        if tag in ("br", "hr"):
            flush()
            continue
        if tag in _INLINE or tag in _VOID or tag in ("html", "head"):
            continue
        flush()
        if closing:
            if opened[tag]:
                while pop() != tag:
                    pass
            continue
        if tag in _ENDS:
            ends, limit = _ENDS[tag]
            for i in range(len(stack) - 1, 0, -1) if any(opened[e] for e in ends) else ():
                if stack[i][0] in limit:
                    break
                if stack[i][0] in ends:
                    while len(stack) > i:
                        pop()
                    break
        if stack[-1][0] == "p" or stack[-1][0][:1] == "h" and stack[-1][0][1:].isdigit() and tag[:1] == "h" and tag[1:].isdigit():
            pop()
        push(tag, m[3])
    if at < len(page) and not skip:
        rest = page[at:]
        cut = rest.rfind("<")
        buffer.append(rest if cut < 0 or not re.match(r"</?[a-zA-Z!]", rest[cut:]) else rest[:cut])
    flush()
    while stack:
        pop()
    return t


# ---------------------------------------------------------------- features

N_FEATURES = len(_GROUPS) + 34


def features(trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all nodes of all trees, and the first row of each tree."""
    first = np.concatenate([[0], np.cumsum([len(t.parent) for t in trees])]).astype(np.int64)
    n = int(first[-1])
    out = np.zeros((n, N_FEATURES), np.float32)
    if not n:
        return out, first
    shift = np.repeat(first[:-1], np.diff(first))

    def column(name: str, kind=np.int64) -> np.ndarray:
        return np.fromiter((x for t in trees for x in getattr(t, name)), kind, n)

    parent, end = column("parent"), column("end") + shift
    parent = np.where(parent >= 0, parent + shift, -1)
    group, other, main = column("group"), column("other"), column("main")
    above = np.array([x for t in trees for x in t.above], np.float32).reshape(n, 4)
    texts = [x for t in trees for x in t.text]
    size = np.fromiter(map(len, texts), np.int64, n)
    stops = np.fromiter((x.count(".") + x.count("!") + x.count("?") for x in texts), np.int64, n)
    commas = np.fromiter((x.count(",") for x in texts), np.int64, n)
    right = np.fromiter(("©" in x or "opyright" in x or "rights reserved" in x for x in texts), np.int64, n)
    links, depth, index = column("links"), column("depth"), column("index")
    here = np.arange(n)

    def below(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(x)])
        return (total[end] - total[here]).astype(np.float32)

    chars, runs, tags = below(size), below(group == 0), below(np.ones(n, np.int64))
    page_chars = np.repeat(np.maximum(chars[first[:-1]], 1), np.diff(first))
    before = np.concatenate([[0], np.cumsum(size)])[here]
    before = before - before[shift]
    siblings = np.bincount(parent[parent >= 0], minlength=n)
    family = np.where(parent >= 0, siblings[parent], 1)
    grand = np.where(parent >= 0, parent[parent], -1)
    edge = (group >= 8) & (group <= 12)
    # main elements that ended before the node: those that start before it less those around it
    started = np.concatenate([[0], np.cumsum(group == _CODE["main"])])
    mains = np.minimum(started[here] - started[shift] - above[:, 3], 3)
    following = np.where(end < np.repeat(first[1:], np.diff(first)), np.minimum(end, n - 1), -1)
    following = np.where((following >= 0) & (parent[following] == parent), following, -1)
    previous = np.full(n, -1)
    previous[following[following >= 0]] = here[following >= 0]
    g = len(_GROUPS)
    out[here, group] = 1
    safe = np.maximum(chars, 1)
    for i, x in enumerate((
            other, main, above[:, 0], above[:, 1], above[:, 2], above[:, 3], np.log1p(chars), below(links) / safe,
            np.log1p(tags), np.log1p(chars / tags), below(stops) / safe * 100, below(commas) / safe * 100,
            np.log1p(below(group == 1)), np.log1p(runs), np.log1p(chars / np.maximum(runs, 1)), below(right), depth,
            index / np.maximum(family, 1), np.log1p(family), np.where(previous >= 0, np.log1p(chars[previous]), -1),
            np.where(following >= 0, np.log1p(chars[following]), -1), before / page_chars, chars / page_chars,
            below(other) - other, below(edge) - edge,
            np.where(parent >= 0, np.log1p(np.maximum(chars[parent] - chars, 0)), -1),
            # what names the nearest ancestors: outer wrappers are often named after the blocks they hold
            np.where(parent >= 0, other[parent], 0), np.where(parent >= 0, main[parent], 0),
            np.where(grand >= 0, other[grand], 0), np.where(grand >= 0, main[grand], 0),
            # how much of the page follows, and how many main elements ended before the node
            (page_chars - before - chars) / page_chars, np.where(group == _CODE["run"], 0, mains),
            np.where(parent >= 0, edge[parent], 0), np.where(grand >= 0, edge[grand], 0))):
        out[:, g + i] = x
    return out, first


# ---------------------------------------------------------------- boosted trees

class Boosted:
    """Boosted trees of equal depth as flat arrays; leaves are added to the log-odds."""

    def __init__(self, depth: int, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.depth, self.base, self.feature, self.threshold, self.leaf = depth, base, feature, threshold, leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, th, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > th[at])
            out += leaf[at - (2 ** self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32,
          ridge: float = 2.0) -> Boosted:
    """Newton boosting of the logistic loss with histogram splits."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(d)]
    binned = np.column_stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(d)])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    all_f, all_t, all_l = [], [], []
    flat = binned + np.arange(d) * bins
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        f, th = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            lo, width = 2 ** level - 1, 2 ** level
            cell = ((at - lo)[:, None] * (d * bins) + flat).ravel()
            gs = np.bincount(cell, np.repeat(g, d), width * d * bins).reshape(width, d, bins).cumsum(axis=2)
            hs = np.bincount(cell, np.repeat(h, d), width * d * bins).reshape(width, d, bins).cumsum(axis=2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if b < len(cuts[j]) and gain[k, j, b] > 1e-6:
                    f[lo + k], th[lo + k] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), f[at]] > th[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        score += value[leaf]
        all_f.append(f)
        all_t.append(th)
        all_l.append(value)
    return Boosted(depth, base, np.array(all_f), np.array(all_t), np.array(all_l))


# ---------------------------------------------------------------- decoding

def decode(parent: list[int], log_odds: list[float]) -> list[bool]:
    """The most likely labels in which a kept node's ancestors are all kept: best gain of each subtree, bottom up; then
    a subtree is kept where its gain is positive and its parent is kept."""
    gain = list(log_odds)
    for i in range(len(gain) - 1, 0, -1):
        if gain[i] > 0:
            gain[parent[i]] += gain[i]
    keep = [False] * len(gain)
    for i, g in enumerate(gain):
        keep[i] = g > 0 and (parent[i] < 0 or keep[parent[i]])
    return keep


def main_texts(pages: list[str], model: Boosted) -> list[str]:
    trees = [parse(p) for p in pages]
    x, first = features(trees)
    odds = model.log_odds(x).tolist()
    out = []
    for i, t in enumerate(trees):
        keep = decode(t.parent, odds[first[i]:first[i + 1]])
        out.append("\n".join(s for s, k in zip(t.text, keep) if s and k))
    return out


# ---------------------------------------------------------------- training pages

#: Marks the blocks of the main text in a training page.
_MARK = "\ue000"


class Layouts:
    """Training pages in many layouts, from given text blocks."""

    def __init__(self, blocks: list[str], seed: int = 7):
        self.blocks, self.r = blocks or ["Text."], random.Random(seed)

    def prose(self, least: int = 1) -> str:
        for _ in range(6):
            b = self.r.choice(self.blocks)
            if len(b) >= least:
                break
        return html.escape(b, quote=False)

    def few(self, n: int = 3) -> str:
        words = self.r.choice(self.blocks).split()
        return html.escape(" ".join(words[:self.r.randint(1, n)]), quote=False)

    def links(self, n: int, tag: str = "li") -> str:
        one = "".join(f'<{tag}><a href="/{i}">{self.few()}</a></{tag}>' for i in range(n))
        return f"<ul>{one}</ul>" if tag == "li" else one

    def attributes(self, names: list[str], sure: bool) -> str:
        if not sure and self.r.random() < 0.4:
            return ""
        name = self.r.choice(names)
        if self.r.random() < 0.3:
            name += self.r.choice(["-1", "-wrapper", "_box", " block", "-area", " clearfix", "-inner"])
        return f' {self.r.choice(["class", "class", "id"])}="{name}"'

    def modifiers(self) -> str:
        """Class names that tell how a page is laid out, and so name blocks that the element is not."""
        r = self.r
        block = ["sidebar", "menu", "nav", "header", "footer", "comments", "ads", "ad", "banner", "social", "share", "search",
                 "widget", "newsletter", "related", "toolbar", "breadcrumb", "cookie"]
        made = [r.choice(["has-{}", "no-{}", "with-{}", "{}-open", "{}-free", "{}-left", "{}-right", "content-with-{}", "{}-closed",
                          "{}-on", "page-{}", "layout-{}", "{}Enabled"]).format(r.choice(block)) for _ in range(r.randint(1, 3))]
        return " ".join(made + r.sample(["single", "page", "site", "wrap", "container", "layout", "post-17", "grid", "row"], 2))

    def wrapped(self, semantic: str, names: list[str], body: str) -> str:
        """A block under its semantic tag, or under a plain one whose attributes name it."""
        if semantic and self.r.random() < 0.6:
            return f"<{semantic}{self.attributes(names, False)}>{body}</{semantic}>"
        tag = self.r.choice(["div", "div", "section"])
        return f"<{tag}{self.attributes(names, True)}>{body}</{tag}>"

    def menu(self):
        return self.wrapped("nav", ["nav", "menu", "main-menu", "navbar", "topnav", "breadcrumb"], self.links(self.r.randint(3, 9)))

    def header(self):
        body = f"<div>{self.few()}</div>" + self.r.choice(["", f"<p>{self.few(8)}</p>", self.links(4), f"<h1>{self.few()}</h1>"])
        return self.wrapped("header", ["header", "site-header", "masthead", "top-bar"], body)

    def footer(self):
        body = self.r.choice([f"&copy; {self.few(6)} &middot; {self.few(8)}", f"<p>&copy; {self.few(5)}</p>{self.links(4)}",
                              f"{self.prose()}", f"<p>{self.few(9)}</p><p>All rights reserved.</p>"])
        return self.wrapped("footer", ["footer", "site-footer", "copyright", "legal"], body)

    def sidebar(self):
        body = self.r.choice([f"<h3>{self.few()}</h3>{self.links(5)}", f"<p>{self.prose()}</p>",
                              f"<h2>{self.few()}</h2>" + "".join(f"<p>{self.prose()}</p>" for _ in range(self.r.randint(1, 3)))])
        return self.wrapped("aside", ["sidebar", "side-bar", "related", "widget", "recommended", "right-rail"], body)

    def advert(self):
        body = self.r.choice([self.prose(), f"<p>{self.prose()}</p>", f'<a href="/x">{self.few(9)}</a>', f"<span>{self.prose()}</span>"])
        return self.wrapped("", ["ad", "ads", "advert", "advertisement", "banner", "promo", "sponsored", "ad-slot"], body)

    def notice(self):
        body = self.r.choice([self.prose(), f"<p>{self.prose()}</p>", f"<p>{self.few(12)}</p><button>OK</button>"])
        return self.wrapped("", ["cookie-notice", "notice", "consent", "gdpr-banner", "alert", "popup", "overlay", "paywall-notice"], body)

    def form(self):
        body = self.r.choice([f'<label>{self.few(4)}</label><input type="text"><button>{self.few()}</button>',
                              f'<p>{self.prose()}</p><input name="q"><input type="submit">', f'{self.few(8)} <input name="mail">'])
        if self.r.random() < 0.8:
            return f"<form{self.attributes(['newsletter', 'search-form', 'login', 'subscribe'], False)}>{body}</form>"
        return f"<div{self.attributes(['newsletter', 'search-box', 'login', 'subscribe', 'signup'], True)}>{body}</div>"

    def comments(self):
        named = self.r.random() < 0.7
        said = lambda: self.r.choice(
            [f"<p>{self.prose()}</p>", f"<b>{self.few(2)}</b><p>{self.prose()}</p><p>{self.prose()}</p>", self.prose()])
        if not named:  # under a name that says nothing to the word list
            which = self.r.choice(["responses", "reactions", "thread", "opinions", "talk", "guestbook", "voices", "c-list", "x7"])
            item, title = self.r.choice(["item", "one", "entry-x", "row", ""]), self.r.choice(["", f"<h3>{self.few()}</h3>"])
            body = "".join(f'<div class="{item}">{said()}</div>' if item else f"<div>{said()}</div>"
                           for _ in range(self.r.randint(1, 6)))
            return f'<{(t := self.r.choice(["div", "section"]))} class="{which}">{title}{body}</{t}>'
        one = lambda: self.wrapped("", ["comment", "comment-body", "reply"], said())
        body = f"<h3>{self.few()}</h3>" + "".join(one() for _ in range(self.r.randint(1, 6)))
        if self.r.random() < 0.3:
            body = "<ul>" + "".join(f"<li>{self.prose()}</li>" for _ in range(self.r.randint(1, 5))) + "</ul>"
        return self.wrapped("", ["comments", "comment-list", "discussion", "reader-comments", "disqus_thread"], body)

    def main_block(self) -> str:
        r, text = self.r, _MARK + self.prose()
        kind = r.random()
        if kind < 0.62:
            return f"<p>{text}</p>"
        if kind < 0.70:
            return f"<p><b>{text}<br><p>{_MARK + self.prose()}</p>"
        if kind < 0.76:
            return f"<h{r.randint(2, 4)}>{_MARK + self.few(8)}</h2>"
        if kind < 0.82:
            return "<ul>" + "".join(f"<li>{_MARK + self.prose()}" + r.choice(["</li>", ""]) for _ in range(r.randint(2, 5))) + "</ul>"
        if kind < 0.86:
            return f"<blockquote>{r.choice(['<p>', ''])}{text}</blockquote>"
        if kind < 0.90:
            return f"<p>{text} <a href='/y'>{self.few()}</a> {self.few(9)}</p>"
        if kind < 0.93:
            return f"<div>{text}</div>"
        if kind < 0.96:
            return f"<pre>{text}</pre>"
        return f"<table><tr><td>{text}</td><td>{_MARK + self.few()}</td></tr></table>"

    def article(self) -> str:
        r = self.r
        parts = [f"<h1>{_MARK + self.few(10)}</h1>"] if r.random() < 0.75 else []
        if parts and r.random() < 0.45:  # the title in a header of its own
            by = f"<p>{_MARK + self.few(6)}</p>" if r.random() < 0.3 else ""
            parts = [r.choice(['<div class="post-header">{}</div>', '<header>{}</header>', '<header class="entry-header">{}</header>',
                               '<header>{}</header>', '<header class="entry-header">{}</header>', '<div class="entry-header">{}</div>',
                               '<div class="article-header">{}</div>', '<div class="story-top">{}</div>',
                               '<div class="title-banner">{}</div>']).format(parts[0] + by)]
        parts += [self.main_block() for _ in range(r.choice([1, 2, 3, 5, 8, 12, 20]))]
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            parts.insert(r.randint(0, len(parts)), r.choice([self.advert, self.notice, self.sidebar, self.form, self.advert])())
        body = "".join(parts)
        kind = r.random()
        names = ["content", "post", "entry-content", "article-body", "story", "main", "main-content", "post-body text"]
        if kind < 0.84 and r.random() < 0.3:
            t = r.choice(["article", "main"] if kind < 0.55 else ["div", "section"])
            body = f'<{t} class="{r.choice(names)} {self.modifiers()}">{body}</{t}>'
            kind = 0 if kind < 0.55 else 0.98
        elif kind < 0.55:
            body = f"<{(t := r.choice(['article', 'article', 'main']))}{self.attributes(names, False)}>{body}</{t}>"
        if kind < 0.55:
            return f"<main>{body}</main>" if body.startswith("<article") and r.random() < 0.2 else body
        if kind < 0.84:
            return f"<{(t := r.choice(['div', 'section']))}{self.attributes(names, True)}>{body}</{t}>"
        return r.choice(["<div>{}</div>", "<div><div>{}</div></div>"]).format(body) if kind < 0.96 else body

    def page(self) -> str:
        r = self.r
        top = [f() for f in r.sample([self.menu, self.header, self.advert, self.notice, self.form], r.randint(1, 4))]
        low = [f() for f in r.sample([self.sidebar, self.footer, self.comments, self.advert, self.menu, self.form, self.notice],
                                     r.randint(1, 5))]
        body = self.article()
        if (layout := r.random()) < 0.12:  # a table for a layout
            side = [f"<td{self.attributes(['menu', 'left', 'nav'], False)}>{self.links(r.randint(3, 8), r.choice(['li', 'div']))}</td>"
                    for _ in range(r.randint(0, 1))]
            late = [f"<td{self.attributes(['right', 'sidebar'], False)}>{self.sidebar()}</td>" for _ in range(r.randint(0, 1))]
            body = f"<tr>{''.join(side)}<td{self.attributes(['main', 'content', 'text'], False)}>{body}</td>{''.join(late)}</tr>"
            head, foot = (f"<tr><td colspan=3>{x}</td></tr>" if r.random() < 0.6 else "" for x in (self.few(6), f"&copy; {self.few(6)}"))
            body = f"<table>{head}{body}{foot}</table>"
        elif layout < 0.3:  # the article, with or without some of what follows it, in a wrapper named after other blocks
            inner = [low.pop(0)] if len(low) > 1 and r.random() < 0.5 else []
            body = f'<div class="{self.modifiers()}">{body}{"".join(inner)}</div>'
        elif body.startswith("<article") and r.random() < 0.4:  # other blocks beside the article in one main element
            inner = [low.pop(0)] if len(low) > 1 and r.random() < 0.5 else [self.comments()]
            body = f'<main{self.attributes(["main", "content"], False)}>{body}{"".join(inner)}</main>'
        body = "".join(top) + body + "".join(low)
        if r.random() < 0.2:
            body = f'<div class="{self.modifiers()}">{body}</div>'
        if r.random() < 0.25:
            body = f'<div id="{r.choice(["wrapper", "container", "root", "app"])}">{body}</div>'
        end = r.choice(["</body></html>", "</body></html>", ""])
        start = f'<body class="{self.modifiers()}">' if r.random() < 0.3 else "<body>"
        return f"<!DOCTYPE html><html><head><title>{self.few(9)}</title><style>p{{margin:0}}</style></head>{start}{body}{end}"


def training_rows(blocks: list[str], pages: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels (1: the subtree holds main text) of the nodes of laid-out pages."""
    make = Layouts(blocks, seed)
    trees, labels = [], []
    for _ in range(pages):
        t = parse(make.page())
        y = [s.startswith(_MARK) for s in t.text]
        t.text = [s.lstrip(_MARK) for s in t.text]
        for i in range(len(y) - 1, 0, -1):
            if y[i]:
                y[t.parent[i]] = True
        trees.append(t)
        labels += y
    return features(trees)[0], np.array(labels, float)


def learn(pages: DataFrame, sample_pages: int = 150, layouts: int = 800, id_col: str = "page_id",
          html_col: str = "html") -> Boosted:
    """Train on layouts of the blocks of about ``sample_pages`` pages, those whose hash falls in that share of all hashes
    (all pages of a smaller table); neither bound grows with the table, and rows that repeat count once."""
    rows = pages.select(F.xxhash64(F.col(id_col), F.col(html_col)).alias("h"), F.col(html_col).cast("string").alias("html")
                        ).where("html is not null")
    share = min(1.0, sample_pages / max(1, pages.count()))
    some = sorted(rows.where(F.pmod("h", F.lit(1 << 40)) < F.lit(share * (1 << 40))).dropDuplicates(["h"]).collect())
    blocks = [s for r in some for s in parse(r.html).text if s]
    return boost(*training_rows(blocks, layouts))


def extract(pages: DataFrame, model: Boosted, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            slice_chars: int = 1 << 20) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row.

    A null or empty page, and one without main text, gives an empty text; broken markup is repaired; repeated rows are
    treated alike; an empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for batch in batches:
            htmls = [h or "" for h in batch.column(2).to_pylist()]
            i = 0
            while i < len(htmls):
                j, size = i, 0
                while j < len(htmls) and (j == i or size + len(htmls[j]) <= slice_chars):
                    size += len(htmls[j])
                    j += 1
                texts = main_texts(htmls[i:j], shared.value)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])
                i = j

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
