"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: text between block-level tags, with the path of open
elements. Each block is a vector: its tag path and the words of its attributes, hashed; its words, hashed;
and a few measures (length, share of links, place). A bidirectional LSTM in numpy reads the whole sequence,
so every block is labelled with the context of the entire document. Blocks labelled main are joined.

The labeller is trained here, on pages written by a seeded generator that knows which blocks are main:
menus, headers, footers, sidebars, notices, adverts, forms, related links and reader comments in many
layouts, with and without semantic tags, with unclosed and truncated markup. No page of a table is used.

Defined results: null and empty pages give an empty text; markup that is never closed ends with the page;
a head ends with the first element that cannot stand in it; a tag that the end of the page cuts off is dropped; a page without main blocks gives an empty text; rows
that repeat a page_id are pages each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("script style noscript template head title svg iframe object audio video canvas textarea button noembed noframes xmp annotation annotation-xml".split())
#: What may stand in a head; any other element ends it, as its closing tag may be left out.
HEAD_TAGS = frozenset("title meta link base basefont bgsound script style noscript template".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
SCOPES = frozenset("ul ol dl table select body html article section div nav aside main header footer form".split())
LIST_SCOPES = SCOPES - {"div"}

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WHITE = re.compile(r"\s+")
WORDS = re.compile(r"\w+|©|»|«|·|→|\|")


def _tag_end(html: str, at: int) -> int:
    """The place behind the > that ends a tag, quoted values skipped; -1 if the page ends before."""
    while True:
        close = html.find(">", at)
        if close < 0:
            return -1
        quotes = [q for q in (html.find('"', at, close), html.find("'", at, close)) if q >= 0]
        if not quotes:
            return close + 1
        first = min(quotes)
        before = first - 1
        while before >= at and html[before].isspace():
            before -= 1
        if html[before] != "=":  # a stray quote
            at = first + 1
            continue
        end = html.find(html[first], first + 1)
        if end < 0:
            return close + 1
        at = end + 1


class Node:
    """An open element below others; pages share the nodes of equal paths, and a node's vector is made once."""

    __slots__ = ("parent", "tag", "words", "depth", "below", "own", "sum", "vector")

    def __init__(self, parent: "Node | None", tag: str, words: tuple):
        self.parent, self.tag, self.words = parent, tag, words
        self.depth = parent.depth + 1 if parent else 0
        self.below: dict[tuple, Node] = {}
        self.own = self.sum = self.vector = None

    def child(self, tag: str, words: tuple) -> "Node":
        found = self.below.get((tag, words))
        if found is None:
            found = self.below[tag, words] = Node(self, tag, words)
            _KEPT[0] += 1
        return found

    def path(self) -> list[tuple[str, tuple]]:
        out, node = [], self
        while node.parent is not None:
            out.append((node.tag, node.words))
            node = node.parent
        return out[::-1]


#: The root of the kept nodes, and how many there are; they go when they are many, between two pages.
_KEPT: list = [0, Node(None, "", ())]
MOST_NODES = 1 << 14


class Block:
    __slots__ = ("node", "parts", "linked", "text")

    def __init__(self, node: Node):
        self.node, self.parts, self.linked, self.text = node, [], 0, ""


def blocks_of(html: str) -> list[Block]:
    """Leaf blocks in page order: node of the open elements, text with white space collapsed. Time is linear in the page but for scans of open elements."""
    if _KEPT[0] > MOST_NODES:
        _KEPT[:] = [0, Node(None, "", ())]
    stack: list[Node] = []
    opened: dict[str, int] = {}
    silent, links, at, n = 0, 0, 0, len(html)
    out: list[Block] = []
    now: Block | None = None

    def say(raw: str) -> None:
        nonlocal now
        if silent or not raw:
            return
        if now is None:
            if raw.isspace():
                return
            now = Block(stack[-1] if stack else _KEPT[1])
            out.append(now)
        text = unescape(raw) if "&" in raw else raw
        now.parts.append(text)
        if links:
            now.linked += len(text.strip())

    def pop_to(k: int) -> None:
        nonlocal silent, links
        for node in stack[k:]:
            silent -= node.tag in SILENT_TAGS
            links -= node.tag == "a"
            opened[node.tag] -= 1
        del stack[k:]

    while at < n:
        m = MARKUP.search(html, at)
        if m is None:
            say(html[at:])
            break
        say(html[at : m.start()])
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            at = m.end()
            continue
        tag = m[2].lower()
        end = _tag_end(html, m.end())
        if end < 0:  # cut off by the end of the page
            break
        at = end
        if m[1]:
            if tag in BLOCK_TAGS:
                now = None
            for k in range(len(stack) - 1, -1, -1) if opened.get(tag) else ():
                if stack[k].tag == tag:
                    pop_to(k)
                    break
                if stack[k].tag in SCOPES and tag not in BLOCK_TAGS:
                    break
            continue
        if opened.get("head") and tag not in HEAD_TAGS and tag != "head":
            pop_to(next(k for k, node in enumerate(stack) if node.tag == "head"))
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCK_TAGS:
            now = None
            for k in range(len(stack) - 1, -1, -1) if opened.get("p") else ():  # a block ends an open paragraph
                if stack[k].tag == "p":
                    pop_to(k)
                    break
                if stack[k].tag in SCOPES:
                    break
            closed = CLOSED_BY.get(tag, ())
            for k in range(len(stack) - 1, -1, -1) if any(opened.get(t) for t in closed) else ():
                if stack[k].tag in closed:
                    pop_to(k)
                    break
                if stack[k].tag in LIST_SCOPES:
                    break
        if tag in VOID_TAGS or html[end - 2] == "/" and tag not in BLOCK_TAGS and tag not in RAW_TAGS:
            continue
        words = []
        attrs = html[m.end() : end - 1]
        for a in ATTRIBUTE.finditer(attrs) if "=" in attrs or "hidden" in attrs else ():
            name = a[1].lower()
            if name in ("class", "id", "role", "itemprop", "aria-label", "data-role"):
                words += [w.lower().rstrip("s") or w.lower() for w in NAME_PARTS.findall(unescape((a[2] or "").strip("\"'")))]
            elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", a[2] or ""):
                words.append("hidden")
        stack.append((stack[-1] if stack else _KEPT[1]).child(tag, tuple(words)))
        opened[tag] = opened.get(tag, 0) + 1
        silent += tag in SILENT_TAGS
        links += tag == "a"
        if tag in RAW_TAGS:  # everything up to the closing tag is text of this element
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
            at = close.start() if close else n
    for b in out:
        b.text = WHITE.sub(" ", "".join(b.parts)).strip()
    return [b for b in out if b.text]


# --- vectors ---------------------------------------------------------------------------------------

PATH_DIM, WORD_DIM, MEASURES = 96, 32, 12
INPUT = PATH_DIM + WORD_DIM + MEASURES


@lru_cache(maxsize=1 << 16)
def _place(word: str, dim: int) -> tuple[int, float]:
    h = xxhash.xxh32_intdigest(word)
    return h % dim, 1.0 if h >> 31 else -1.0


def _path_vector(node: Node) -> np.ndarray:
    """The element's tag and words and its parent's, hashed, and those of all elements around them with less weight."""
    chain = []
    while node is not None and node.sum is None:
        chain.append(node)
        node = node.parent
    for node in reversed(chain):
        node.own = np.zeros(PATH_DIM, np.float32)
        if node.parent is None:
            node.sum = node.own
            continue
        for name in (f"<{node.tag}", *node.words):
            k, sign = _place(name, PATH_DIM)
            node.own[k] += sign
        node.sum = node.parent.sum + np.float32(0.7) * node.own
    node = chain[0] if chain else node
    if node.vector is None:
        x = node.sum + np.float32(0.3) * node.own
        if node.parent is not None:
            x = x + np.float32(0.3) * node.parent.own
            k, sign = _place(f"<<{node.tag}", PATH_DIM)
            x[k] += sign
        node.vector = np.clip(x, -2, 2)
    return node.vector


def vectors(blocks: list[Block]) -> np.ndarray:
    """(blocks, INPUT)"""
    n = len(blocks)
    x = np.zeros((n, INPUT), np.float32)
    lengths = np.array([len(b.text) for b in blocks], np.float32)
    top = max(float(lengths.max()), 1.0) if n else 1.0
    for k, b in enumerate(blocks):
        x[k, :PATH_DIM] = _path_vector(b.node)
        text = b.text
        words = WORDS.findall(text.lower())
        sums = [0.0] * WORD_DIM
        for w in words:
            at, sign = _place(w, WORD_DIM)
            sums[at] += sign
        x[k, PATH_DIM : PATH_DIM + WORD_DIM] = np.clip(np.array(sums, np.float32) / max(1.0, len(words)), -0.5, 0.5)
        m = x[k, PATH_DIM + WORD_DIM :]
        length = len(text)
        m[0] = np.log1p(length) / 6
        m[1] = min(1.0, b.linked / length)
        m[2] = length / top
        m[3] = (k + 0.5) / n
        m[4] = text[-1] in ".!?…\"”»"
        m[5] = min(1.0, len(words) / 30)
        m[6] = sum(text.count(c) for c in ".,;") / (length + 1) * 10
        m[7] = any(c in text for c in "©®|»·")
        m[8] = b.node.tag in ("h1", "h2", "h3", "h4")
        m[9] = length < 25
        m[10] = b.node.depth / 10
        m[11] = 1
    return x


# --- the network -----------------------------------------------------------------------------------

HIDDEN = 24


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM, one sigmoid for each block; all parameters are float32 arrays in ``p``."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {}
        for d in "fb":
            self.p["w" + d] = (rng.standard_normal((INPUT + HIDDEN, 4 * HIDDEN)) / np.sqrt(INPUT + HIDDEN)).astype(np.float32)
            self.p["c" + d] = np.r_[np.ones(HIDDEN), np.zeros(3 * HIDDEN)].astype(np.float32)
        self.p["v"] = (rng.standard_normal(2 * HIDDEN + INPUT) * 0.1).astype(np.float32)
        self.p["o"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, trace: list | None) -> np.ndarray:
        """x: (steps, pages, INPUT) in reading order; states do not change where the mask is 0."""
        steps, pages, _ = x.shape
        w, c0 = self.p["w" + d], self.p["c" + d]
        drive = x @ w[:INPUT] + c0
        recur = w[INPUT:]
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros((pages, HIDDEN), np.float32)
        out = np.empty((steps, pages, HIDDEN), np.float32)
        for t in range(steps):
            z = drive[t] + h @ recur
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            f, i, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            if trace is not None:
                trace.append((h, c, f, i, o, g, tc, m))
            c = m * new_c + (1 - m) * c
            h = m * (o * tc) + (1 - m) * h
            out[t] = h
        return out

    def probabilities(self, x: np.ndarray, mask: np.ndarray, traces: dict | None = None) -> np.ndarray:
        """(steps, pages); sequences are padded at their ends."""
        tf, tb = (([], []) if traces is not None else (None, None))
        hf = self._run(x, mask, "f", tf)
        hb = self._run(x[::-1], mask[::-1], "b", tb)[::-1]
        every = np.concatenate([hf, hb, x], 2)
        if traces is not None:
            traces |= {"f": tf, "b": tb, "every": every}
        return _sigmoid(every @ self.p["v"] + self.p["o"])

    def _back(self, x: np.ndarray, dh_all: np.ndarray, trace: list, d: str, grads: dict) -> None:
        w = self.p["w" + d]
        gw = np.zeros_like(w)
        gc = np.zeros_like(self.p["c" + d])
        dh = np.zeros_like(dh_all[0])
        dc = np.zeros_like(dh_all[0])
        for t in range(len(trace) - 1, -1, -1):
            h0, c0, f, i, o, g, tc, m = trace[t]
            dh = dh + dh_all[t]
            do = m * dh * tc
            dnew = m * (dh * o * (1 - tc * tc) + dc)
            dz = np.concatenate([dnew * c0 * f * (1 - f), dnew * g * i * (1 - i), do * o * (1 - o), dnew * i * (1 - g * g)], 1)
            gw[:INPUT] += x[t].T @ dz
            gw[INPUT:] += h0.T @ dz
            gc += dz.sum(0)
            dh = dz @ w[INPUT:].T + (1 - m) * dh
            dc = dnew * f + (1 - m) * dc
        grads["w" + d], grads["c" + d] = gw, gc

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        traces: dict = {}
        p = self.probabilities(x, mask, traces)
        err = (p - y) * mask / mask.sum()
        every = traces["every"]
        grads = {"v": np.einsum("tpk,tp->k", every, err), "o": np.array([err.sum()], np.float32)}
        dh = err[:, :, None] * self.p["v"][None, None, : 2 * HIDDEN]
        self._back(x, dh[:, :, :HIDDEN], traces["f"], "f", grads)
        self._back(x[::-1], dh[::-1, :, HIDDEN:], traces["b"], "b", grads)
        return grads


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


# --- training pages --------------------------------------------------------------------------------

CUES = {
    "nav": "home about contact news products services login menu search blog shop sports politics help archive".split(),
    "footer": "© copyright all rights reserved privacy policy terms imprint contact sitemap rss impressum".split(),
    "ad": "advertisement sponsored buy now offer sale free promo deal anzeige publicité".split(),
    "notice": "we use cookies accept consent notice update your browser javascript subscribe newsletter privacy warning".split(),
    "comment": "reply posted by says comment ago like report thanks great agree".split(),
    "related": "related more read also recommended popular share tweet tags next previous trending".split(),
    "form": "name email password submit send search subscribe your message enter".split(),
}
NAMES = {
    "nav": ["nav", "menu", "navbar", "main-menu", "topnav", "breadcrumb", "navigation", "links"],
    "header": ["header", "masthead", "site-header", "top", "branding", "logo", "banner"],
    "footer": ["footer", "site-footer", "bottom", "colophon", "copyright", "foot", "legal"],
    "side": ["sidebar", "aside", "widget", "rail", "side", "related", "recommended", "popular", "tags", "share", "social"],
    "ad": ["ad", "ads", "advert", "sponsored", "promo", "banner-ad", "adsense", "advertisement"],
    "notice": ["cookie", "notice", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe", "warning"],
    "comment": ["comments", "comment", "comment-list", "discussion", "replies", "responses", "reader-comments", "disqus"],
    "main": ["content", "article", "post", "entry-content", "story", "main", "article-body", "text", "body", "post-content"],
    "form": ["form", "search", "login", "signup", "contact-form", "subscribe-form"],
}
SYLLABLES = "an en er in on re th tion ou al es st nd at ing ed le de la ei ch sch ung au ble ea ti is or io ne lo mi ra so ta vo ku".split()


class PageMaker:
    """Seeded pages whose blocks are known to be main or not."""

    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)

    def pick(self, of):
        return of[int(self.r.integers(len(of)))]

    def chance(self, p: float) -> bool:
        return bool(self.r.random() < p)

    def word(self) -> str:
        return "".join(self.pick(SYLLABLES) for _ in range(int(self.r.integers(1, 5))))

    def words(self, low: int, high: int, cues: str | None = None) -> str:
        n = int(self.r.integers(low, high + 1))
        out = [self.pick(CUES[cues]) if cues and self.chance(0.5) else self.word() for _ in range(n)]
        text = " ".join(out)
        return text[:1].upper() + text[1:]

    def sentences(self, low: int, high: int) -> str:
        n = int(self.r.integers(low, high + 1))
        kind = self.r.random()
        if kind < 0.06:  # one word or phrase again and again
            phrase = self.words(1, 3)
            return " ".join([phrase + self.pick(["", "", "."])] * int(self.r.integers(2, 40)))
        if kind < 0.14:  # cells of a table written as text
            return self.pick(["", "", "| "]) + " | ".join(self.words(1, 2) + self.pick(["", "", "."]) for _ in range(int(self.r.integers(1, 30)))) + self.pick(["", " |", "."])
        mark = self.pick(["***", "!!", "%%%", "&&&", "$$$", "###", "??"]) if kind < 0.3 else ""
        shout = self.chance(0.05)
        out = []
        for _ in range(n):
            s = self.words(1, 16) + self.pick([".", ".", ".", "!", "?", "", ", " + self.words(1, 6).lower() + "."])
            out.append("".join(w + (mark if self.chance(0.9) else "") + " " for w in s.split(" ")).strip() if mark else s)
        text = " ".join(out)
        return text.upper() if shout else text

    def named(self, tag: str, kind: str, inner: str, always: bool = False) -> str:
        name = self.pick(NAMES[kind])
        where = self.pick([f' class="{name}"', f' id="{name}"', f' class="{self.word()} {name}"', f" class='{name}-{self.word()}'"])
        return f"<{tag}{where if always or tag == 'div' or self.chance(0.5) else ''}>{inner}</{tag}>"

    def block(self, text: str, main: int) -> str:
        """The label travels in the text, behind a sign that no page has, and is taken out of the parsed blocks."""
        return f"\x01{main}{text}"

    def links(self, cues: str) -> str:
        n, data = int(self.r.integers(2, 9)), self.chance(0.5)
        items = [f'<a href="/{self.word()}">{self.block(self.words(1, 3, None if data else cues), 0)}</a>' for _ in range(n)]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{a}</li>" for a in items) + "</ul>"
        return self.pick([" | ", " ", "<br>", ""]).join(items)

    def paragraphs(self) -> str:
        out = []
        for _ in range(int(self.r.integers(1, 12)) if self.chance(0.8) else int(self.r.integers(12, 60))):
            kind = self.r.random()
            if kind < 0.70:
                text = self.block(self.sentences(1, 6), 1)
                if self.chance(0.2):
                    text = f"<b>{text}<br>" if self.chance(0.5) else f'{text} <a href="/x">{self.words(1, 3)}</a> {self.words(1, 4)}.'
                out.append(f"<p>{text}" + ("</p>" if self.chance(0.85) else ""))
            elif kind < 0.76:
                out.append(f"<h{self.pick('2234')}>{self.block(self.words(1, 7), 1)}</h2>")
            elif kind < 0.82:
                out.append("<ul>" + "".join(f"<li>{self.block(self.words(1, 14), 1)}</li>" for _ in range(int(self.r.integers(2, 5)))) + "</ul>")
            elif kind < 0.86:
                out.append(f"<blockquote>{self.block(self.sentences(1, 3), 1)}</blockquote>")
            elif kind < 0.90:
                out.append("<table>" + "".join(f"<tr><td>{self.block(self.words(1, 4), 1)}</td><td>{self.block(self.words(1, 4), 1)}</td></tr>" for _ in range(2)) + "</table>")
            elif kind < 0.93:
                out.append(f"<pre>{self.block(self.words(2, 12), 1)}</pre>")
            elif kind < 0.97:
                out.append(self.advert())
            else:
                out.append(f"<div>{self.block(self.sentences(1, 4), 1)}</div>")
        return "".join(out)

    def advert(self) -> str:
        text = self.block(self.sentences(1, 3) if self.chance(0.6) else self.words(2, 8, "ad"), 0)
        return self.named(self.pick(["div", "div", "aside", "section"]), "ad", text if self.chance(0.6) else f"<p>{text}</p>", always=True)

    def comments(self) -> str:
        one = lambda: self.named("div", "comment", f"<p>{self.block(self.words(1, 3, 'comment'), 0)}</p><p>{self.block(self.sentences(1, 4), 0)}</p>") if self.chance(0.6) else f"<li><p>{self.block(self.sentences(1, 4), 0)}</p></li>"
        head = f"<h3>{self.block(self.words(1, 2, 'comment'), 0)}</h3>" if self.chance(0.7) else ""
        return self.named(self.pick(["section", "div", "ol", "aside"]), "comment", head + "".join(one() for _ in range(int(self.r.integers(1, 6)))), always=True)

    def form(self) -> str:
        return self.named("form", "form", f"<label>{self.block(self.words(1, 3, 'form'), 0)}</label><input name=q><p>{self.block(self.words(1, 10, 'form'), 0)}</p><button>Go</button>")

    def notice(self) -> str:
        text = self.block(self.sentences(1, 2) if self.chance(0.5) else self.words(4, 16, "notice"), 0)
        return self.named(self.pick(["div", "aside", "section"]), "notice", f"<p>{text}</p>" if self.chance(0.5) else text, always=True)

    def page(self) -> str:
        semantic = self.chance(0.7)
        tag = lambda name: name if semantic or self.chance(0.2) else "div"
        parts = []
        if self.chance(0.3):
            parts.append(self.notice())
        if self.chance(0.5):
            inner = self.pick(["<h1>", "<p>", "<div>"]) + self.block(self.words(1, 4), 0)
            parts.append(self.named(tag("header"), "header", inner + (self.links("nav") if self.chance(0.4) else ""), always=True))
        if self.chance(0.85):
            parts.append(self.named(tag("nav"), "nav", self.links("nav")))
        for _ in range(int(self.r.integers(0, 2))):
            parts.append(self.advert())
        side = lambda: self.named(tag("aside"), "side", (f"<h3>{self.block(self.words(1, 2, 'related'), 0)}</h3>" if self.chance(0.6) else "") + (self.links("related") if self.chance(0.6) else f"<p>{self.block(self.sentences(1, 3), 0)}</p>"), always=True)
        if self.chance(0.2):
            parts.append(side())
        title = f"<h1>{self.block(self.words(1, 12) if self.chance(0.5) else self.sentences(1, 1), 1)}</h1>" if self.chance(0.85) else ""
        if title and self.chance(0.15):
            title = f"<header>{title}</header>"
        inner = title + self.paragraphs()
        if self.chance(0.15):
            inner += self.named("div", "side", self.links("related"), always=True)
        if self.chance(0.15):
            inner += self.comments()
        holder = "article" if semantic and self.chance(0.75) else "main" if semantic and self.chance(0.4) else "div"
        body = self.named(holder, "main", inner) if holder != "div" or self.chance(0.85) else f"<div>{inner}</div>"
        parts.append(body)
        for made, p in ((self.comments, 0.35), (side, 0.4), (self.form, 0.3), (self.advert, 0.3), (self.notice, 0.1)):
            if self.chance(p):
                parts.append(made())
        if self.chance(0.85):
            text = f"{self.pick(['&copy; ', '', '2024 '])}{self.block(self.words(2, 10, 'footer'), 0)}"
            parts.append(self.named(tag("footer"), "footer", (f"<p>{text}</p>" if self.chance(0.5) else text) + (self.links("footer") if self.chance(0.4) else "")))
        if self.chance(0.1):
            wrap = f'<div class="{self.pick(["wrapper", "page", "container", "layout"])}">'
            parts = [wrap, *parts, "</div>"]
        html = "<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join(parts)
        return html if self.chance(0.1) else html + "</body></html>"

    def labelled(self) -> tuple[np.ndarray, np.ndarray]:
        blocks = blocks_of(self.page())
        labels = []
        for b in blocks:
            at = b.text.find("\x01")
            labels.append(float(b.text[at + 1] == "1") if at >= 0 else 0.0)
            b.text = WHITE.sub(" ", re.sub("\x01.", "", b.text)).strip() or "-"
        return vectors(blocks), np.array(labels, np.float32)


_TRAINED: dict[tuple, Labeller] = {}


def trained(pages: int = 2400, rounds: int = 5, seed: int = 7, rate: float = 0.01) -> Labeller:
    """The labeller, fitted to generated pages by Adam; the same for the same arguments, and made once in a process."""
    key = (pages, rounds, seed, rate)
    if key in _TRAINED:
        return _TRAINED[key]
    maker, net = PageMaker(seed), Labeller(seed)
    data = [(x, y) for x, y in (maker.labelled() for _ in range(pages)) if len(x)]
    data.sort(key=lambda d: len(d[0]))
    groups = [data[k : k + 32] for k in range(0, len(data), 32)]
    order = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for turn in range(rounds):
        for k in order.permutation(len(groups)):
            x, mask = padded([d[0] for d in groups[k]])
            y = np.zeros_like(mask)
            for c, (_, labels) in enumerate(groups[k]):
                y[: len(labels), c] = labels
            step += 1
            for name, g in net.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                m[name] = 0.9 * m[name] + 0.1 * g
                s[name] = 0.99 * s[name] + 0.01 * g * g
                net.p[name] -= (rate / (1 + turn) * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    _TRAINED[key] = net
    return net


# --- the operator ----------------------------------------------------------------------------------


def main_texts(pages: list[str | None], net: Labeller) -> list[str]:
    """Main text of each page; pages of like length are labelled together."""
    parsed = [blocks_of(p or "") for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k, b in enumerate(parsed) if b), key=lambda k: len(parsed[k]))
    at = 0
    while at < len(order):
        most = max(1, min(128, 20_000 // len(parsed[order[at]])))
        group = order[at : at + most]
        while len(group) > 1 and len(parsed[group[-1]]) > 2 * len(parsed[group[0]]) + 8:
            group = group[: len(group) // 2]
        at += len(group)
        x, mask = padded([vectors(parsed[k]) for k in group])
        main = net.probabilities(x, mask) >= 0.5
        for c, k in enumerate(group):
            out[k] = "\n".join(b.text for b, is_main in zip(parsed[k], main[: len(parsed[k]), c], strict=True) if is_main)
    return out


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = main_texts(part.column("html").to_pylist(), net)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extracted(pages: DataFrame, net: Labeller | None = None, html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars. One pass, no shuffle; the network is small and of fixed size."""
    shared = pages.sparkSession.sparkContext.broadcast(net or trained())
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return rows.mapInArrow(_extract(shared), "page_id long, url string, text string, n_chars long")


def op4_html_extraction(pages: DataFrame) -> DataFrame:
    return extracted(pages)
