"""Main-text extraction from HTML by a minimum cut.

A page's text is cut into blocks at block-level tags. A logistic classifier over a block's ancestors, links, length and
marks, trained from a small table of blocks labelled by rule, gives the cost of either label: the capacities from the
source and to the sink. Blocks next to each other, and consecutive children of one parent, are joined by edges whose
capacity falls with their distance in the DOM. The minimum cut (max-flow by shortest augmenting levels) labels all
blocks at once: content on the source's side, boilerplate on the sink's.
"""

from __future__ import annotations

import collections
import functools
import html as html_lib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tags that part blocks, tags without an end tag, and tags whose content is no text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li legend main menu nav ol option optgroup p pre search section select summary table tbody td tfoot th thead title tr ul button".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style noscript template svg math iframe object canvas audio video textarea select datalist head title".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
#: An opening tag of the first kind ends an open element of the second, inside the nearest of the third.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}

#: Words in class, id and role that tell what an element is.
ROLES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager toc toolbar tabs skip sitemap dropdown".split(),
    "header": "masthead topbar banner siteheader logo tagline branding".split(),
    "footer": "footer foot copyright contentinfo colophon legal imprint".split(),
    "side": "sidebar aside related recommended recommendations widget complementary trending popular rail more readmore tags share sharing social toolbox author bio".split(),
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription paywall signup toast privacy".split(),
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner adsense dfp outbrain taboola commercial".split(),
    "form": "form login search signin register feedback contact poll survey".split(),
    "comment": "comment comments commentlist disqus reply replies respond discussion reactions reviews guestbook".split(),
    "body": "article content post entry story main body text prose maintext articlebody".split(),
}
_ROLE_OF = {w: k for k, ws in ROLES.items() for w in ws}
_TAG_ROLE = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "fieldset": "form", "button": "form", "search": "form", "dialog": "notice", "article": "body", "main": "body"}

_NAME = re.compile(r"[a-zA-Z][\w:-]*")
_UNQUOTED = re.compile(r"[^>\"']*")
#: Elements are nested so deep at most, as browsers do; deeper ones become siblings. Their text stays.
DEPTH = 256
_ATTR = re.compile(r"\b(class|id|role|style|hidden|aria-hidden|aria-label)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}


class Tags:
    """The tags of a page in order, in time linear in its length whatever it holds."""

    def __init__(self, page: str):
        self.page, self.quoted = page, True
        #: Needles that stand nowhere from here on, so that they aren't looked for again.
        self.gone: set[str] = set()

    def find(self, needle: str, at: int) -> int:
        if needle in self.gone:
            return -1
        found = self.page.find(needle, at)
        if found < 0:
            self.gone.add(needle)
        return found

    def end_of_raw(self, name: str, at: int) -> int:
        """Where an element whose content is no markup ends; -1 without an end tag."""
        if name in self.gone:
            return -1
        m = _RAW_END[name].search(self.page, at)
        if not m:
            self.gone.add(name)
        return m.end() if m else -1

    def _close(self, at: int) -> int:
        """The > that ends a tag; those in quoted values don't. Once a quote stays open to the page's end, quotes no longer count."""
        start = at
        while self.quoted:
            at = _UNQUOTED.match(self.page, at).end()
            if at < len(self.page) and self.page[at] == ">":
                return at
            at = self.page.find(self.page[at], at + 1) + 1 if at < len(self.page) else 0
            if not at:
                self.quoted = False
        return self.find(">", start)

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """The next tag or comment from a place on: start, end, name ('' for comments), whether it is an end tag, attributes."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = self.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), "", False, ""
            if page.startswith("<![CDATA[", at) and (end := self.find("]]>", at)) >= 0:
                return at, end + 3, "", False, ""
            if page.startswith(("<!", "<?"), at) and (end := self.find(">", at)) >= 0:
                return at, end + 1, "", False, ""
            closing = page.startswith("</", at)
            name = _NAME.match(page, at + 1 + closing)
            if name and (end := self._close(name.end())) >= 0:
                return at, end + 1, name[0].lower(), closing, page[name.end() : end]
            at += 1
        return None


class Element:
    __slots__ = ("name", "parent", "depth", "roles", "hidden", "serial")

    def __init__(self, name: str, parent: Element | None, attrs: str, serial: int):
        self.name, self.parent, self.serial = name, parent, serial
        self.depth = parent.depth + 1 if parent else 0
        own, hidden = _described(name, attrs)
        # what a block is in: roles above an article don't hold inside it, except for being hidden
        inherited = parent.roles if parent else frozenset()
        self.roles = (frozenset() if name in ("article", "main") else inherited) | own
        self.hidden = hidden or bool(parent and parent.hidden) or name in NO_TEXT


@functools.lru_cache(maxsize=50_000)
def _described(name: str, attrs: str) -> tuple[frozenset[str], bool]:
    roles = set()
    if name in _TAG_ROLE:
        roles.add(_TAG_ROLE[name])
    hidden = False
    if attrs and not attrs.isspace():
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key in ("hidden",) or key == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif key == "style":
                hidden = hidden or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif key in ("class", "id", "role") and name not in ("body", "html"):
                parts = [p.lower() for p in _PART.findall(value)]
                found = {_ROLE_OF[p] for p in parts if p in _ROLE_OF}
                # "article-comments": the telling word is the one that is not about the body
                roles |= found - {"body"} or found
    return frozenset(roles), hidden


class Block:
    __slots__ = ("text", "linked", "element", "tag")

    def __init__(self, text: str, linked: int, element: Element):
        self.text, self.linked, self.element, self.tag = text, linked, element, element.name


def blocks(page: str) -> list[Block]:
    """The visible blocks in page order, text decoded and trimmed, with the number of characters inside links."""
    out: list[Block] = []
    current = Element("#page", None, "", 0)
    open_names: collections.Counter[str] = collections.Counter()
    serial, links, linked = 0, 0, 0
    parts: list[str] = []

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html_lib.unescape("".join(parts))).strip()
            if text:
                out.append(Block(text, linked, current))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not current.hidden:
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    def leave(e: Element) -> None:
        """Closes e and all that is open in it."""
        nonlocal current
        while current is not e.parent:
            open_names[current.name] -= 1
            current = current.parent

    def close(names: tuple[str, ...], scope: tuple[str, ...] = ()) -> None:
        """Closes the innermost open element of these names, if none of the scope is open in it."""
        if any(open_names[n] for n in names):
            e = current
            while e.parent and e.name not in scope:
                if e.name in names:
                    return leave(e)
                e = e.parent

    tags, at = Tags(page), 0
    while True:
        tag = tags.next(at)
        add(page[at : tag[0]] if tag else page[at:])
        if not tag:
            break
        _, at, name, end, attrs = tag
        if not name:
            continue
        if name == "a":
            links = 0 if end else 1
            continue
        if name == "br":
            add(" ")
            continue
        if not end and name in _RAW_END:
            stop = tags.end_of_raw(name, at)
            at = stop if stop >= 0 else len(page) if name in ("script", "style") else at
            if name in BLOCK:
                flush()
            continue
        if name not in BLOCK:
            # inline: only what hides it or tells its role matters
            continue
        flush()
        links = 0
        if end:
            # nothing that parts blocks stands in a paragraph
            close((name,)) if name != "p" or current.name == "p" else None
            continue
        if name in VOID:
            continue
        if current.name == "p":
            leave(current)
        if name in IMPLIED:
            close(*IMPLIED[name])
        if name in ("html", "body") and current.name in ("html", "body", "head") and name == current.name:
            continue
        serial += 1
        if not attrs.rstrip().endswith("/"):
            if current.depth >= DEPTH:
                leave(current)
            current = Element(name, current, attrs, serial)
            open_names[name] += 1
    flush()
    return out


NAMES = ("one", "menu", "header", "footer", "side", "notice", "advert", "form", "comment", "body", "heading", "item", "paragraph", "links", "long", "marks", "rights", "heading_in_header", "links_in_body")
_RIGHTS = re.compile(r"©|\(c\)|copyright|all rights reserved", re.IGNORECASE)


def features(b: Block) -> list[float]:
    roles, n = b.element.roles, len(b.text)
    heading = b.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    title = heading and "header" in roles and "body" in roles
    linked = min(1.0, b.linked / n)
    return [
        1.0, "menu" in roles, "header" in roles, "footer" in roles, "side" in roles, "notice" in roles, "advert" in roles, "form" in roles, "comment" in roles, "body" in roles,
        heading, b.tag in ("li", "dt", "dd", "td", "option"), b.tag in ("p", "blockquote", "pre"), linked, min(1.0, n / 200), min(1.0, sum(b.text.count(c) for c in ".!?,;") / 4), bool(_RIGHTS.search(b.text[:200])) and n < 200, title, linked if roles == {"body"} else 0.0,
    ]


def labelled_blocks(pages: int = 120, seed: int = 11) -> list[tuple[list[float], int]]:
    """Blocks of small pages written by rule, with 1 for content; the places of boilerplate vary from page to page."""
    r = random.Random(seed)
    words = lambda n: " ".join("".join(r.choice(["th", "er", "an", "ou", "la", "de", "en"]) for _ in range(r.randint(1, 4))) for _ in range(n))
    sentence = lambda: words(r.randint(1, 60)).capitalize() + "."
    link = lambda: f"<a href=x>{words(r.randint(1, 4))}</a>"
    out = []
    for _ in range(pages):
        bad = {
            "nav": lambda: "<nav><ul>" + "".join(f"<li><a href=x>{words(1)}</a></li>" for _ in range(r.randint(2, 8))) + "</ul></nav>",
            "menu": lambda: f'<div class="menu">{"".join(f"<a href=x>{words(1)}</a> " for _ in range(4))}</div>',
            "header": lambda: f"<header><p>{words(3)}</p></header>",
            "footer": lambda: f"<footer>&copy; {words(2)} {sentence()}</footer>",
            "aside": lambda: f"<aside><h3>{words(2)}</h3><p>{sentence()}</p></aside>",
            "side": lambda: f'<div class="sidebar"><p>{sentence()}</p></div>',
            "notice": lambda: f'<div class="cookie-notice">{sentence()}</div>',
            "ad": lambda: f'<div class="ad">{sentence()}</div>',
            "form": lambda: f"<form><label>{words(2)}</label><button>{words(1)}</button></form>",
            "comments": lambda: f'<section class="comments"><h2>{words(1)}</h2><p>{sentence()}</p><p>{sentence()}</p></section>',
            "plain": lambda: f'<div><a href=x>{words(3)}</a></div>',
        }
        marked = lambda s: s.replace("<p>", "<p>\x01").replace("<h1>", "<h1>\x01").replace("<h2>", "<h2>\x01").replace("<li>", "<li>\x01")
        inner = marked(f"<h1>{words(5)}</h1>" + "".join(f"<p>{sentence()}</p>" if r.random() < 0.85 else f"<h2>{words(3)}</h2>" if r.random() < 0.6 else "<ul>" + "".join(f"<li>{r.choice([sentence(), link(), link()])}</li>" for _ in range(r.randint(1, 4))) + "</ul>" if r.random() < 0.7 else f"<p>{link()}</p>" for _ in range(r.randint(2, 9))))
        for k in r.sample(sorted(bad), 2):
            if r.random() < 0.4 and k not in ("header", "nav", "plain"):
                inner += bad[k]() + marked(f"<p>{sentence()}</p>")
        wrap = r.choice(["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "<article><header><h1>\x01t</h1></header>{}</article>", "<div>{}</div>"])
        before = "".join(bad[k]() for k in r.sample(sorted(bad), r.randint(1, 4)))
        after = "".join(bad[k]() for k in r.sample(sorted(bad), r.randint(1, 4)))
        for b in blocks(f"<body>{before}{wrap.format(inner)}{after}</body>"):
            label = int("\x01" in b.text)
            b.text = b.text.replace("\x01", "")
            out.append((features(b), label))
    return out


@functools.cache
def classifier() -> np.ndarray:
    """Weights of a logistic regression, by Newton steps with a squared penalty."""
    table = labelled_blocks()
    x, y = np.asarray([f for f, _ in table], dtype=float), np.asarray([label for _, label in table], dtype=float)
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.3 * np.eye(len(w)), x.T @ (y - p) - 0.3 * w)
    return w


#: Capacity of the edge between two blocks with one parent; it halves with each step of DOM distance.
SMOOTH = 0.6


def _distance(a: Element, b: Element) -> int:
    """Steps from a's parent to b's over their closest common ancestor."""
    steps, a, b = 0, a.parent or a, b.parent or b
    while a is not b:
        if a.depth >= b.depth and a.parent:
            a = a.parent
        elif b.parent:
            b = b.parent
        else:
            break
        steps += 1
    return steps


def min_cut(content: list[float], other: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut.

    content[i]: what labelling i boilerplate costs (source to i), other[i]: what labelling it content costs (i to sink).
    """
    n = len(content)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def arc(a: int, b: int, forth: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(forth)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        # only the difference can be cut: what both share flows straight through
        d = content[i] - other[i]
        if d > 0:
            arc(source, i, d, 0.0)
        elif d < 0:
            arc(i, sink, -d, 0.0)
    for a, b, c in edges:
        arc(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = [source]
        for u in queue:
            for e in head[u]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[u] < len(head[u]):
                e = head[u][turn[u]]
                if room[e] > 1e-9 and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            if turn[u] < len(head[u]):
                path.append(head[u][turn[u]])
                u = to[path[-1]]
            elif path:
                e = path.pop()
                u = to[e ^ 1]
                turn[u] += 1
            else:
                break


def extract(page: str, weights: np.ndarray) -> str:
    """The content blocks of a page, joined by line ends."""
    found = blocks(page)
    if not found:
        return ""
    score = np.asarray([features(b) for b in found], dtype=float) @ weights
    content, other = np.logaddexp(0, score).tolist(), np.logaddexp(0, -score).tolist()
    edges = []
    last_of: dict[int, int] = {}
    for i, b in enumerate(found):
        if i and b.element.roles == found[i - 1].element.roles:
            edges.append((i - 1, i, SMOOTH * 0.5 ** _distance(found[i - 1].element, b.element)))
        parent = b.element.parent.serial if b.element.parent else 0
        before = last_of.get(parent)
        if before is not None and before != i - 1 and found[before].element.roles == b.element.roles:
            edges.append((before, i, SMOOTH))
        last_of[parent] = i
    # content[i] is the cost of calling i boilerplate
    side = min_cut(content, other, edges)
    return "\n".join(b.text for b, keep in zip(found, side) if keep)


def find(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page, in one pass without a shuffle.

    Null and empty pages, and pages without content, have an empty text; null ids and urls stay null; repeated rows give
    repeated results; other columns are ignored, whatever their names; an empty table gives no rows.
    """
    weights = classifier()

    @F.pandas_udf("text string, n_chars long")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for htmls in batches:
            texts = [extract(x or "", weights) for x in htmls]
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    return pages.select("page_id", "url", extracted("html").alias("found")).select("page_id", "url", "found.*")
