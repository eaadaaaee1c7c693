"""Main text of web pages by wrappers: union-free expressions inferred from pages of a host.

Each page is a tree of tags. Trees of one host are aligned child by child: what only some
have becomes optional, neighbours of one kind become a repeated group, and differing text
becomes a slot, so the wrapper of a host is an expression without unions. It tells which
part of the page holds the article, what is the same on every page, and what varies.

Aligning is done where pages lie, a wrapper a host and task; these meet in two steps, so the
pages of a host that holds a third of all are never together. Extraction then reads each
page with its host's wrapper.

Defined cases: a null or empty page has no text. Pages whose address has no host share one
wrapper. A page cut off in the middle is read as far as it goes. Repeated rows each get their
row.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.scratch import materialise

BROADCAST_BYTES = 32 << 20
SALTS = 32
SAME_ON = 3  # pages from which a text that is the same on all is taken for the frame

# Elements by what they mean for the text of a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noframes template svg math".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rt s "
    "samp small span strike strong sub sup time tt u var".split()
)
CLOSES_P = set(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_LEVEL = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPE = set("html body article section div table ul ol dl main aside nav td th".split())
FRAME_TAGS = set(
    "head nav header footer aside form script style noscript iframe template button select option "
    "textarea title svg math dialog menu object".split()
)
FRAME_WORDS = set(
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead banner topbar footer "
    "sidebar aside widget ad ads adv advert adverts advertisement advertisements advertising sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice alert newsletter subscribe "
    "subscription popup modal overlay comment comments disqus respond reply replies social share "
    "sharing related recommended login signup search pagination pager toolbar copyright".split()
)
# Parts that a name of frame may have besides: others say what a block is about.
FILLER_WORDS = set(
    "site page main top bottom left right box block bar wrap wrapper container section area list "
    "item items link links post posts article articles slot unit inner outer content form button "
    "buttons icons global primary secondary mobile desktop sticky fixed".split()
)
COMMENT_WORDS = set("comment comments reply replies respond disqus".split())
MAIN_WORDS = set("article content post entry story main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


@dataclass
class Element:
    """A tag with its children; a child that is a string is text."""

    name: str
    words: frozenset[str] = frozenset()
    children: list = field(default_factory=list)

    @property
    def kind(self) -> str:
        marks = sorted(self.words & (FRAME_WORDS | MAIN_WORDS))
        return ".".join([self.name, *marks])


def _words(attributes: str) -> frozenset[str]:
    found = set()
    for _, value in ATTRIBUTE.findall(attributes):
        for name in value.strip("\"'").split():
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", name)
            parts = {p for p in re.split(r"[^a-z0-9]+", spaced.lower()) if not p.isdigit()} - {""}
            # "related-posts" is frame, "related-work" is not.
            known = parts <= FRAME_WORDS | FILLER_WORDS
            found |= parts if known else parts - FRAME_WORDS
    return frozenset(found)


def parse(page: str) -> Element:
    """The tree of a page; end tags that are missing are put where browsers put them."""
    root = Element("#root")
    stack = [root]
    at, size = 0, len(page)
    while at < size:
        token = TOKEN.match(page, at)
        at = token.end()
        if token[7] is not None:
            stack[-1].children.append(token[7])
            continue
        name = token[2] or token[5]
        if name is None:
            continue  # comment or declaration
        name = name.lower()
        closing = bool(token[1] or token[4])
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if name in INLINE and stack[depth].name in SCOPE:
                    break
            continue
        if name in CLOSES_P:
            _close(stack, {"p"})
        if name in SAME_LEVEL:
            _close(stack, SAME_LEVEL[name])
        attributes = token[3] or token[6] or ""
        element = Element(name, _words(attributes) if attributes else frozenset())
        stack[-1].children.append(element)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = size if end is None else page.find(">", end.start()) + 1 or size
        elif name not in VOID and not attributes.endswith("/"):
            stack.append(element)
    return root


def _close(stack: list[Element], names: set[str]) -> None:
    """End an open element of one of these names, if no other block is open within it."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name in names:
            del stack[depth:]
            return
        if stack[depth].name not in INLINE:
            return


# A wrapper node: [kind, optional, repeated, pages, text or null if it varies, text size, children].
KIND, OPTIONAL, REPEATED, PAGES, TEXT, SIZE, CHILDREN = range(7)


def _text(element: Element) -> str:
    """The text of an element that is not in a child of its own line."""
    parts = []
    for child in element.children:
        if isinstance(child, str):
            parts.append(entities.unescape(child))
        elif child.name in INLINE:
            parts.append(_text(child))
        else:
            parts.append(" ")
    return " ".join("".join(parts).split())


def expression(element: Element) -> list:
    """The wrapper of a single page."""
    text = _text(element)
    children = []
    for child in _lines(element):
        new = expression(child)
        if children and _alike(children[-1], new):
            children[-1] = _merge(children[-1], new, together=True)
        else:
            children.append(new)
    return [element.kind, 0, 0, 1, _short(text), len(text), children]


def _lines(element: Element) -> Iterator[Element]:
    """Children that are elements of their own line, also those inside inline ones."""
    for child in element.children:
        if isinstance(child, Element):
            if child.name not in INLINE or child.words & FRAME_WORDS:
                yield child
            else:
                yield from _lines(child)


def _short(text: str) -> str:
    return text if len(text) <= 200 else f"{text[:200]}#{len(text)}"


def _alike(a: list, b: list) -> bool:
    """Whether two neighbours are one thing repeated: one kind, with children of the same kinds."""
    return a[KIND] == b[KIND] and [c[KIND] for c in a[CHILDREN]] == [c[KIND] for c in b[CHILDREN]]


def _merge(a: list, b: list, together: bool = False) -> list:
    """One node for both; ``together`` if they are neighbours, which makes a group."""
    return [
        a[KIND],
        a[OPTIONAL] | b[OPTIONAL],
        int(together) | a[REPEATED] | b[REPEATED],
        max(a[PAGES], b[PAGES]) if together else a[PAGES] + b[PAGES],
        a[TEXT] if a[TEXT] == b[TEXT] else None,
        a[SIZE] + b[SIZE],
        _align(a[CHILDREN], b[CHILDREN]),
    ]


def _align(a: list[list], b: list[list]) -> list[list]:
    """Children of two nodes in one row: equal kinds meet, the others become optional.

    The longest common row of kinds decides, however wide the nodes are.
    """
    left, right = [n[KIND] for n in a], [n[KIND] for n in b]
    if left == right:
        return [_merge(x, y) for x, y in zip(a, b, strict=True)]
    pairs = _common(left, right)
    out, i, j = [], 0, 0
    for x, y in [*pairs, (len(a), len(b))]:
        out += [[n[KIND], 1, *n[2:]] for n in (*a[i:x], *b[j:y])]
        if x < len(a):
            out.append(_merge(a[x], b[y]))
        i, j = x + 1, y + 1
    folded: list[list] = []
    for node in out:
        if folded and _alike(folded[-1], node):
            folded[-1] = _merge(folded[-1], node, together=True)
        else:
            folded.append(node)
    return folded


def _common(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common row: the first that are equal meet, and ``left``
    gives way first.

    Row i has a bit for each place of ``right``, set where the longest common row of what
    follows in both grows by none. Few rows are kept; the rest are made again from these.
    """
    n, m = len(left), len(right)
    full = (1 << m) - 1
    places: dict[str, int] = {}
    for j, kind in enumerate(right):
        places[kind] = places.get(kind, 0) | 1 << (m - 1 - j)

    def before(row: int, kind: str) -> int:
        same = row & places.get(kind, 0)
        return ((row + same) | (row - same)) & full

    step = max(1, math.isqrt(n))
    kept, row = {n: full}, full
    for i in range(n - 1, -1, -1):
        row = before(row, left[i])
        if i % step == 0:
            kept[i] = row
    rows: dict[int, int] = {}

    def longest(i: int, j: int) -> int:
        if i not in rows:
            at = min(n, (i // step + 1) * step)
            rows.clear()
            rows[at] = kept[at]
            for up in range(at - 1, i - 1, -1):
                rows[up] = before(rows[up + 1], left[up])
        return m - j - (rows[i] & ((1 << (m - j)) - 1)).bit_count()

    pairs, i, j = [], 0, 0
    while i < n and j < m:
        if left[i] == right[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif longest(i + 1, j) >= longest(i, j + 1):
            i += 1
        else:
            j += 1
    return pairs


def merge(wrappers: list[str]) -> str:
    """One wrapper that fits all pages that any of these fits."""
    whole = None
    for text in sorted(wrappers):
        node = json.loads(text)
        whole = node if whole is None else _merge(whole, node)
    return json.dumps(whole, ensure_ascii=False, separators=(",", ":"))


def as_expression(node: list) -> str:
    """A wrapper as people read it: (...)? optional, (...)+ repeated, # a text slot."""
    text = "#" if node[TEXT] is None else node[TEXT]
    inner = text + "".join(as_expression(c) for c in node[CHILDREN])
    mark = ("+" if node[REPEATED] else "") + ("?" if node[OPTIONAL] else "")
    whole = f"<{node[KIND]}>{inner}</{node[KIND]}>"
    return f"({whole}){mark}" if mark else whole


def _is_frame(kind: str, inside_main: bool) -> bool:
    """Whether an element of this kind is menu, advert, comments and the like."""
    name, *words = kind.split(".")
    if name in FRAME_TAGS and not (name == "header" and inside_main):
        return True
    if name in ("article", "main"):
        return bool(COMMENT_WORDS & set(words))
    if name in ("html", "body", "#root"):
        return False
    return bool(FRAME_WORDS & set(words)) and not (inside_main and "header" in words)


def _rank(kind: str) -> int:
    """How sure an element of this kind is the article: 3 most, 0 not at all."""
    name, *words = kind.split(".")
    if name in ("article", "main"):
        return 3 if name == "article" else 2
    if name in ("html", "body", "#root") or name in INLINE:
        return 0
    return int(bool(MAIN_WORDS & set(words)) and not FRAME_WORDS & set(words))


def plan(wrapper: str) -> str:
    """What extraction needs of a wrapper: the path of the article, and the paths and texts of
    the frame where there is no element that says it is the article."""
    root = json.loads(wrapper)
    best: tuple[int, int, str] = (0, 0, "")
    same: dict[str, list[str]] = {}

    def walk(node: list, path: str, pages: int) -> int:
        nonlocal best
        size = node[SIZE]
        if not node[REPEATED] and node[TEXT] and node[PAGES] >= max(SAME_ON, pages):
            same.setdefault(path, []).append(node[TEXT])
        for child in node[CHILDREN]:
            if not _is_frame(child[KIND], False):
                size += walk(child, f"{path}>{child[KIND]}", pages)
        if rank := _rank(node[KIND]):
            best = max(best, (rank, size, path))
        return size

    walk(root, root[KIND], root[PAGES])
    if best[0] >= 2:
        same = {}
    return json.dumps({"main": best[2] or None, "same": same}, ensure_ascii=False)


def extract(page: str | None, wrapper_plan: str | None) -> str:
    """The text of the article, a line for each block."""
    if not page:
        return ""
    root = _flat(parse(page))
    wanted = json.loads(wrapper_plan) if wrapper_plan else {"main": None, "same": {}}
    found: list[tuple[int, Element]] = []

    def look(element: Element, path: str) -> None:
        rank = 4 if path == wanted["main"] else _rank(element.kind)
        if rank:
            found.append((rank, element))
        for child in element.children:
            if isinstance(child, Element) and not _is_frame(child.kind, False):
                look(child, f"{path}>{child.kind}")

    look(root, root.kind)
    top = max((r for r, _ in found), default=0)
    main = {id(e) for r, e in found if r == top}
    if not main:
        # A wrapping element may carry a name of the frame; then look for the article in it.
        inside = [e for e in _everything(root) if _rank(e.kind) >= 2]
        main = {id(e) for e in inside if not COMMENT_WORDS & e.words}
    same = wanted["same"] if not main or top < 2 else {}
    lines: list[str] = []
    parts: list[str] = []

    def flush(path: str) -> None:
        line = " ".join("".join(parts).split())
        parts.clear()
        if line and _short(line) not in same.get(path, ()):
            lines.append(line)

    def read(element: Element, path: str, kept: bool) -> None:
        kept = kept or id(element) in main or (not main and element is root)
        for child in element.children:
            if isinstance(child, str):
                if kept:
                    parts.append(entities.unescape(child))
                continue
            if _is_frame(child.kind, kept and bool(main)) and (
                kept or not any(id(e) in main for e in _everything(child))
            ):
                continue
            if child.name == "br":
                parts.append(" ")
            elif child.name in INLINE:
                read(child, f"{path}>{child.kind}", kept)
            else:
                flush(path)
                read(child, f"{path}>{child.kind}", kept)
                flush(f"{path}>{child.kind}")

    read(root, root.kind, False)
    flush(root.kind)
    return "\n".join(lines)


def _everything(element: Element) -> Iterator[Element]:
    waiting = [element]
    while waiting:
        one = waiting.pop()
        yield one
        waiting += [c for c in one.children if isinstance(c, Element)]


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


DEPTH = 200


def _flat(element: Element) -> Element:
    """Cut nesting that is deeper than any page for people: inner elements move up."""
    waiting = [(element, 1)]
    while waiting:
        one, depth = waiting.pop()
        if depth >= DEPTH:
            flat: list = []
            inner = list(reversed(one.children))
            while inner:
                child = inner.pop()
                if isinstance(child, str) or not child.children:
                    flat.append(child)
                else:
                    flat.append(Element(child.name, child.words, []))
                    inner += reversed(child.children)
            one.children = flat
        else:
            waiting += [(c, depth + 1) for c in one.children if isinstance(c, Element)]
    return element


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from all of ``pages`` (host, html)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            hosts: dict[str, list] = {}
            for host, page in zip(batch["host"].to_pylist(), batch["html"], strict=True):
                own = expression(_flat(parse(page.as_py() or "")))
                hosts[host] = _merge(hosts[host], own) if host in hosts else own
            texts = [json.dumps(w, ensure_ascii=False, separators=(",", ":")) for w in hosts.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(hosts), pa.string()), pa.array(texts, pa.string())],
                names=["host", "wrapper"],
            )

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": group["host"][:1], "wrapper": [merge(list(group["wrapper"]))]})

    kind = "host string, wrapper string"
    found = pages.select("host", "html").mapInArrow(run, kind)
    salt = F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))
    some = found.groupBy("host", salt.alias("salt")).applyInPandas(meet, kind)
    return some.groupBy("host").applyInPandas(meet, kind)


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html").withColumn("host", host_of("url"))

    def plans(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            made = [plan(w) for w in batch["wrapper"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["host"], pa.array(made, pa.string())], names=["host", "plan"]
            )

    wrapped = materialise(infer(pages).mapInArrow(plans, "host string, plan string"), "plans")
    size = wrapped.agg(F.sum(F.octet_length("plan") + F.octet_length("host") + 64)).first()[0] or 0
    met = pages.join(F.broadcast(wrapped) if size <= BROADCAST_BYTES else wrapped, "host", "left")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = [
                extract(page.as_py(), wrapper)
                for page, wrapper in zip(batch["html"], batch["plan"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"],
                    batch["url"],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return met.select("page_id", "url", "html", "plan").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
