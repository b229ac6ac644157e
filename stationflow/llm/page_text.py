"""Main text of web pages by wrappers: union-free expressions inferred from a host's pages.

A page is a stream of tags and texts.  Where the stream repeats itself it is folded into
a repeated group; two streams are aligned element by element, what only one of them has
becomes optional, and texts that differ become a text slot.  A host's wrapper is the
alignment of all its pages: every task aligns the pages it reads, and the tasks'
wrappers are aligned again in groups of bounded size until one is left per host, so a
host of any size costs a wrapper per task, never its pages in one place.

The slots of a wrapper are then told apart: those in regions that are named as menus,
headers, footers, sidebars, notices, adverts, forms or comments, and texts that all of a
host's pages share, are left out; the others belong to the article, the main region or,
without either, the element that holds most of the text that varies.  A page is
aligned with its host's wrapper, and the texts in slots of the article are its main text.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.scratch import Scratch, bounded_broadcast

ship(__name__)

#: Longest repeated run of siblings that is looked for, and siblings beyond which those of one kind are put together.
UNIT, FLOW = 8, 16
#: Elements nested deeper count as parts of their ancestor at this depth.
DEPTH = 100
#: Hosts whose wrappers a task holds at a time, and wrappers that are aligned in one group.
HOSTS, GROUP = 2000, 32
#: Pages after which a text that all of them share is part of the template.
SHARED = 5

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_DIGITS, _PARTS = re.compile(r"\d+"), re.compile(r"[^a-z]+")

_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_VOID = {"area", "base", "col", "embed", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
_CONTAINERS = {"html", "body", "main", "div", "section", "center", "table", "tbody", "tr", "td"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements whose end tag may be left out: what a new one ends, and what that can't reach out of.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

#: Elements, and words in their classes, ids and roles, that name a region as no part of an article.
_LEFT_OUT = set(
    "aside button canvas dialog footer form head iframe menu nav noscript object option script select style svg "
    "template textarea title label".split()
)
_NAMES = set(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion banner "
    "menu menus submenu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer footers "
    "masthead topbar toolbar cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal "
    "overlay newsletter subscribe subscription signup login search searchbox social share sharing related recommended "
    "recommendations trending popular comment comments commentlist disqus reply replies respond pagination pager tagcloud "
    "skip copyright contentinfo complementary form forms".split()
)
_HEADER_NAMES = {"header", "headers"}
#: These before a name say something of a layout: "with-sidebar".
_LAYOUT = {"with", "has", "no", "without", "is", "not", "hide"}
_WHOLE = {"html", "body", "main"}
_ARTICLE_LEFT_OUT = {"comment", "comments", "ad", "ads", "advert", "sponsored", "related", "promo", "reply"}
_BODY_NAMES = re.compile(r"(?:article|post|entry|story|main|page)-?(?:body|content|text)?|content")


# --- a page as a folded tree -------------------------------------------------
#
# Nodes are lists: ["t", optional, digest, pages, chars, link chars, refs] for a text slot,
# ["e", optional, signature, body] for an element, ["+", optional, body] for a repeated group,
# ["*", optional, body] for a repeated group of optional parts in any order.


def _key(node: list) -> str:
    kind = node[0]
    if kind == "e":
        return node[2]
    if kind == "t":
        return "#"
    return "(" + " ".join(map(_key, node[2])) + ")+" if kind == "+" else "*"


def _merged(x: list, y: list, pages: bool) -> list:
    """The alignment of two nodes of one key, the first of which is used up; ``pages``: they are of different pages."""
    optional = x[1] or y[1]
    if x[0] == "t":
        digest = x[2] if x[2] == y[2] else None
        count = x[3] + y[3] if pages else max(x[3], y[3])
        x[6].extend(y[6])
        return ["t", optional, digest, count, x[4] + y[4], x[5] + y[5], x[6], *(x[7:] or y[7:])]
    if x[0] == "e":
        return ["e", optional, x[2], _aligned(x[3], y[3], pages)]
    return [x[0], optional, _aligned(x[2], y[2], pages)]


def _grouped(unit: list[list]) -> list:
    return ["+", any(n[1] for n in unit) and all(n[1] for n in unit), unit]


def _fold(body: list[list], pages: bool) -> list[list]:
    """``body`` with runs of siblings that repeat as groups, and lone ones of a group's kind taken into it."""
    for _ in range(6):
        before = len(body)
        keys = [_key(n) for n in body]
        for width in range(1, min(UNIT, len(body) // 2) + 1):
            body, keys = _tandem(body, keys, width, pages)
        # a lone element elsewhere that a group repeats becomes a group of one
        units = {_key(n[2][0]) for n in body if n[0] == "+" and len(n[2]) == 1}
        if units and any(k in units for k in keys):
            body = [["+", n[1], [n]] if k in units else n for n, k in zip(body, keys, strict=True)]
        elif len(body) == before:
            break
    if len(body) > FLOW and len(set(map(_key, body))) < len(body):
        return _flow(body, pages)
    return body


def _tandem(body: list[list], keys: list[str], width: int, pages: bool) -> tuple[list, list]:
    found, names, i, n = [], [], 0, len(body)
    while i < n:
        unit = keys[i : i + width]
        if i + 2 * width > n or keys[i + width : i + 2 * width] != unit:
            found.append(body[i])
            names.append(keys[i])
            i += 1
            continue
        whole = body[i : i + width]
        i += width
        while keys[i : i + width] == unit and i + width <= n:
            whole = [_merged(x, y, pages) for x, y in zip(whole, body[i : i + width], strict=True)]
            i += width
        node = whole[0] if width == 1 and whole[0][0] in "t+*" else _grouped(whole)
        found.append(node)
        names.append(_key(node))
    return found, names


def _flow(body: list[list], pages: bool) -> list[list]:
    """All kinds of siblings once each, as a repeated group of optional parts."""
    parts: dict[str, list] = {}

    def add(nodes: list[list]) -> None:
        for node in nodes:
            if node[0] in "+*":
                add(node[2])
            else:
                k = _key(node)
                node = [node[0], True, *node[2:]]
                parts[k] = _merged(parts[k], node, pages) if k in parts else node

    add(body)
    return [["*", False, list(parts.values())]]


def _aligned(a: list[list], b: list[list], pages: bool) -> list[list]:
    """The alignment of two bodies: parts of one key meet in order, others are optional."""
    if not a and not b:
        return []
    if any(n[0] == "*" for body in (a, b) for n in body):
        return _flow(a + b, pages)
    units = {_key(n[2][0]) for n in a + b if n[0] == "+" and len(n[2]) == 1}
    a, b = ([["+", n[1], [n]] if _key(n) in units else n for n in body] for body in (a, b))
    x, y = [_key(n) for n in a], [_key(n) for n in b]
    if x == y:
        return [_merged(m, n, pages) for m, n in zip(a, b, strict=True)]
    found = []
    for tag, i, j, k, m in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if tag == "equal":
            found += [_merged(p, q, pages) for p, q in zip(a[i:j], b[k:m], strict=True)]
        else:
            found += [[n[0], True, *n[2:]] for n in a[i:j] + b[k:m]]
    return _fold(found, pages)


def _signature(tag: str, attributes: str) -> str:
    """The element's name with its classes, id, role and itemprop; numbers in them don't count."""
    found = []
    for m in _ATTRIBUTE.finditer(attributes):
        value = _DIGITS.sub("#", html.unescape(m[2] or m[3] or m[4] or "").lower())
        found += [f"{m[1].lower()}={word}" for word in value.split()]
    return " ".join([tag, *sorted(set(found))])


class _Parser:
    """A page's tags and texts as a folded tree; ``texts`` are its blocks in page order."""

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.stack: list[tuple[str, str, list]] = [("", "", [])]
        self.run: list[str] = []
        self.links = self.inside = 0
        at, raw = 0, None
        for m in _MARKUP.finditer(page):
            if m.start() < at:
                continue
            if raw is None and m.start() > at:
                self.text(page[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                if m[0].startswith("<![CDATA["):
                    self.text(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:], plain=True)
                continue
            if m[1] or m[4]:
                self.end(name)
                continue
            attributes = m[3] or m[6] or ""
            if name in _RAW:
                closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = closing.start() if closing else len(page)
                continue
            self.start(name, attributes)
        if at < len(page):
            self.text(page[at:])
        while len(self.stack) > 1:
            self.close()
        self.block()
        self.body = _fold(self.stack[0][2], False)

    def text(self, raw: str, plain: bool = False) -> None:
        found = raw if plain else html.unescape(raw)
        self.run.append(found)
        if self.inside:
            self.links += len("".join(found.split()))

    def block(self) -> None:
        """End the run of text at hand: it is a text slot of the element that is open."""
        if self.run:
            whole = " ".join("".join(self.run).split())
            if whole:
                size = len(whole) - whole.count(" ")
                digest = zlib.crc32(whole.encode("utf-8", "replace"))
                slot = ["t", False, digest, 1, size, min(size, self.links), [len(self.texts)]]
                self.stack[-1][2].append(slot)
                self.texts.append(whole)
            self.run, self.links = [], 0

    def start(self, name: str, attributes: str) -> None:
        if name in ("br", "hr"):
            self.run.append(" ")
            if name == "hr":
                self.block()
        elif name == "a":
            self.inside = 1
        elif name in _INLINE or name in _VOID:
            return
        else:
            self.block()
            if any(s[0] == "p" for s in self.stack[-1:]):
                self.close()
            if name in _IMPLIED:
                ends, bars = _IMPLIED[name]
                for i in range(len(self.stack) - 1, 0, -1):
                    if self.stack[i][0] in bars:
                        break
                    if self.stack[i][0] in ends:
                        while len(self.stack) > i:
                            self.close()
                        if name != "tr":
                            break
            if not attributes.endswith("/") or name not in ("svg", "path"):
                self.stack.append((name, _signature(name, attributes), []))

    def end(self, name: str) -> None:
        if name == "a":
            self.inside = 0
        elif name in _INLINE or name in _VOID or name in ("br", "hr"):
            if name == "br":
                self.run.append(" ")
        else:
            self.block()
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] == name:
                    while len(self.stack) > i:
                        self.close()
                    break

    def close(self) -> None:
        self.block()
        name, signature, body = self.stack.pop()
        if name == "p" and not body:
            return
        if len(self.stack) > DEPTH:
            self.stack[-1][2].extend(body)
        else:
            self.stack[-1][2].append(["e", False, signature, _fold(body, False)])


def page_tree(page: str | None) -> tuple[list[list], list[str]]:
    """The folded tree of a page and its blocks of text, to which the tree's slots refer by number."""
    parsed = _Parser(page or "")
    return parsed.body, parsed.texts


def _without_refs(body: list[list]) -> list[list]:
    out = []
    for n in body:
        if n[0] == "t":
            out.append([*n[:6], []])
        elif n[0] == "e":
            out.append([*n[:3], _without_refs(n[3])])
        else:
            out.append([*n[:2], _without_refs(n[2])])
    return out


# --- telling the slots apart ---------------------------------------------------

#: Levels of a slot: in an article, in the main region, in a region named like an article's body, in the
#: element that holds most text that varies, elsewhere.  A slot that is left out has none.
ARTICLE, MAIN, NAMED, DENSEST, OTHER = 1, 2, 3, 4, 5


def _described(signature: str) -> tuple[str, list[list[str]], dict[str, set[str]]]:
    tag, *words = signature.split(" ")
    found: dict[str, set[str]] = {}
    for word in words:
        kind, _, value = word.partition("=")
        found.setdefault(kind, set()).add(value)
    parts = [_PARTS.split(v) for kind in ("class", "id", "role") for v in found.get(kind, ())]
    return tag, parts, found


def _role(signature: str) -> tuple[bool, bool, int]:
    """(left out, a header, level) of an element by its name and its classes, id, role and itemprop."""
    tag, parts, attributes = _described(signature)
    names = {p for ps in parts if ps[0] not in _LAYOUT for p in ps}
    if tag == "article":
        return bool(names & _ARTICLE_LEFT_OUT), False, ARTICLE
    if tag in _WHOLE or "main" in attributes.get("role", ()):
        return False, False, MAIN if tag == "main" or "main" in attributes.get("role", ()) else OTHER
    if tag in _LEFT_OUT or names & _NAMES:
        return True, False, OTHER
    if "articlebody" in attributes.get("itemprop", ()) or "article" in attributes.get("role", ()):
        return False, False, ARTICLE
    header = tag == "header" or bool(names & _HEADER_NAMES)
    whole = {"-".join(ps) for ps in parts}
    return False, header, NAMED if not header and any(_BODY_NAMES.fullmatch(w) for w in whole) else OTHER


def labelled(body: list[list], pages: int) -> list[list]:
    """The wrapper with the level of every slot in the place of its statistics (0: left out)."""
    dense = _densest(body)

    def walk(nodes: list[list], level: int, header: bool, heading: bool, inside: bool) -> list[list]:
        out = []
        for n in nodes:
            if n[0] == "t":
                own = DENSEST if level == OTHER and inside else level
                if header and not (heading and level < OTHER):
                    own = 0
                elif not heading and pages >= SHARED and n[2] is not None and n[3] >= pages:
                    own = -own  # the template's own text, if the region has other text
                elif own >= DENSEST and 2 * n[5] > n[4]:
                    own = 0
                out.append(["t", n[1], own, 0, n[4] if n[2] is None else 0, 0, []])
            elif n[0] == "e":
                left_out, is_header, named = _role(n[2])
                deeper = walk(n[3], min(level, named), header or is_header, n[2].split(" ")[0] in _HEADINGS, inside or n is dense)
                out.append([*n[:3], _all_left_out(deeper) if left_out else deeper])
            else:
                out.append([*n[:2], walk(n[2], level, header, heading, inside)])
        return out

    found = walk(body, OTHER, False, False, dense is None)
    varied: set[int] = set()

    def survey(nodes: list[list]) -> None:
        for n in nodes:
            if n[0] == "t":
                if n[2] > 0 and n[4]:
                    varied.add(n[2])
            else:
                survey(n[-1])

    def settle(nodes: list[list]) -> list[list]:
        out = []
        for n in nodes:
            if n[0] == "t":
                level = n[2] if n[2] >= 0 else 0 if -n[2] in varied else -n[2]
                out.append(["t", n[1], level, 0, 0, 0, []])
            else:
                out.append([*n[:-1], settle(n[-1])])
        return out

    survey(found)
    return settle(found)


def _all_left_out(body: list[list]) -> list[list]:
    return [["t", n[1], 0, 0, 0, 0, []] if n[0] == "t" else [*n[:-1], _all_left_out(n[-1])] for n in body]


def _densest(body: list[list]) -> list | None:
    """The deepest element that holds most of the varying text outside of links and left-out regions."""

    def weigh(nodes: list[list]) -> int:
        total = 0
        for n in nodes:
            if n[0] == "t":
                total += max(0, n[4] - 2 * n[5]) if n[2] is None or n[3] < SHARED else 0
            elif n[0] != "e" or not any(_role(n[2])[:2]):
                total += weigh(n[-1])
        return total

    def children(nodes: list[list]) -> Iterator[list]:
        for n in nodes:
            if n[0] == "e":
                if n[2].split(" ")[0] in _CONTAINERS and not any(_role(n[2])[:2]):
                    yield n
            elif n[0] == "*":  # an element of a repeated group is one of many: it doesn't hold the others
                yield from children(n[2])

    at, whole = None, weigh(body)
    while whole:
        best = max(children(body), key=lambda n: weigh(n[3]), default=None)
        if best is None or 2 * weigh(best[3]) <= whole:
            break
        at, body = best, best[3]
    return at


def main_text(wrapper: list[list], page: str | None) -> str:
    """Align a page with its host's labelled wrapper and join the blocks in the slots of its main region."""
    tree, texts = page_tree(page)
    levels: dict[int, list[int]] = {}

    def collect(nodes: list[list], level: int | None) -> None:
        for n in nodes:
            if n[0] == "t":
                for ref in n[6]:
                    levels.setdefault(n[7] if len(n) > 7 else level or OTHER, []).append(ref)
            else:
                collect(n[-1], level)

    collect(_aligned(_as_slots(wrapper), tree, True), None)
    chosen = next((levels[k] for k in (ARTICLE, MAIN, NAMED, DENSEST, OTHER) if levels.get(k)), [])
    return " ".join(texts[i] for i in sorted(chosen))


def _as_slots(body: list[list]) -> list[list]:
    """A labelled wrapper as a tree to align with: the level is carried behind the refs."""
    return [["t", n[1], None, 0, 0, 0, [], n[2]] if n[0] == "t" else [*n[:-1], _as_slots(n[-1])] for n in body]


# --- Spark ---------------------------------------------------------------------

_PARTIAL = "host string, pages long, wrapper string"


def _record(rows: list[tuple]) -> pa.RecordBatch:
    hosts, pages, wrappers = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array([json.dumps(w) for w in wrappers], pa.string())],
        names=["host", "pages", "wrapper"],
    )


def _task_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wrappers of the pages a task reads: (host, pages, wrapper)."""
    known: dict[str, tuple[int, list]] = {}
    for batch in batches:
        for host, page in zip(batch.column(0), batch.column(1), strict=True):
            name, body = host.as_py(), _without_refs(page_tree(page.as_py())[0])
            count, before = known.get(name, (0, None))
            known[name] = (count + 1, body if before is None else _aligned(before, body, True))
            if len(known) >= HOSTS:
                yield _record([(h, n, w) for h, (n, w) in known.items()])
                known = {}
    if known:
        yield _record([(h, n, w) for h, (n, w) in known.items()])


def _align_group(key: tuple, rows: pa.Table) -> pa.Table:
    wrappers = sorted(zip(rows["wrapper"].to_pylist(), rows["pages"].to_pylist(), strict=True))
    whole, total = json.loads(wrappers[0][0]), wrappers[0][1]
    for text, pages in wrappers[1:]:
        whole, total = _aligned(whole, json.loads(text), True), total + pages
    return pa.Table.from_batches([_record([(key[0].as_py(), total, whole)])])


def host_of(url):
    """The host of a URL column in lower case, without user and port; empty where there is none."""
    found = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def host_wrappers(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, pages, wrapper) of all ``pages`` (host, html): one wrapper as JSON per host."""
    found = scratch.table(pages.select("host", "html").mapInArrow(_task_wrappers, _PARTIAL), "wrappers")
    while True:
        counts = scratch.table(found.groupBy("host").agg(F.count("*").alias("n")), "counts")
        if (counts.agg(F.max("n").alias("n")).first()["n"] or 0) <= 1:
            return found
        groups = F.ceil(F.col("n") / GROUP)
        dealt = found.join(bounded_broadcast(counts, F.octet_length("host") + 24), "host").withColumn(
            "deal", F.pmod(F.xxhash64("wrapper", "pages"), groups)
        )
        found = scratch.table(
            dealt.select("host", "deal", "pages", "wrapper").groupBy("host", "deal").applyInArrow(_align_group, _PARTIAL),
            "wrappers",
        )


def _label_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [json.dumps(labelled(json.loads(w), n)) for n, w in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["host", "wrapper"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list] = {}
    for batch in batches:
        texts = []
        for page, wrapper in zip(batch.column(2), batch.column(3), strict=True):
            name = wrapper.as_py()
            if name not in known:
                if len(known) >= HOSTS:
                    known.clear()
                known[name] = json.loads(name)
            texts.append(main_text(known[name], page.as_py()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def page_texts(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): its main text and how many characters it has.

    Columns: page_id, url, text (blocks of the main region in page order, joined by one
    space; white space in a block is one space; empty if there is none), n_chars.

    A null or empty page has an empty text.  Pages without a host share a wrapper.
    Repeated rows, and rows with a null page_id, each get a row of their own.  Very long
    pages are read whole.  A host with one page is its own wrapper.  An empty table gives
    no rows; further columns are not read.
    """
    scratch = Scratch(pages.sparkSession, "page-text")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host")
    )
    wrappers = host_wrappers(rows, scratch)
    labels = scratch.table(wrappers.mapInArrow(_label_rows, "host string, wrapper string"), "labelled")
    width = F.octet_length("host") + F.octet_length("wrapper") + 64
    joined = rows.join(bounded_broadcast(labels, width), "host").select("page_id", "url", "html", "wrapper")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
