"""Main text of web pages, by wrappers inferred from all pages of the same host.

A wrapper is a union-free regular expression over tags and texts, kept as a
tree: elements in order, each possibly optional or repeated, with constant texts
and text slots.  Pages are aligned with it one after the other, first within a
task, then those of a host.  Constant texts are the template and go; where pages
mark no article, the slots with most text tell its container.

What varies and still is no article (adverts, comments, menus) cannot be told by
alignment.  For these, elements and roles of HTML and a list of usual class and
id names decide; names never decide against a heading, and only when they say
nothing else against an article or a paragraph.
"""

from __future__ import annotations

import html
import json
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.llm.columns import slices
from talkatlas.runtime import stored

# Hosts whose wrappers a task holds at once.
HELD_HOSTS = 2_000
# A text is part of the template if this many different pages agree on it.
TEMPLATE_PAGES = 3
# The part of the varying text that the main container has to hold.
MAIN_SHARE = 0.6

# Fixed values of HTML: which elements are void, hold raw text, or form blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul head optgroup option select button iframe object video audio canvas svg template noscript".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())
# Elements, roles and name parts of what is not the article.
NOT_MAIN = set("head nav footer aside form button select script style noscript template iframe object svg canvas textarea dialog menu input".split())
NOT_MAIN_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOT_MAIN_NAMES = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side rail menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login comment comments disqus replies reply respond share sharing social related recommended "
    "recommendations teaser widget pagination pager search skip announcement announcements copyright toolbar paywall".split()
)
# Name parts that begin or end like this count as well, but for the words after them.
NOT_MAIN_BEGINS = ("advert", "breadcrumb", "comment", "cookie", "disqus", "navig", "newsletter", "popup", "sidebar", "sponsor", "subscri")
NOT_MAIN_ENDS = ("banner", "comments", "footer", "menu", "nav", "popup", "sidebar")
MAIN_NAMES = set("commentary commentator".split())
# Name parts that add nothing to those around them, and those that say what a page has rather than what a part is.
NEUTRAL_NAMES = set(
    "a area b bar block bottom box btn button buttons c center col column container content entry first form group head i id inner item items "
    "js large last layout left link links list m main mobile module outer page panel post posts primary region right row section secondary "
    "site slot small sub text this title top unit user view wrap wrapper x".split()
)
STATE_NAMES = set("has with without no is not".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_NAME_PARTS = re.compile(r"[a-z]+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


@dataclass
class Element:
    """An open element: its key (name and classes), and whether it is the article or apart from it.

    ``spare`` marks an article inside something that only its name sets apart.
    """

    name: str
    key: str
    main: bool
    apart: bool
    named: bool = False
    spare: bool = False


def _tells(part: str, inside: bool) -> bool:
    # The title of an article often stands in a header of its own.
    if part in MAIN_NAMES or part == "header" and inside:
        return False
    return part in NOT_MAIN_NAMES or part.startswith(NOT_MAIN_BEGINS) or part.endswith(NOT_MAIN_ENDS)


def _apart_by_name(names: str, inside: bool, strict: bool) -> bool:
    """Whether some name says that this is not the article.

    A strict name has no other meaning: each of its parts says so.  Inside an
    article parts without a meaning may stand beside.
    """
    for token in names.split():
        parts = _NAME_PARTS.findall(token)
        told = [_tells(p, inside) for p in parts]
        if not any(told) or STATE_NAMES & set(parts):
            continue
        if all(told) or not strict and (not inside or all(t or p in NEUTRAL_NAMES for t, p in zip(told, parts, strict=True))):
            return True
    return False


def _opened(name: str, rest: str, above: Element | None) -> Element:
    found = {}
    if len(rest) > 1:
        for attribute, *values in _ATTRIBUTE.findall(rest):
            found.setdefault(attribute.lower(), next((v for v in values if v), "").lower())
    role = found.get("role", "")
    names = f"{found.get('class', '')} {found.get('id', '')}"
    inside = above is not None and above.main
    article = name in ("article", "main") or role in ("main", "article")
    apart = above is not None and above.apart
    named, spare = (above.named, above.spare) if above is not None else (False, False)
    firm = (
        name in NOT_MAIN
        or (name == "header" and not inside)
        or role in NOT_MAIN_ROLES
        or "hidden" in found
        or found.get("aria-hidden") == "true"
    )
    by_name = name not in ("html", "body") and name not in HEADINGS and _apart_by_name(names, inside, article or name in PROSE)
    if not apart:
        apart, named = firm or by_name, by_name and not firm
    elif firm or by_name:
        named = spare = False
    elif article and named and not inside:
        spare = True
    main = inside or (not apart and article)
    key = f"{name}.{'.'.join(found.get('class', '').split())}" if found.get("class") else name
    return Element(name, key, main, apart, named, spare)


def _closed_before(stack: list[Element], name: str) -> int:
    """The length of the stack after the elements that an opening ``name`` closes."""
    if name in ("li", "option", "tr", "td", "th", "dt", "dd"):
        same = {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(name, (name,))
        stops = ("ul", "ol", "menu", "table", "dl", "select")
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in same:
                return i
            if stack[i].name in stops:
                break
    if name in BLOCKS:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name == "p":
                return i
            if stack[i].name in BLOCKS:
                break
    return len(stack)


def events(page: str):
    """``(kind, value, stack)`` for each open, close and text of a page; tolerant of missing ends."""
    stack: list[Element] = []
    at = 0
    while at < len(page):
        match = _TOKEN.search(page, at)
        end = match.start() if match else len(page)
        if end > at:
            yield "text", html.unescape(page[at:end]), stack
        if not match:
            break
        at = match.end()
        name = (match.group(2) or "").lower()
        if not name:
            if match.group().startswith("<![CDATA["):
                yield "text", match.group()[9:].removesuffix("]]>"), stack
            continue
        if match.group(1):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
            if depth is not None:
                yield "close", name, stack
                del stack[depth:]
            elif name in ("p", "br"):
                yield "void", name, stack
            continue
        if name in VOID:
            yield "void", name, stack
            continue
        del stack[_closed_before(stack, name) :]
        stack.append(_opened(name, match.group(3), stack[-1] if stack else None))
        yield "open", name, stack
        if name in RAW:
            close = _RAW_END[name].search(page, at)
            if name in ("textarea", "title") and not stack[-1].apart:
                yield "text", html.unescape(page[at : close.start() if close else len(page)]), stack
            at = close.start() if close else len(page)


def blocks(page: str):
    """``(text, path, main, apart, spare, linked)`` for each block of text, in order.

    ``path`` has the keys of the block elements around it; ``linked`` counts
    the characters inside links.
    """
    parts: list[str] = []
    state, linked = None, 0

    def block():
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        size, linked = linked, 0
        return (text, *state, size) if text and state else None

    for kind, value, stack in events(page):
        if kind == "text":
            if not parts or state is None:
                around = [e for e in stack if e.name in BLOCKS]
                last = stack[-1] if stack else Element("", "", False, False)
                state = ("/".join(e.key for e in around), last.main, last.apart, last.spare)
            elif stack and stack[-1].apart != state[2]:
                # An inline part that does not belong, or the return from one.
                if found := block():
                    yield found
                around = [e for e in stack if e.name in BLOCKS]
                state = ("/".join(e.key for e in around), stack[-1].main, stack[-1].apart, stack[-1].spare)
            parts.append(value)
            if any(e.name == "a" for e in stack):
                linked += len(value)
        elif value == "br":
            if parts:
                parts.append("\n")
        elif value in BLOCKS or kind == "void" and value == "hr":
            if found := block():
                yield found
    if found := block():
        yield found


@dataclass
class Node:
    """A part of a wrapper: an element with its parts, or a text, a slot where ``text`` is None.

    Texts are kept as hashes.  ``weight`` counts the characters outside links
    on pages that mark no article; ``seen`` names some different pages with
    this part, as many as a template needs.
    """

    key: str
    text: int | None = None
    parts: list[Node] = field(default_factory=list)
    optional: bool = False
    repeated: bool = False
    weight: int = 0
    seen: set[int] = field(default_factory=set)

    def pattern(self) -> str:
        """The regular expression."""
        inner = "".join(p.pattern() for p in self.parts)
        shown = f"<{self.key}>{inner}</>" if self.key != "#" else "#TEXT" if self.text is None else f"[{self.text:x}]"
        return f"({shown})+" if self.repeated else f"({shown})?" if self.optional else shown

    def packed(self) -> list:
        parts = [p.packed() for p in self.parts]
        return [self.key, self.text, parts, int(self.optional), int(self.repeated), self.weight, sorted(self.seen)]


def unpacked(values: list) -> Node:
    key, text, parts, optional, repeated, weight, seen = values
    return Node(key, text, [unpacked(p) for p in parts], bool(optional), bool(repeated), weight, set(seen))


def digest(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1


def tree(page: str) -> Node:
    """The blocks of a page as a tree, repeated neighbours folded.

    Paragraphs, headings and list items are the text of the part around them:
    how many there are and in what order is up to the article.
    """
    seen, found = {digest(page)}, [b for b in blocks(page) if not b[3]]
    marked = any(b[2] for b in found)
    top = Node("", seen=set(seen))
    for text, path, _, _, _, linked in found:
        weight = 0 if marked else max(len(text) - linked, 0)
        at = top
        at.weight += weight
        for key in path.split("/"):
            if key.split(".")[0] in PROSE:
                key = "*"
            if not at.parts or at.parts[-1].key != key:
                at.parts.append(Node(key, seen=set(seen)))
            at = at.parts[-1]
            at.weight += weight
            if key == "*":
                break
        at.parts.append(Node("#", None if at.key == "*" else digest(text), weight=weight, seen=set(seen)))
    return _folded(top)


def _folded(node: Node) -> Node:
    """Parts of the same key become one repeated part that matches each of them."""
    known: dict[str, Node] = {}
    for part in map(_folded, node.parts):
        if part.key in known:
            known[part.key] = merged(known[part.key], part)
            known[part.key].repeated = True
        else:
            known[part.key] = part
    node.parts = list(known.values())
    return node


def merged(a: Node, b: Node) -> Node:
    """The wrapper of two parts of the same key.

    Texts that differ become a slot.  Parts are aligned by key; what has no
    partner on the other side is optional.
    """
    text = a.text if a.text == b.text else None
    seen = set(sorted(a.seen | b.seen)[:TEMPLATE_PAGES])
    out = Node(a.key, text, [], a.optional or b.optional, a.repeated or b.repeated, a.weight + b.weight, seen)
    theirs = {p.key: i for i, p in enumerate(b.parts)}
    mine, at = {p.key for p in a.parts}, 0
    for part in a.parts:
        place = theirs.get(part.key)
        if place is None:
            part.optional = True
            out.parts.append(part)
            continue
        # What only the other side has before this part goes before it.
        while at < place:
            if b.parts[at].key not in mine:
                b.parts[at].optional = True
                out.parts.append(b.parts[at])
            at += 1
        at = max(at, place + 1)
        out.parts.append(merged(part, b.parts[place]))
    for rest in b.parts[at:]:
        if rest.key not in mine:
            rest.optional = True
            out.parts.append(rest)
    return out


def _constants(node: Node, path: tuple[str, ...], inside: bool):
    """Texts that all pages share, outside of repeated and optional parts."""
    for part in node.parts:
        loose = inside or part.repeated or part.optional
        if part.key == "#":
            if part.text is not None and not loose and len(part.seen) >= TEMPLATE_PAGES:
                yield "/".join(path), part.text
        else:
            yield from _constants(part, (*path, part.key), loose)


def _container(node: Node) -> str | None:
    """The path of the deepest part with most of the text of pages that mark no article."""
    least, path = MAIN_SHARE * node.weight, []
    while node.weight:
        node = max((p for p in node.parts if p.key not in ("#", "*")), key=lambda p: p.weight, default=Node(""))
        if node.weight < max(least, 1):
            break
        path.append(node.key)
    return "/".join(path) or None


def decisions(wrapper: Node) -> dict:
    """What the wrapper of a host says: its template texts, and the main container of unmarked pages."""
    return {"template": list(_constants(wrapper, (), False)), "main": _container(wrapper)}


def infer(pages: list[str]) -> Node:
    """The wrapper of some pages."""
    wrapper = None
    for page in pages:
        wrapper = tree(page) if wrapper is None else merged(wrapper, tree(page))
    return wrapper or Node("")


def main_text(page: str, said: dict | None = None) -> str:
    """The blocks of the article, joined by line breaks."""
    every = list(blocks(page))
    found = [b for b in every if not b[3]]
    template = {tuple(t) for t in said["template"]} if said else set()
    if template:
        found = [b for b in found if (b[1], digest(b[0])) not in template]
    inside = [b for b in found if b[2]] or [b for b in every if b[4]]
    if not inside:
        main = said and said["main"]
        inside = [b for b in found if main and (b[1] == main or b[1].startswith(f"{main}/"))] or found
    return "\n".join(b[0] for b in inside)


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` from all of ``pages(url, html)``, the wrapper as JSON of its decisions.

    A task aligns its pages of a host before anything is shuffled, so a host
    with very many pages sends one tree per task.
    """
    rows = pages.select(host_of("url").alias("host"), F.col("html").cast("string").alias("html"))
    rows = rows.where("html IS NOT NULL AND host <> ''")
    names = ["host", "wrapper"]

    def aligned(batches):
        held: dict[str, Node] = {}

        def packed():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([json.dumps(w.packed()) for w in held.values()], pa.string())], names
            )

        for part in slices(batches, "html"):
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                shape = tree(page)
                held[host] = merged(held[host], shape) if host in held else shape
            if len(held) > HELD_HOSTS:
                yield packed()
                held = {}
        yield packed()

    def joined(table: pa.Table) -> pa.Table:
        wrapper = None
        for values in table.column("wrapper").to_pylist():
            one = unpacked(json.loads(values))
            wrapper = one if wrapper is None else merged(wrapper, one)
        return pa.table({"host": table.column("host").slice(0, 1), "wrapper": [json.dumps(decisions(wrapper))]})

    schema = "host string, wrapper string"
    return stored(rows.mapInArrow(aligned, schema).groupBy("host").applyInArrow(joined, schema))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for every row of ``pages(page_id, url, html, ...)``.

    ``text`` is the article: blocks in page order joined by line breaks, white
    space within a block as single spaces, character references decoded.

    A null or empty page gives an empty text.  Pages without a host go by their
    marks alone.  Of pages without an article or main element, the container
    with most text that is not linked counts.  A text outside of paragraphs is
    template if it stands at its place on all pages of the host that have that
    place, three different ones at least.  Repeated rows give repeated rows and
    count as one page; other columns are not read.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of("url").alias("host"))
    rows = rows.join(wrappers(pages), "host", "left").drop("host")

    def run(batches):
        seen: dict[str | None, dict | None] = {None: None}
        for part in slices(batches, "html"):
            texts = []
            for page, wrapper in zip(part.column("html").to_pylist(), part.column("wrapper").to_pylist(), strict=True):
                if wrapper not in seen:
                    if len(seen) > 1000:
                        seen = {None: None}
                    seen[wrapper] = json.loads(wrapper)
                texts.append(main_text(page, seen[wrapper]))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, schema)
