"""A page's elements and text blocks, read leniently in one pass.

Unclosed and misnested tags are closed as browsers do, comments, scripts and other raw text are passed over, a page
that ends early ends every open element. Inline elements belong to their block's text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from dataclasses import dataclass, field

# Elements of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section"
    " select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HEAD = frozenset("base link meta title style script noscript template head".split())
FORMATTING = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_PARAGRAPH = BLOCKS - frozenset("body caption head html legend option optgroup select tbody td tfoot th thead title tr".split())
# An element that ends others, and how far up they are looked for.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    **{part: (("thead", "tbody", "tfoot"), ("table",)) for part in ("thead", "tbody", "tfoot")},
}
CELLS = frozenset("td th caption table template object applet marquee".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
DEEPEST = 200  # elements further down count as part of the one at this depth; their text is kept

TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?>[^>\"'=]+|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[\"'=])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE) for name in RAW}


@dataclass
class Element:
    """An open element: its place in the page's outline, and what it and those around it were marked as."""

    tag: str
    node: int
    depth: int
    furniture: bool = False
    region: int = 0  # number of the outermost marked article or main part around it, 0 for none
    links: bool = False


@dataclass
class Block:
    node: int
    text: str
    linked: int
    region: int


@dataclass
class Page:
    """`outline` holds (parent, label) of every node, parents first; siblings of one label are one node."""

    title: str = ""
    outline: list[tuple[int, str]] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    regions: list[str] = field(default_factory=list)


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag, the first of each name."""
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


def plain(text: str) -> str:
    """Character references decoded, white space one space, ends trimmed."""
    return " ".join((html.unescape(text) if "&" in text else text).split())


class Reader:
    """Reads one page; `furniture(tag, attributes, region)` and `region(tag, attributes)` say what an element is."""

    def __init__(self, furniture: Callable[[str, dict, bool], bool], region: Callable[[str, dict], str | None], label: Callable[[str, dict], str]):
        self.furniture, self.region, self.label = furniture, region, label

    def read(self, source: str) -> Page:
        self.page, self.known = Page(outline=[(-1, "page")]), {}
        self.open = [Element("", 0, 0)]
        self.pieces: list[tuple[str, bool]] = []
        at, size = 0, len(source)
        while at < size:
            start = source.find("<", at)
            if start < 0:
                self._text(source[at:])
                break
            tag = TAG.match(source, start)
            if tag is None:  # a lone `<` is text
                self._text(source[at : start + 1])
                at = start + 1
                continue
            self._text(source[at:start])
            at = tag.end()
            name = tag["name"]
            if name is None:
                continue
            name = name.lower()
            if tag["end"]:
                self._end(name)
                continue
            if name in RAW:
                stop = RAW_END[name].search(source, at)
                inside = source[at : stop.start() if stop else size]
                if name == "title" and not self.page.title:
                    self.page.title = plain(inside)
                at = stop.end() if stop else size
                continue
            self._start(name, tag["attributes"])
        self._flush()
        return self.page

    def _text(self, text: str) -> None:
        if self.open[-1].tag == "head" and text and not text.isspace():
            self._close("head")
        if text and not self.open[-1].furniture:
            self.pieces.append((text, self.open[-1].links))

    def _flush(self) -> None:
        if not self.pieces:
            return
        # References are decoded piece by piece: no tag may stand within one.
        decoded = [(html.unescape(t) if "&" in t else t, linked) for t, linked in self.pieces]
        self.pieces = []
        text = " ".join("".join(t for t, _ in decoded).split())
        if text:
            here = self.open[-1]
            linked = sum(len(t.strip()) for t, linked in decoded if linked)
            self.page.blocks.append(Block(here.node, text, linked, here.region))

    def _close(self, name: str) -> None:
        while self.open[-1].tag != name:
            self._pop()
        self._pop()

    def _pop(self) -> None:
        if self.open[-1].tag in BLOCKS:
            self._flush()
        self.open.pop()

    def _within(self, names: tuple[str, ...], until: frozenset | tuple) -> str | None:
        """The innermost open element of these names, looked for no further up than `until`."""
        for element in reversed(self.open):
            if element.tag in names:
                return element.tag
            if element.tag in until:
                return None
        return None

    def _start(self, name: str, source: str) -> None:
        if name == "br":
            if not self.open[-1].furniture:
                self.pieces.append((" ", False))
            return
        if name == "hr":
            self._flush()
        if name in VOID:
            return
        if self.open[-1].tag == "head" and name not in HEAD:
            self._close("head")
        if name in NO_PARAGRAPH and self._within(("p",), CELLS | {"button"}):
            self._close("p")
        if name in HEADINGS and self.open[-1].tag in HEADINGS:
            self._pop()
        if name in ENDS:
            closed, until = ENDS[name]
            while found := self._within(closed, until):
                self._close(found)
        self._push(name, attributes(source) if source else {})

    def _push(self, name: str, has: dict[str, str]) -> None:
        over = self.open[-1]
        block = name in BLOCKS
        if block:
            self._flush()
        element = Element(name, over.node, over.depth, over.furniture, over.region, over.links or name == "a")
        if not element.furniture:
            element.furniture = self.furniture(name, has, over.region > 0)
            kind = None if element.furniture else self.region(name, has)
            if kind and not self._inside(over.region, kind):
                self.page.regions.append(kind)
                element.region = len(self.page.regions)
        if block and over.depth < DEEPEST:
            key = over.node, self.label(name, has)
            if key not in self.known:
                self.known[key] = len(self.page.outline)
                self.page.outline.append(key)
            element.node, element.depth = self.known[key], over.depth + 1
        self.open.append(element)

    def _inside(self, region: int, kind: str) -> bool:
        """Whether the region around already is of this kind, or an article, which no main part narrows."""
        return region > 0 and self.page.regions[region - 1] in (kind, "article")

    def _end(self, name: str) -> None:
        if name == "br":
            self._start("br", "")
        elif self._within((name,), () if name in TABLE_PARTS else CELLS - {name}):
            if name in FORMATTING:
                self._unwrap(name)
            else:
                self._close(name)
        elif name == "p":
            self._flush()

    def _unwrap(self, name: str) -> None:
        """End an inline element in which others were left open: those up to the block around end with it, a block stays open."""
        inner = []
        while self.open[-1].tag != name and self.open[-1].tag not in BLOCKS:
            inner.append(self.open.pop())
        if self.open[-1].tag == name:
            self.open.pop()
        elif name == "a":
            # The link was opened outside this block: what follows in the block is no link any more.
            self.open[-1].links = False
