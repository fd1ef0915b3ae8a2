"""Main text of web pages by wrapper induction.

Every page is read once into an outline (the tree of its block elements, siblings of one label as one node) and its
text blocks. The distinct outlines of a host are aligned by simple tree matching and merged, a few at a time,
into the host's wrapper; aligning each outline with the wrapper gives every block its slot. A text that the same slot
shows on at least half of the host's titles, and on three or more, is template; what varies is content. Titles are
counted rather than pages, so copies of an article, however many, do not make it template. Counts are taken over all pages.

What varies and yet is no article (menus, headers, footers, sidebars, notices, adverts, forms, reader comments) is told by its
element, role or class. Where a page marks an article or a main part, only that is content; elsewhere blocks that
are mostly links are not.

Null and empty html give an empty text. A page without a host in its url is read by its marks alone. Rows alike are
extracted alike, each kept. Pages and texts may have any length. An empty table gives no rows. Other columns are not
read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.llm.common import arrow_batches
from peerline.llm.dom import Page, Reader
from peerline.session import materialise

MERGED_AT_ONCE = 32  # outlines a task merges into one; what they give is merged again until one is left
LEAST_TITLES = 3

# Elements, roles and class names that are not the article.
FURNITURE_TAGS = frozenset(
    "head nav footer aside form button select textarea fieldset dialog menu noscript template object svg canvas audio video"
    " datalist input applet marquee".split()
)
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split()
)
FURNITURE_NAMES = frozenset(
    "nav navbar navigation menu menubar header masthead topbar footer sidebar aside banner ad ads advert adverts advertisement"
    " advertising adsense adsbygoogle sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal"
    " overlay comment comments commentlist disqus replies respond share sharing social related recommended breadcrumb breadcrumbs"
    " pagination pager newsletter subscribe subscription signup login search skip widget widgets toolbar".split()
)
LEADING_NAMES = frozenset(
    "ad ads advert advertisement comment comments cookie disqus footer menu nav navbar newsletter related share sidebar social"
    " sponsor sponsored".split()
)
ARTICLE_NAMES = frozenset("article content entry main page post story text body".split())
DECORATION = frozenset("area bar block box container group inner item items list outer panel row section slot unit wrap wrapper".split())
DENIALS = frozenset("has no not non with without".split())


def _names_furniture(name: str) -> bool:
    """Whether a class or id names something other than the article."""
    parts = [p.lower() for p in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)]
    core = [p for p in parts if p not in DECORATION]
    if not core or core[0] in DENIALS:
        return False
    if core[-1] in FURNITURE_NAMES:
        return not (core[-1] in ("header", "banner") and ARTICLE_NAMES & set(core[:-1]) - {"main", "page"})
    return core[0] in LEADING_NAMES and core[-1] not in ARTICLE_NAMES


def is_furniture(tag: str, has: dict[str, str], in_region: bool) -> bool:
    if tag in FURNITURE_TAGS or (tag == "header" and not in_region):
        return True
    if not has:
        return False
    if "hidden" in has or has.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", has.get("style", "")):
        return True
    if has.get("role", "").lower() in FURNITURE_ROLES:
        return True
    names = f"{has.get('class', '')} {has.get('id', '')}".split()
    if tag in ("html", "body", "main", "article"):
        return tag == "article" and any("comment" in n.lower() for n in names)
    return any(_names_furniture(n) for n in names)


def region_of(tag: str, has: dict[str, str]) -> str | None:
    """`article` or `main` where an element marks that part of the page."""
    if tag == "article" or has.get("role") == "article" or "articleBody" in has.get("itemprop", ""):
        return "article"
    return "main" if tag == "main" or has.get("role") == "main" else None


def label_of(tag: str, has: dict[str, str]) -> str:
    """An element's tag with its class names, those with digits left out: they number elements rather than name them."""
    names = sorted({n for n in has.get("class", "").split() if n.isascii() and not re.search(r"[\d()]", n)})
    return ".".join([tag, *names])


def _content(page: Page) -> list:
    """Blocks of the page's articles, else of its main part, else those that are not mostly links."""
    kinds = {k: kind for k, kind in enumerate(page.regions, 1)}
    articles: dict[int, list] = {}
    for block in page.blocks:
        if kinds.get(block.region) == "article":
            articles.setdefault(block.region, []).append(block)
    if articles:
        def size(blocks):
            return sum(len(b.text) for b in blocks)

        told = [k for k, blocks in articles.items() if 2 * sum(b.linked for b in blocks) <= size(blocks)]
        kept = set(told or [max(articles, key=lambda k: (size(articles[k]), -k))])
        return [b for b in page.blocks if b.region in kept]
    if main := [b for b in page.blocks if b.region]:
        return main
    return [b for b in page.blocks if 2 * b.linked <= len(b.text)]


# --- trees ------------------------------------------------------------------


class Tree:
    """An ordered tree of labels, written one node a line: parent's line and label, parents first, siblings in order."""

    def __init__(self, lines: str):
        pairs = [line.split(" ", 1) for line in lines.split("\n")]
        self.labels = [label for _, label in pairs]
        self.children: list[list[int]] = [[] for _ in pairs]
        for node, (parent, _) in enumerate(pairs):
            if int(parent) >= 0:
                self.children[int(parent)].append(node)

    def write(self) -> str:
        lines, numbers = [f"-1 {self.labels[0]}"], {0: 0}
        waiting = [0]
        for node in waiting:
            for child in self.children[node]:
                numbers[child] = len(lines)
                lines.append(f"{numbers[node]} {self.labels[child]}")
                waiting.append(child)
        return "\n".join(lines)


def _heaviest_chain(pairs: list[tuple[int, int, int]]) -> list[int]:
    """Positions in `pairs` (i, j, weight) of the heaviest chain rising in both i and j: the best crossing-free matching."""
    places = sorted({j for _, j, _ in pairs})
    tree: list[tuple[int, int]] = [(0, -1)] * (len(places) + 1)  # best (weight, last pair) up to a place, as a binary indexed tree
    back = [-1] * len(pairs)
    best = (0, -1)
    order = sorted(range(len(pairs)), key=lambda k: (pairs[k][0], -pairs[k][1]))
    for k in order:
        _, j, weight = pairs[k]
        at, found = bisect_left(places, j), (0, -1)
        while at > 0:
            found = max(found, tree[at])
            at -= at & -at
        back[k] = found[1]
        here = (found[0] + weight, k)
        best = max(best, here)
        at = bisect_left(places, j) + 1
        while at < len(tree):
            tree[at] = max(tree[at], here)
            at += at & -at
    chain = []
    k = best[1]
    while k >= 0:
        chain.append(k)
        k = back[k]
    return chain[::-1]


def align(a: Tree, b: Tree) -> dict[int, int]:
    """Nodes of `a` and the nodes of `b` they match: the largest matching that keeps labels, parents and order."""
    chosen: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def weight(x: int, y: int) -> int:
        at: dict[str, list[int]] = {}
        for j, child in enumerate(b.children[y]):
            at.setdefault(b.labels[child], []).append(j)
        pairs = [
            (i, j, weight(child, b.children[y][j])) for i, child in enumerate(a.children[x]) for j in at.get(a.labels[child], ())
        ]
        chain = _heaviest_chain(pairs)
        chosen[x, y] = [(a.children[x][pairs[k][0]], b.children[y][pairs[k][1]]) for k in chain]
        return 1 + sum(pairs[k][2] for k in chain)

    weight(0, 0)
    matched, waiting = {}, [(0, 0)]
    for x, y in waiting:
        matched[x] = y
        waiting += chosen[x, y]
    return matched


def merge(wrapper: Tree, outline: Tree) -> None:
    """Put into `wrapper` what `outline` has beyond it, each node behind the sibling it follows."""
    matched = align(outline, wrapper)
    waiting = [0]
    for node in waiting:
        siblings, behind = wrapper.children[matched[node]], -1
        for child in outline.children[node]:
            if child in matched:
                behind = siblings.index(matched[child])
            else:
                matched[child] = len(wrapper.labels)
                wrapper.labels.append(outline.labels[child])
                wrapper.children.append([])
                behind += 1
                siblings.insert(behind, matched[child])
            waiting.append(child)


# --- the job ----------------------------------------------------------------

OUTLINE = "page_id {id}, url string, title string, outline string, blocks array<struct<node: int, mark: binary, text: string>>"


def host(url: Column) -> Column:
    """The host of a url in lower case; null where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def outlines(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, title, outline, blocks): blocks that may be content, each with its node and a digest of its text."""
    kind = pages.schema["page_id"].dataType.simpleString()
    block = pa.struct([("node", pa.int32()), ("mark", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(is_furniture, region_of, label_of)

        def rows(schema: pa.Schema, ids: pa.Array, urls: pa.Array, sources: pa.Array):
            for key, url, source in zip(ids, urls, sources):
                page = reader.read(source.as_py() or "")
                blocks = [(b.node, hashlib.blake2b(b.text.encode(), digest_size=16).digest(), b.text) for b in _content(page)]
                lines = "\n".join(f"{parent} {label}" for parent, label in page.outline)
                yield key.as_py(), url.as_py(), page.title or url.as_py(), lines, [dict(zip(("node", "mark", "text"), b)) for b in blocks]

        for batch in batches:
            schema = pa.schema(
                [("page_id", batch.schema.field(0).type), ("url", pa.string()), ("title", pa.string()), ("outline", pa.string()), ("blocks", pa.list_(block))]
            )
            yield from arrow_batches(rows(schema, *batch.columns), schema, most=200)

    read = pages.select("page_id", F.col("url").cast("string").alias("url"), "html").mapInArrow(run, OUTLINE.format(id=kind))
    return read.withColumn("host", host(F.col("url")))


def induce(shapes: DataFrame) -> DataFrame:
    """(host, wrapper) from (host, outline), a few outlines merged at a time until each host has one tree."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        lines = sorted(group["wrapper"], key=lambda w: (-len(w), w))
        wrapper = Tree(lines[0])
        for other in lines[1:]:
            merge(wrapper, Tree(other))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [wrapper.write()]})

    wrappers = shapes.select("host", F.col("outline").alias("wrapper"))
    while True:
        counts = materialise(wrappers.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "wrapper-counts")
        if (counts.agg(F.max("n")).first()[0] or 0) <= 1:
            return wrappers
        part = F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / MERGED_AT_ONCE))
        dealt = wrappers.join(counts, "host").select("host", "wrapper", part.alias("part"))
        wrappers = materialise(dealt.groupBy("host", "part").applyInPandas(run, "host string, wrapper string"), "wrappers")


def slots(shapes: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, outline, slots): for each node of an outline its place in the host's wrapper."""
    schema = pa.schema([("host", pa.string()), ("outline", pa.string()), ("slots", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name, outline, wrapper in zip(*(c.to_pylist() for c in batch.columns)):
                    matched = align(tree := Tree(outline), Tree(wrapper))
                    yield name, outline, [matched.get(node, -1) for node in range(len(tree.labels))]

        return arrow_batches(rows(), schema)

    return shapes.join(wrappers, "host").select("host", "outline", "wrapper").mapInArrow(run, "host string, outline string, slots array<int>")


def template(read: DataFrame, slotted: DataFrame) -> DataFrame:
    """(host, fixed): the texts, as (slot, mark), that a host's pages share in one place."""
    placed = read.select("host", "title", "outline", F.explode("blocks").alias("block")).join(slotted, ["host", "outline"])
    placed = placed.select("host", "title", F.get("slots", F.col("block.node")).alias("slot"), F.col("block.mark").alias("mark"))
    # One row for each title first: copies collapse before anything is counted, and no title weighs twice.
    seen = materialise(placed.distinct(), "slot-texts")
    titles = seen.select("host", "slot", "title").distinct().groupBy("host", "slot").agg(F.count(F.lit(1)).alias("titles"))
    shown = seen.groupBy("host", "slot", "mark").agg(F.count(F.lit(1)).alias("shown")).filter(F.col("shown") >= LEAST_TITLES)
    fixed = shown.join(titles, ["host", "slot"]).filter(2 * F.col("shown") >= F.col("titles"))
    # At least half of a slot's titles show each, so a host has no more of them than two pages have blocks.
    return fixed.groupBy("host").agg(F.collect_list(F.struct("slot", "mark")).alias("fixed"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its content blocks in page order, two line breaks between them."""
    read = materialise(outlines(pages), "outlines")
    shapes = materialise(read.filter("host IS NOT NULL").select("host", "outline").distinct(), "shapes")
    slotted = materialise(slots(shapes, induce(shapes)), "slots")
    fixed = materialise(template(read, slotted), "template")
    learnt = materialise(slotted.join(fixed, "host"), "learnt")

    def varies(block: Column) -> Column:
        here = F.struct(F.get("slots", block["node"]).alias("slot"), block["mark"].alias("mark"))
        return F.col("fixed").isNull() | ~F.array_contains("fixed", here)

    content = F.transform(F.filter("blocks", varies), lambda block: block["text"])
    joined = read.join(learnt, ["host", "outline"], "left")
    return joined.select("page_id", "url", F.array_join(content, "\n\n").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
