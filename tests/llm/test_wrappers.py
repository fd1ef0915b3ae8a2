"""Main text against pages built from known articles, and against a plain reading of the test pages."""

import collections
import html
import random
import re

import pytest

from peerline.llm import queries, wrappers
from peerline.llm.dom import Reader
from peerline.llm.wrappers import Tree, align, merge

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text string, host string"  # text and host clash with what the operator adds


def plain_reading(source):
    """The marked article of a test page, cut at its headings and paragraphs."""
    found = re.search(r"<article>(.*?)(?:</article>|\Z)", source or "", re.DOTALL)
    parts = re.split(r"</?(?:h1|p)>", found[1]) if found else []
    blocks = [" ".join(html.unescape(p.replace("<br>", " ").replace("<b>", "").replace("</b>", "")).split()) for p in parts]
    return "\n\n".join(b for b in blocks if b)


def blocks_of(source):
    page = Reader(wrappers.is_furniture, wrappers.region_of, wrappers.label_of).read(source)
    return [b.text for b in wrappers._content(page)]


def extract(spark, rows):
    got = wrappers.extract(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return collections.Counter((r.page_id, r.url, r.text) for r in got)


def test_test_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op11_main_text(spark, FOLDER).collect()}
    assert len(got) == len(pages)
    for p in pages:
        assert (got[p.page_id].url, got[p.page_id].text) == (p.url, plain_reading(p.html))


def test_unmarked_pages_lose_what_their_host_repeats(spark):
    some, rows, want = random.Random(3), [], collections.Counter()

    def words(n):
        return " ".join("".join(some.choice("abcdefgh") for _ in range(5)) for _ in range(n))

    for site, count in (("a.example", 40), ("b.example", 7)):
        for k in range(count):
            title, body = words(4), [words(some.randint(3, 40)) for _ in range(some.randint(1, 6))]
            notice = f"<div>We at {site} use crumbs.</div>" if k % 3 else ""
            links = "".join(f"<a href='/{w}'>{w}</a> " for w in words(8).split())
            source = (
                f"<html><head><title>{title}</title></head><body><div>{site} the site</div>{notice}<div>{links}</div>"
                f"<div><h2>{title}</h2>{''.join(f'<p>{b}</p>' for b in body)}<p>Thank you for reading {site}.</p></div>"
                f"<div class='x{k}'>All rights kept by {site}</div>"
            )
            rows.append((len(rows), f"https://{site}/{k}", source))
            want[len(rows) - 1, rows[-1][1], "\n\n".join([title, *body])] += 1
    copies = [(1000 + k, f"https://a.example/copy{k}", rows[0][2]) for k in range(150)]  # one article, many addresses
    want.update((i, url, next(t for p, _, t in want if p == 0)) for i, url, _ in copies)
    assert extract(spark, rows + copies) == want


def test_awkward_pages(spark):
    rows = [
        (1, "http://h.example/1", None), (2, "http://h.example/2", ""), (3, None, "<p>no url</p>"), (4, "not a url", "text only"),
        (5, "http://USER@H.example:80/5", "<p>" + "long " * 700_000), (None, "http://h.example/6", "<p>no id"), (7, "http://h.example/7", "<p>same"),
        (7, "http://h.example/7", "<p>same"), (8, "http://h.example/8", "<div>" * 3000 + "deep"), (9, "http://h.example/9", "<!-- open <p>gone"),
        (10, "http://h.example/10", "<article></article><p>beside"),
    ]
    texts = [
        "", "", "no url", "text only", ("long " * 700_000).strip(), "no id", "same", "same", "deep", "", "beside",
    ]
    assert extract(spark, rows) == collections.Counter((i, u, t) for (i, u, _), t in zip(rows, texts))
    assert extract(spark, []) == collections.Counter()


@pytest.mark.parametrize(
    "source, want",
    [
        ("<body class='has-sidebar'><header>Site</header><nav>n</nav><main><h1>T</h1><p>a<p>b</main><footer>f</footer>", ["T", "a", "b"]),
        ("<article><header><h1>T</h1></header><p>a &lt;b&gt; &copy;&nbsp; 1<aside>s</aside><footer>f</footer></article>", ["T", "a <b> © 1"]),
        ("<article><p>a</article><section id='comments'><article class='comment'><p>c</article></section>", ["a"]),
        ("<p>a<script>if (x<y) '</p>'</script>b<style>p{}</style>c</p><noscript>n</noscript>", ["abc"]),
        ("<p>one<br>two<!-- <p>x</p> --> thr<i>ee</i></P><form><p>f<input></form><p hidden>h<p>z", ["one two three", "z"]),
        ("<div class='cookie-notice'>c</div><div class='ad'>a</div><div class='post-header'>h</div><div class='siteHeader'>s</div>t", ["h", "t"]),
        ("<table><tr><td>a<td>b<tr><td><div>c</div></table><ul><li>d<li>e</ul><dl><dt>f<dd>g", list("abcdefg")),
        ("<article><p>in <button><div>no</div></button> and on</p><pre> p  q\n r </pre>", ["in", "and on", "p q r"]),
        ("<p>a <a href=x>b</a> words of text</p><div><a href=y>c</a> <a href=z>d</a></div>", ["a b words of text"]),
        ("x &amp;amp; &ampy &#65;&#x42; < 1 <3 a<", ["x &amp; &y AB < 1 <3 a<"]),
    ],
)
def test_reading(source, want):
    assert blocks_of(source) == want


def test_matching_keeps_order_and_merging_keeps_nodes():
    a, b = Tree("-1 page\n0 div\n0 p\n1 h1\n1 p"), Tree("-1 page\n0 nav\n0 div\n2 h1\n2 ul")
    assert align(a, b) == {0: 0, 1: 2, 3: 3}
    merge(b, a)
    again = Tree(b.write())
    assert set(align(a, again)) == set(range(5)) and len(again.labels) == 7
    crossed = align(Tree("-1 page\n0 x\n0 y"), Tree("-1 page\n0 y\n0 x"))
    assert len(crossed) == 2
