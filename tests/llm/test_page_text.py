from __future__ import annotations

import html
import random
from html.parser import HTMLParser

import pytest

from stationflow.llm import page_text as pt

SCHEMA = "page_id long, url string, html string"
BREAKS = {"p", "h1", "h2", "h3", "ul", "ol", "li", "div", "section", "article", "blockquote", "table", "tr", "td", "footer", "nav"}


class Article(HTMLParser):
    """Blocks of text inside ``<article>`` of a page that holds nothing else there."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks = 0, [[]]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in BREAKS:
            self.blocks.append([])
        elif tag == "br":
            self.blocks[-1].append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in BREAKS:
            self.blocks.append([])

    def handle_data(self, data):
        if self.depth > 0:
            self.blocks[-1].append(data)

    def text(self):
        return " ".join(" ".join(b) for b in ("".join(x).split() for x in self.blocks) if b)


def run(spark, rows, parts=3):
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'h' AS host", "1 AS wrapper", "2 AS pages").repartition(parts)
    found = pt.page_texts(pages).collect()
    assert all(r.n_chars == len(r.text) for r in found)
    return sorted(((r.page_id, r.url, r.text) for r in found), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_article_of_real_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    want = sorted(((r.page_id, r.url, Article(r.html or "").text()) for r in pages.collect()), key=str)
    found = pt.page_texts(pages)
    assert sorted(((r.page_id, r.url, r.text) for r in found.collect()), key=str) == want


def sentence(rng, n):
    return " ".join(rng.choice(["erable", "thtion", "of", "the", "andre", "été", "oning"]) for _ in range(n)).capitalize() + "."


def page(rng, i, semantic, body):
    """A page with everything that is no article around ``body``."""
    links = "".join(f'<li><a href="/{k}">{sentence(rng, 2)}</a>' for k in range(rng.randint(2, 6)))
    region = ("<main><article>", "</article></main>") if semantic else ('<div class="c7"><div class="x1">', "</div></div>")
    return f"""<!doctype html><html><head><title>T {i}</title><style>p{{}}</style><script>if (a < b) c("<p>no</p>")</script></head>
    <body class="with-sidebar"><header><h2>Site name</h2><p>{sentence(rng, 4)}</p></header><nav><ul>{links}</ul></nav>
    <!-- <p>comment</p> --><div class="cookie-notice"><p>We use cookies. {sentence(rng, 3)}</p></div><div id="ad-{i}">{sentence(rng, 9)}</div>
    {region[0]}{body}<form><label>Name</label><input><button>Send</button></form>{region[1]}
    <aside><p>{sentence(rng, 12)}</p></aside><div class="widget">{sentence(rng, 8)}</div>
    <section id="comments"><article class="comment"><p>{sentence(rng, 15)}</p></article></section>
    <noscript>Turn it on</noscript><footer>&copy; {sentence(rng, 5)}</footer></body></html>"""


def article(rng):
    blocks, parts = [], []
    title = sentence(rng, 5)
    blocks.append(title), parts.append(f"<h1>{title}</h1>")
    for _ in range(rng.randint(1, 12)):
        kind, text = rng.random(), sentence(rng, rng.randint(5, 40))
        blocks.append(text)
        if kind < 0.6:
            cut = len(text) // 2
            parts.append(f"<p>{text[:cut]}<b>{text[cut:]}</b>" + rng.choice(["", "</p>", "\n"]))
        elif kind < 0.75:
            parts.append(f"<h2>{text}</h2>")
        elif kind < 0.9:
            more = sentence(rng, 6)
            blocks.append(more)
            parts.append(f"<ul><li>{text}<li>{more}</ul>")
        else:
            parts.append(f"<blockquote><p>{text}</p></blockquote>")
    return "".join(parts), " ".join(blocks)


@pytest.mark.parametrize("semantic", [True, False])
def test_everything_around_the_article_goes(spark, semantic):
    rng = random.Random(7)
    rows, want = [], []
    for i in range(40):
        body, text = article(rng)
        url = f"https://u@{['a.example', 'B.example'][i % 2]}:80/{i}?x#y"
        rows.append((i, url, page(rng, i, semantic, body)))
        want.append((i, url, text))
    assert run(spark, rows, 5) == sorted(want, key=str)


def test_template_text_inside_the_article_goes(spark):
    rng = random.Random(3)
    rows, want = [], []
    for i in range(12):
        one, two = sentence(rng, 30), sentence(rng, 20)
        rows.append((i, "http://h.example/", f"<article><h1>Same title</h1><p>{one}</p><div>Read this every day</div><p>{two}</p></article>"))
        want.append((i, "http://h.example/", f"Same title {one} {two}"))
    two = rows[0][2].split("<p>")[2].split("</p>")[0]
    assert run(spark, rows) == sorted(want, key=str)
    # pages that are all alike: nothing tells their template from their text, so all of it stays
    assert {r[2] for r in run(spark, [(i, "http://h.example/", rows[0][2]) for i in range(12)])} == {
        f"{want[0][2][: -len(two)]}Read this every day {two}"
    }


def test_edge_cases(spark):
    long = "<article>" + "<p>word &amp; more</p>" * 30_000 + "</article>"
    deep = "<div>" * 3000 + "<p>deep text</p>" + "</div>" * 3000
    rows = [(1, None, None), (2, "", ""), (3, "no url", "just text"), (None, "http://x/1", "<article>null id</article>"),
            (4, "http://x/2", "<article>twice</article>"), (4, "http://x/2", "<article>twice</article>"), (5, "http://y/", long),
            (6, "http://z/", deep), (7, "http://w/", "<p>a &lt;b&gt; &eacute;&nbsp;x &am &#65;</p><p></p><p>b<br>c</p>"),
            (8, "http://v/", "<article><p>cut off <b>here"), (9, "http://u/", "<script>never closed <p>x</p>"),
            (10, "http://t/", "<a title='1 > 0'>q</a> < 3 <![CDATA[d <x> d]]>")]
    want = [(1, None, ""), (2, "", ""), (3, "no url", "just text"), (None, "http://x/1", "null id"), (4, "http://x/2", "twice"),
            (4, "http://x/2", "twice"), (5, "http://y/", " ".join(["word & more"] * 30_000)), (6, "http://z/", "deep text"),
            (7, "http://w/", "a <b> é x &am A b c"), (8, "http://v/", "cut off here"), (9, "http://u/", ""),
            (10, "http://t/", "q < 3 d <x> d")]
    assert run(spark, rows) == sorted(want, key=str)
    assert run(spark, []) == []


def test_wrapper_is_union_free():
    bodies = ["<h1>a</h1><p>b", "<h1>c</h1><p>d<p>e<p>f", "<h1>a</h1><ul><li>x<li>y</ul><p>z"]
    trees = [pt._without_refs(pt.page_tree(f"<div>{b}</div>")[0]) for b in bodies]
    whole = trees[0]
    for tree in trees[1:]:
        whole = pt._aligned(whole, tree, True)
    assert [pt._key(n) for n in whole] == ["div"]
    inner = whole[0][3]
    assert [(pt._key(n), n[1]) for n in inner] == [("h1", False), ("ul", True), ("(p)+", False)]
    # the title's text differs between pages: a slot; each list item too
    assert inner[0][3][0][2] is None


def test_bounded_wrapper():
    rng = random.Random(1)
    whole = None
    for _ in range(60):
        tree = pt.page_tree("<div>" + "".join(f"<{t}>x</{t}>" for t in rng.choices(["p", "h2", "ul", "pre", "table"], k=200)) + "</div>")[0]
        tree = pt._without_refs(tree)
        whole = tree if whole is None else pt._aligned(whole, tree, True)
    assert len(whole[0][3]) == 1 and len(whole[0][3][0][2]) == 5


def test_many_wrappers_of_one_host(spark, monkeypatch):
    monkeypatch.setattr(pt, "GROUP", 2)
    rng = random.Random(9)
    rows, want = [], []
    for i in range(24):
        body, text = article(rng)
        rows.append((i, "http://one.example/", page(rng, i, False, body)))
        want.append((i, "http://one.example/", text))
    assert run(spark, rows, 12) == sorted(want, key=str)


def test_entities_like_the_standard_library():
    for text in ("&amp;&amp;", "&copy 1", "&notit;", "&#x41;&#0;", "&quo", "a&nbsp;b"):
        assert pt.page_tree(f"<p>{text}</p>")[1] == [" ".join(html.unescape(text).split())]
