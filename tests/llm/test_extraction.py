"""Main text of pages: given pages against a tree walk, pages without marks, hand-made pages, odd pages."""

import time
from html.parser import HTMLParser

import pytest

from crawlframe.llm import extraction
from crawlframe.llm.catalog import QUERIES
from crawlframe.llm.common import table

TEXT = "Lorem ipsum dolor sit amet, consectetur adipiscing elit sed do eiusmod tempor"


class Articles(HTMLParser):
    """Blocks inside ``article``."""

    def __init__(self):
        super().__init__()
        self.depth, self.blocks = 0, [[]]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag == "br":
            self.blocks[-1].append(" ")
        elif tag in ("article", "p", "h1"):
            self.blocks.append([])

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("article", "p", "h1"):
            self.blocks.append([])

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1].append(data)


def marked_text(html):
    walk = Articles()
    walk.feed(html)
    walk.close()
    return "\n\n".join(b for b in (" ".join("".join(block).split()) for block in walk.blocks) if b)


def test_given_pages_equal_a_tree_walk(spark):
    sf = "/root/testdata/sf0.01"
    html = {r["page_id"]: (r["url"], r["html"]) for r in table(spark, sf, "pages").collect()}
    rows = QUERIES["op13_extraction"](spark, sf).collect()
    assert {r["page_id"] for r in rows} == html.keys()
    for r in rows:
        want = marked_text(html[r["page_id"]][1])
        assert (r["url"], r["text"], r["n_chars"]) == (html[r["page_id"]][0], want, len(want))


def test_weights_found_on_marked_pages_serve_unmarked_ones(spark):
    sf = "/root/testdata/sf0.01"
    pages = table(spark, sf, "pages").select("page_id", "html").collect()
    weights = extraction.train(table(spark, sf, "pages").filter("page_id % 2 = 0"))
    assert weights["word"] > 0 and all(w < 0 for k, w in weights.items() if k.startswith("<"))
    for r in pages:
        if r["page_id"] % 2:
            bare = r["html"].replace("<article>", "<div>").replace("</article>", "</div>")
            assert extraction.main_text(bare, weights) == marked_text(r["html"])


PAGES = {
    "no marks": (
        f"<html><body><div class='top-nav'><a href=/>Home</a> <a href=/a>About us</a></div><div id=cookie-banner>We use cookies. <button>OK</button></div>"
        f"<h1>A title</h1><p>{TEXT} one.</p><p>{TEXT} two &mdash; <a href='x?a=1&b=2'>a link</a>.</p><div class=ad-slot>Buy now! Best prices for all of you today</div>"
        f"<p>{TEXT} three.</p><ul><li>first thing</li><li>second thing</li></ul><div class=comments><h2>Comments</h2><p>{TEXT}</p></div><div>Copyright 2020</div></body></html>",
        f"A title\n\n{TEXT} one.\n\n{TEXT} two — a link.\n\n{TEXT} three.\n\nfirst thing\n\nsecond thing",
    ),
    "parts inside the article": (
        f"<!doctype html><body class=has-sidebar><header><h1>Site</h1></header><main><article><header><h1>Title &amp; more</h1></header><p>{TEXT}</p>"
        "<aside>Other words</aside><form><label>Email</label><input name=q></form><div hidden>unseen</div><div role=alert>Attention</div><blockquote>Quote</blockquote><pre>a\n  b</pre>"
        f"<table><tr><th>x</th><td>y</td></tr><tr><td>1</td><td>2</td></tr></table></article><section id=comments><article class=comment><p>{TEXT}</p></article></section></main><footer>f</footer>",
        f"Title & more\n\n{TEXT}\n\nQuote\n\na b\n\nx y\n\n1 2",
    ),
    "upper case, omitted end tags, script with tags": (
        f"<HTML><BODY><NAV>menu words</NAV><ARTICLE><P CLASS='x > y'>{TEXT}<P>second para</ARTICLE><SCRIPT>if (a<b) document.write('</p>')</SCRIPT><FOOTER>foot</FOOTER>",
        f"{TEXT}\n\nsecond para",
    ),
    "side bars by place alone": (
        f"<body><div id=wrap><div class=left><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class=body><p>{TEXT}</p><p>Short end.</p></div>"
        "<div class=right><p><a href=1>abc def ghi</a></p></div></div></body>",
        f"{TEXT}\n\nShort end.",
    ),
    "cut short in a reference": (f"<html><body><article><h1>T</h1><p>{TEXT} cut &am", f"T\n\n{TEXT} cut &am"),
    "cut short in a tag": (f"<html><body><article><h1>T</h1><p>{TEXT} cut</p><p cla", f"T\n\n{TEXT} cut"),
    "part without end": (f"<body><div class=ad>Buy<article><h1>T</h1><p>{TEXT}</p></article></body>", f"T\n\n{TEXT}"),
    "form around all": (f"<body><form id=f><div class=menu>a b</div><article><p>{TEXT}</p></article></form>", TEXT),
    "references and white space": (f"<article><p>{TEXT}&nbsp;&nbsp;end\n\t line<br>next &#233;&#xE9;&hellip;&ampx &#38;lt;</p><p> </p><p>x</p></article>", f"{TEXT} end line next éé…&x &lt;\n\nx"),
    "html comments": (f"<article><p>{TEXT}<!-- <p>no</p> --> after<!----> x<!--> y</p></article>", f"{TEXT} after x y"),
    "reader comments by heading": (f"<article><p>{TEXT}</p></article><div><h3>3 Comments</h3><p>{TEXT}</p></div>", TEXT),
    "two articles": (f"<main><article><p>{TEXT} A</p></article><article><p>{TEXT} B</p></article></main>", f"{TEXT} A\n\n{TEXT} B"),
    "no tag at all": (f"just {TEXT} &lt;b&gt; a < b", f"just {TEXT} <b> a < b"),
    "only a menu": ("<html><body><nav>only menu</nav></body></html>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_hand_made_pages(name):
    html, want = PAGES[name]
    assert extraction.main_text(html, {}) == want
    learned = {"<body>": -3.0, "<html>": -3.0, "<div>": -3.0, "word": 1.5, "<p>": -0.05, "<h1>": -0.05}
    assert extraction.main_text(html, learned) == want


def test_region_has_the_largest_sum():
    page = extraction.Page("<div>a<p>b c d</p><a>e</a><i>f g</i></div><ul><li>h</ul>" * 3 + "<b>z z z z</b>")
    weights = {k: (-1.5 if k.startswith("<") else 1.0) for k in ("<div>", "<p>", "<a>", "<i>", "<ul>", "<li>", "<b>", "word", "linked word")}
    scores = [weights[page.kind(k)] * (1 if page.names[k] is not None else page.words[k]) for k in range(len(page.names))]
    best = max(sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))
    first, last = page.region(weights)
    assert sum(scores[first : last + 1]) == best


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, kind string, inside boolean, n int"
    rows = [(1, "u", None), (2, None, ""), (None, "u", f"<p>{TEXT}"), (3, "u", "<p>x"), (3, "u", "<p>x"), (4, "u", f"<article><p>{'word ' * 400_000}</p></article>")]
    pages = spark.createDataFrame([(*r, "old", 5, "k", True, 1) for r in rows], schema)
    got = extraction.extract(pages, extraction.train(pages)).collect()
    texts = {None: TEXT, 1: "", 2: "", 3: "x", 4: ("word " * 400_000).strip()}
    assert len(got) == len(rows) and all((r["text"], r["n_chars"]) == (texts[r["page_id"]], len(texts[r["page_id"]])) for r in got)
    assert extraction.train(pages.limit(0)) == {} and extraction.extract(pages.limit(0), {}).collect() == []


def test_long_pages_take_linear_time():
    hard = ["<i>" * 30_000 + "</b>" * 30_000, "</" * 100_000, "<div>" * 30_000 + "</span>" * 30_000, '<a b="' * 50_000, "<article><header><nav>" * 10_000, "<!--" * 50_000, "<p><b>x" * 20_000]
    start = time.perf_counter()
    for html in hard:
        extraction.main_text(html, {})
    assert time.perf_counter() - start < 20
