"""Golden cases of the scalar functions, and the standard library where it has the same function."""

import random
import urllib.parse
import urllib.robotparser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlframe.operators import filters
from crawlframe.functions import content, domains, robots, urls
from crawlframe.functions.place import place, place_high, place_low
from crawlframe.functions.html import extract_images, extract_links

C = F.col

CANONICAL = [
    ("www.a.si", "http://www.a.si"),
    ("https://WWW.A.si", "http://www.a.si/"),
    ("http://a.si/x?b=2&a=1#top", "http://a.si/x?a=1&b=2"),
    ("http://a.si/x?a", "http://a.si/x?a="),
    ("http://a.si/f%c3%bcr", "http://a.si/f%C3%BCr"),
    ("http://a.si/für", "http://a.si/f%C3%BCr"),
    ("http://a.si/a%2fb%3fc%23d%25e%zz\U0001F600 x~*", "http://a.si/a%2Fb%3Fc%23d%25e%25zz%F0%9F%98%80%20x~*"),
    ("http://u:P@A.si:/x?q=%e8%FC&q=a+b*~&é=1&a-b=&a=;", "http://u:P@a.si/x?a=%3B&a-b=&q=a+b%2A~&q=%E8%FC&%C3%A9=1"),
    ("ftp://X.si/a", "http://ftp://x.si/a"),
    ("HTTP://A.si/%41", "http://a.si/A"),
    ("https://A.si?b=1", "http://a.si/?b=1"),
    ("http://a.si:8080/x?&&", "http://a.si:8080/x"),
    ("http://a.si/x?a-b=1&a=2", "http://a.si/x?a=2&a-b=1"),
    ("http://a.si/x?%7Ea=%20b", "http://a.si/x?~a=+b"),
    ("http://a.si/p|q", "http://a.si/p|q"),
    (" http://a.si/\nx", "http://a.si/x"),
    ("http://a.si/x\n", "http://a.si/x"),
    ("http://a.si/x\u2028", "http://a.si/x%E2%80%A8"),
    ("http://a.si/f%C3%BCr%20x%2Fy?b=1&a=2#t", "http://a.si/f%C3%BCr%20x%2Fy?a=2&b=1"),
]
RESOLVED = [
    ("/p/q", "https://a.si/z/w", "http://a.si/p/q"),
    ("q.html", "http://a.si/z/w", "http://a.si/q.html"),
    ("//b.si/x", "http://a.si/", "http://b.si/x"),
    ("?x=1", "http://a.si/q", "http://a.si/?x=1"),
    ("#top", "http://a.si/q", "http://a.si/"),
    ("https://C.si", "http://a.si/q", "http://c.si/"),
    ("mailto:a@b", "http://a.si/q", "http://a.si/mailto:a@b"),
]


def values(spark, texts, fn, schema="v string"):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {schema}")
    return [r[0] for r in rows.orderBy("i").select(fn(C("v"))).collect()]


def test_canonicalize_url(spark):
    assert values(spark, [c[0] for c in CANONICAL], urls.canonicalize_url) == [c[1] for c in CANONICAL]


def test_resolve_link(spark):
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(RESOLVED)], "i int, href string, page string, want string")
    for r in rows.withColumn("got", urls.resolve_link(C("href"), C("page"))).collect():
        assert r.got == r.want, r


def test_url_domain(spark):
    cases = {"https://WWW.A.si:80/x": "http://www.a.si:80", "www.A.si/x": "http://www.a.si", "//b.si": "http://b.si",
             "http://a.si:/": "http://a.si", "http://a.si?x": "http://a.si"}
    assert values(spark, list(cases), urls.url_domain) == list(cases.values())


def test_url_parts_like_standard_library(spark):
    rng = random.Random(5)
    parts = ["http:", "//", "a.si", "/", "x y", "?", "#", "q=1", "&", "%41", ":", "é", "|", "HTTPS:", ";p", "1+a:"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(1500)]
    for text, got in zip(texts, values(spark, texts, urls.url_parts)):
        p = urllib.parse.urlsplit(text)
        assert tuple(got) == (p.scheme, p.netloc, p.path, p.query, p.fragment), text


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZ09-_.~%2fC3bc/?&=+;:@ é*|[]'()", max_size=25), min_size=200, max_size=300))
def test_canonical_form_is_stable(spark, tails):
    texts = ["http://a.si/" + t for t in tails]
    once = values(spark, texts, urls.canonicalize_url)
    assert values(spark, once, urls.canonicalize_url) == once


def test_percent_decode_like_standard_library(spark):
    texts = ["a%20b", "%zz%4", "%c3%bc+%2B", "100%", "é%41", ""]
    assert values(spark, texts, urls.percent_decode) == [urllib.parse.unquote(t) for t in texts]


def test_registered_domain(spark):
    suffixes = ["si", "com", "uk", "co.uk", "*.ck", "!www.ck"]
    cases = {
        "www.gov.si": ("www", "gov", "si"), "a.b.x.co.uk": ("a.b", "x", "co.uk"), "uk": ("", "", "uk"), "localhost": ("", "localhost", ""),
        "a.local": ("a", "local", ""), "10.0.0.1": ("", "10.0.0.1", ""), "a.b.c.ck": ("a", "b", "c.ck"), "x.www.ck": ("x", "www", "ck"),
        "": ("", "", ""),
    }
    got = values(spark, list(cases), lambda h: domains.registered_domain(h, suffixes))
    assert [tuple(g) for g in got] == list(cases.values())
    assert values(spark, ["https://u:p@WWW.A.si.:80/x", "/p"], domains.host_name) == ["www.a.si", ""]


def test_public_suffix_list(spark):
    text = "// c\n\ncom  // note\n*.ck\n!www.ck\nJP\n公司.cn\n// ===BEGIN PRIVATE DOMAINS===\nblogspot.com\n// ===END PRIVATE DOMAINS===\nat"
    rules = ["com", "*.ck", "!www.ck", "jp", "公司.cn", "xn--55qx5d.cn", "at"]
    assert list(domains.read_public_suffixes(text)) == rules
    assert list(domains.read_public_suffixes(text, private=True)) == [*rules[:-1], "blogspot.com", "at"]
    cases = {
        "a.cms.io": ("a", "cms", "io"), "www.cms.co.jp": ("www", "cms", "co.jp"), "x.com.au": ("", "x", "com.au"), "a.b.c.ck": ("a", "b", "c.ck"),
        "x.www.ck": ("x", "www", "ck"), "www.gov.si": ("www", "gov", "si"), "a.b.unlisted": ("a.b", "unlisted", ""),
    }
    got = values(spark, list(cases), domains.registered_domain)
    assert [(g["subdomain"], g["domain"], g["suffix"]) for g in got if g["suffix"]] == [c for c in cases.values() if c[2]]
    images = spark.createDataFrame([("http://a.cms.io/1.png",), ("http://www.cms.co.jp/1.png",), ("http://a.io/1.png",)], "src string")
    assert [r.src for r in filters.filter_image_sources(images).collect()] == ["http://a.io/1.png"]


HTML = [
    '<a href="/x">1</a><A class="b" HREF="/y?a=1&amp;b=2">2</A><img src="/i/1.png"><img alt="z" src="data:image/gif;base64,R0">',
    '<!-- <a href="/no"> --><script>var s = "<a href=/no2>";</script><a name="t">x</a><a href="">e</a><a data-href="n">n</a><img>',
    "<a\n  class=x\n  href = '/q\"r' >z</a><a href=/bare>b</a><abbr href=/no>c</abbr><IMAGE SRC=/i.gif><style><a href=/no></style>",
    "<a href=/in><!-- never closed <a href=/no>",
    "",
    None,
]


def test_extract_links(spark):
    assert values(spark, HTML, extract_links) == [["/x", "/y?a=1&b=2"], [""], ['/q"r', "/bare"], ["/in"], [], None]


def test_extract_images(spark):
    assert values(spark, HTML, extract_images) == [["/i/1.png", "data:image/gif;base64,R0"], [], ["/i.gif"], [], [], None]


# Attributes are walked one by one: the first of the name counts, quoted values may hold anything.
ATTRIBUTES = [
    ('<a href="/a" href="/b">', ["/a"]),
    ('<a title="x href=/bad" href="/good">', ["/good"]),
    ('<a title="a > b" href="/1">', ["/1"]),
    ("<title><a href=\"/no\"></title><textarea><a href=\"/no\"></textarea><a  class=x/ HREF = '/y'>", ["/y"]),
    ('<a href="&#x2F;z"> <abbr href="/no"><a\nhref=b>', ["/z", "b"]),
    ('<a/href="/s"><a disabled href="/d" ><img src=x>', ["/s", "/d"]),
    ('<a href>x<a href="/k">', ["/k"]),
]


def test_attributes(spark):
    assert values(spark, [h for h, _ in ATTRIBUTES], extract_links) == [links for _, links in ATTRIBUTES]


def test_many_rules_cost_no_url_each(spark):
    """The URL's target is derived once: the plan has its expression one time, outside the rules' lambda."""
    rules = spark.createDataFrame([("http://a.si/x", [(True, "/y")] * 3)], "url string, rules array<struct<allow:boolean,path:string>>")
    text = str(robots.rules_allow(C("rules"), C("url")))
    assert text.count("filter(") == 1 and "rlike" not in text.split("filter(")[1].lower()
    assert rules.select(robots.rules_allow(C("rules"), C("url"))).first()[0] is True


def test_long_page(spark):
    page = '<a title="' + "x" * 200_000 + '" href="/far">' + "<a href='/l'>" * 20_000 + "<!--" + "y" * 200_000
    links = values(spark, [page], extract_links)[0]
    assert links[0] == "/far" and len(links) == 20_001


HEADERS = {
    "text/html; charset=utf-8": ".html", "application/xhtml+xml": ".xhtml", "image/svg+xml": ".svg", "text/xml": ".xml",
    "application/xml": ".xml", "application/msword": ".doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx",
    "application/vnd.ms-powerpoint": ".ppt", "application/pdf": ".pdf", "image/jpeg": ".jpeg", "image/x-citrix-jpeg": ".jpeg",
    "image/jpg": None, "image/png": ".png", "image/x-png": ".png", "image/x-citrix-png": ".png", "image/x-portable-graymap": ".pgm",
    "image/pgm": None, "image/gif": ".gif", "image/bmp": ".bmp", "image/tiff": ".tiff", "image/webp": ".webp",
    "application/json": ".json", "text/json": ".json", "application/docx": None, "application/ppt": None, "text/plain": None,
    "data:image/gif;base64,R0lGODlh": ".gif",
}


def test_mime_extension(spark):
    assert values(spark, list(HEADERS), content.mime_extension) == list(HEADERS.values())


def test_fetch_route(spark):
    rows = [(0, None, "http://a.si/mypdf", ".pdf", "PDF", "document"), (1, None, "http://a.si/x", ".html", "HTML", "website"),
            (2, "text/plain", "http://a.si/x.pdf", None, None, "skip"), (3, "application/json", "http://a.si/x", ".json", "JSON", "skip"),
            (4, "text/xml", "http://a.si/x", ".xml", "HTML", "website")]
    df = spark.createDataFrame(rows, "i int, h string, u string, e string, d string, r string")
    ext = content.fetch_extension(C("h"), C("u"))
    got = df.select("*", ext.alias("ge"), content.extension_datatype(ext).alias("gd"), content.extension_route(ext).alias("gr"))
    for r in got.collect():
        assert (r.ge, r.gd, r.gr) == (r.e, r.d, r.r)


def test_content_hash(spark):
    import hashlib

    texts = ["", "für", "x" * 1000]
    assert values(spark, texts, content.content_hash) == [hashlib.sha512(t.encode()).hexdigest() for t in texts]
    assert [bytes(b) for b in values(spark, texts, content.content_bytes)] == [t.encode() for t in texts]


ROBOT_LINES = [
    "User-agent: *", "User-agent: foo", "user-agent: %2A", "User-agent:", "Disallow: /a", "Allow: /a/b", "Disallow:", "Disallow: /a%20b;",
    "Allow: /x?", "Crawl-delay: 3", "Crawl-delay: 1.5", "Crawl-delay: 007", "Request-rate: 1/5", "Request-rate: 0/3", "Request-rate: x",
    "# c", "", " ", "Sitemap: http://a/b", "foo: bar", "nocolon", "Disallow: /b # c", "Disallow: http://h.si/z", "Allow: *",
    "Disallow: /e%0Af", "Disallow: /f#g", "Disallow: /*y", "Disallow: /q;a=1?b", "Allow: /Ž",
]
PATHS = ["/a", "/a/b/c", "/a b;c", "/x?y=1", "/b", "/z", "/", "", "/e%0Af", "/f", "/a%20b;", "/x*y", "/*y", "/q;a=1?b=2", "/%C5%BD", "/x?#f"]


@pytest.fixture(scope="module")
def robots_cases():
    rng = random.Random(11)
    texts = ["", "<html>404</html>"]
    for _ in range(1500):
        end = rng.choice(["\n", "\n", "\r\n", "\r"])
        texts.append(end.join(rng.choice(ROBOT_LINES) for _ in range(rng.randint(0, 10))) + rng.choice(["", end]))
    return texts


def parsed(text):
    rp = urllib.robotparser.RobotFileParser()
    rp.parse(text.splitlines())
    return rp


def test_robots_decisions_like_standard_library(spark, robots_cases):
    rows = [(t, "http://h.si" + p, parsed(t).can_fetch("*", "http://h.si" + p)) for t in robots_cases for p in PATHS]
    df = spark.createDataFrame(rows, "t string, u string, want boolean")
    wrong = df.where(robots.rules_allow(robots.robots_rules(C("t")), C("u")) != C("want"))
    assert wrong.limit(3).collect() == []
    looked_up = df.where(robots.index_allows(robots.rules_index(robots.robots_rules(C("t"))), C("u")) != C("want"))
    assert looked_up.limit(3).collect() == []


def test_looking_up_rules_costs_no_walk_over_them(spark):
    import time

    def seconds(n):
        text = "User-agent: *\n" + "".join(f"{'Allow' if i % 3 else 'Disallow'}: /d{i % 7}/p{i}\n" for i in range(n)) + "Disallow: /d\n"
        df = spark.createDataFrame([(text,)], "t string").select(robots.rules_index(robots.robots_rules(C("t"))).alias("r")).persist()
        table = spark.range(20_000).selectExpr(f"concat('http://h.si/d', id % 7, '/p', id % {2 * n}, '/x') as u", "id").crossJoin(F.broadcast(df))
        allowed = table.select("id", robots.index_allows(C("r"), C("u")).alias("a"))
        want = {i: next((j % 3 > 0 for j in range(n) if f"/d{i % 7}/p{i % (2 * n)}/x".startswith(f"/d{j % 7}/p{j}")), False) for i in range(0, 20_000, 997)}
        df.count()
        start = time.perf_counter()
        allowed.agg(F.count_if("a")).collect()
        took = time.perf_counter() - start
        assert {r.id: r.a for r in allowed.where("id % 997 = 0").collect()} == want
        df.unpersist()
        return took

    seconds(50)
    assert seconds(5_000) < 6 * seconds(50) + 1


def test_hosts_outside_ascii(spark):
    from crawlframe.functions.idna import ascii_host

    golden = {
        "münchen.de": "xn--mnchen-3ya.de", "日本語.jp": "xn--wgv71a119e.jp", "bücher.example:80": "xn--bcher-kva.example:80", "faß.de": "fass.de",
        "例え。テスト": "xn--r8jz45g.xn--zckzah", "a.b": "a.b", "": "", "правда.рф": "xn--80aafi6cg.xn--p1ai", "ü" * 80 + ".de": "ü" * 80 + ".de",
    }
    assert values(spark, list(golden), ascii_host) == list(golden.values())
    rng = random.Random(2)
    labels = ["".join(rng.choice("abz09-äöüéñžčšđ中文字日本αβγδ😀اب") for _ in range(rng.randint(1, 14))) for _ in range(400)]
    want = [x if x.isascii() else "xn--" + x.encode("punycode").decode() for x in labels]
    assert values(spark, labels, ascii_host) == want
    cases = {"http://Čaj.SI/ž": "http://xn--aj-dma.si/%C5%BE", "https://u@Čaj.si:8080/": "http://u@xn--aj-dma.si:8080/"}
    assert values(spark, list(cases), urls.canonicalize_url) == list(cases.values())
    assert values(spark, ["Čaj.si/x"], urls.url_domain) == ["http://xn--aj-dma.si"]


def test_robots_limits_like_standard_library(spark, robots_cases):
    def limit(rp):
        rate, delay = rp.request_rate("*"), rp.crawl_delay("*")
        if rate is not None and rate.requests:
            return rate.seconds / rate.requests
        return float(delay) if delay is not None else 5.0

    got = values(spark, robots_cases, lambda t: robots.robots_limits(t)["limit_s"])
    assert got == [limit(parsed(t)) for t in robots_cases]


def test_robots_normalized_like_standard_library(spark, robots_cases):
    got = values(spark, robots_cases, robots.robots_normalized)
    assert got == [urllib.parse.unquote(str(parsed(t))) for t in robots_cases]


def test_robots_of_many_lines(spark):
    text = "User-agent: *\n" + "Disallow: /no\n" * 30_000 + "Allow: /\n"
    assert len(values(spark, [text], robots.robots_rules)[0]) == 30_001


def test_robots_sitemaps(spark):
    texts = ["Sitemap: http://a.si/s.xml\nsitemap: http://no/\nSitemap:http://no/\nSitemap:  http://b.si/t?x=[1] c", ""]
    assert values(spark, texts, robots.robots_sitemaps) == [["http://a.si/s.xml", "http://b.si/t?x=[1]"], []]


def test_sitemap_locations(spark):
    text = "<urlset><url><loc>https://A.si/x#y</loc></url><loc></loc><loc>http://a.si/b?d&c</loc></urlset>"
    assert values(spark, [text], robots.sitemap_locations) == [["http://a.si/x", "http://a.si/b?c=&d="]]


def test_place_orders_by_both_numbers(spark):
    big = 2**63 - 1
    rows = [(a, b) for a in (-5, 0, 3, 10**12, big) for b in (0, 1, 999, 10**18, big)]
    df = spark.createDataFrame(rows, "a long, b long").withColumn("p", place(C("a"), C("b")))
    got = df.orderBy("p").select("a", "b", place_high(C("p")).alias("h"), place_low(C("p")).alias("l")).collect()
    assert [(r.a, r.b) for r in got] == rows and all((r.a, r.b) == (r.h, r.l) for r in got)


def test_character_references(spark):
    """Golden cases, and random texts against the rule for attribute values in plain Python."""
    import re
    from html.entities import html5

    from crawlframe.functions.html import decode_entities

    golden = {
        "&eacute;": "é", "&#233;": "é", "&#xE9;": "é", "&#XE9": "é", "&ampx": "&ampx", "&#38;lt;": "&lt;", "&amp;lt;": "&lt;", "a?x=1&copy=2": "a?x=1&copy=2",
        "&copy": "©", "&copy;2": "©2", "&notin;&notit;": "∉&notit;", "&#0;&#x110000;&#xD800;&#99999999999;": "\ufffd" * 4, "&#150;&#x80;&#x81;": "–€\x81", "&#x1F600;": "😀",
        "&NotEqualTilde;": "≂̸", "&": "&", "&&#;&#x;&;&nosuch;": "&&#;&#x;&;&nosuch;", "&#0000000000065;": "A", "x&AMP;y&lt": "x&y<", "": "", "&#65b": "Ab", "&nbsp;": "\xa0",
    }
    df = spark.createDataFrame([(k,) for k in golden] + [(None,)], "t string")
    got = {r.t: r.d for r in df.select("t", decode_entities(F.col("t")).alias("d")).collect()}
    assert got == golden | {None: None}

    def number(n):
        if n == 0 or n > 0x10FFFF or 0xD800 <= n < 0xE000:
            return "\ufffd"
        return (bytes([n]).decode("cp1252", "ignore") if 128 <= n < 160 else "") or chr(n)

    def plain(text):
        def one(m):
            said = m[0][1:]
            if said[0] == "#":
                digits = said.strip("#;")
                return number(int(digits[1:], 16) if digits[0] in "xX" else int(digits))
            return html5.get(said, m[0])
        return re.sub(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;|[A-Za-z][A-Za-z0-9]*(?![A-Za-z0-9=]))", one, text)

    rng = random.Random(5)
    parts = ["&", "amp", "lt", "copy", "eacute", "notin", "nosuch", ";", "#", "x", "65", "233", "3c", "=", "a", " ", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", decode_entities(F.col("t")).alias("d")).collect():
        assert r.d == plain(r.t), r.t
