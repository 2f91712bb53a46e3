"""Crawl tables derived from the given tables, for the query catalog.

The given tables hold pages, documents and events but no sites, links, fetches or images. These
functions derive such tables, each growing with the table it comes from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.operators.ids import assign_ids
from crawlframe.sources.tables import given_table


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _host(url: Column) -> Column:
    return F.concat(F.lit("http://"), F.lower(F.regexp_extract(url, "^https?://([^/?#]+)", 1)))


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return given_table(spark, sf, "pages")


def _n_pages(spark: SparkSession, sf: str) -> Column:
    return pages(spark, sf).agg(F.count("*")).scalar()


def sites(spark: SparkSession, sf: str) -> DataFrame:
    """(id, domain, robots_content, sitemap_content): every host of the pages, six kinds of robots text."""
    hosts = assign_ids(pages(spark, sf).select(_host(F.col("url")).alias("domain")).distinct(), "domain")
    hn = F.col("id") - 1
    host = F.substr("domain", F.lit(8))
    robots = (
        F.when(hn % 6 == 0, F.lit(""))
        .when(hn % 6 == 1, F.lit("User-agent: *\nDisallow: /en/\n"))
        .when(hn % 6 == 2, F.lit("User-agent: *\nAllow: /en/7\nDisallow: /en/\nCrawl-delay: 2\n"))
        .when(hn % 6 == 3, F.lit("User-agent: *\nDisallow:\nRequest-rate: 2/20\nCrawl-delay: 9\n"))
        .when(hn % 6 == 4, _cat(
            "User-agent: foo\nDisallow: /\n\n# the others\nuser-agent: bar\nUser-agent: *\nDisallow: /%64e/ # c\n"
            "Crawl-delay: 1.5\nSitemap: http://", host, "/sitemap.xml\n"))
        .otherwise(F.lit("<html>404</html>"))
    )
    sitemap = F.when(hn % 3 == 1, _cat("<urlset><url><loc>http://", host, "/sm/1</loc></url><url><loc>https://", host,
                                       "/sm/2#x</loc></url></urlset>")).otherwise(F.lit(""))
    return hosts.select("id", "domain", robots.alias("robots_content"), sitemap.alias("sitemap_content"))


def stored_sites(spark: SparkSession, sf: str) -> DataFrame:
    """The sites already in the store: those under ``.com``."""
    return sites(spark, sf).where(F.col("domain").endswith(".com"))


def fetches(spark: SparkSession, sf: str) -> DataFrame:
    """Fetch results in order of ``seq``; every fifth page has the text of the page before it."""
    p = pages(spark, sf)
    before = p.select((F.col("page_id") + 1).alias("page_id"), F.col("html").alias("before_html"))
    parents = p.select(F.col("page_id").alias("parent_id"), F.col("url").alias("parent_url"))
    page_id = F.col("page_id")
    kind = page_id % 10
    content_type = F.when(kind == 6, F.lit(None).cast("string"))
    for i, text in enumerate(["text/html; charset=utf-8", "application/xhtml+xml", "application/pdf", "image/svg+xml", "text/html",
                              "text/plain", None, "application/msword", "text/xml"]):
        if text is not None:
            content_type = content_type.when(kind == i, F.lit(text))
    return (
        p.join(before, "page_id", "left")
        .withColumn("parent_id", F.when(page_id >= 3, (page_id * 7 + 3) % _n_pages(spark, sf)).otherwise(-page_id - 1))
        .join(parents, "parent_id", "left")
        .select(
            page_id.alias("seq"), "url", _host(F.col("url")).alias("domain"), "parent_url",
            F.when(page_id % 5 == 4, F.col("before_html")).otherwise(F.col("html")).alias("html"),
            content_type.otherwise(F.lit("text/html")).alias("content_type"),
            F.when(page_id % 7 == 0, F.lit(None).cast("int")).when(page_id % 7 == 1, F.lit(404)).otherwise(F.lit(200)).alias("status"),
            (F.lit(1704067200) + F.lit(60) * page_id).alias("accessed_s"),
        )
    )


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """(src, pos, dst): two links per page."""
    n = _n_pages(spark, sf)
    src = F.col("page_id")
    with_n = pages(spark, sf).select("page_id", n.alias("_n"))
    both = F.array(
        F.struct(F.lit(0).alias("pos"), ((src * 7 + 3) % F.col("_n")).alias("dst")),
        F.struct(F.lit(1).alias("pos"), ((src * 3 + 1) % F.col("_n")).alias("dst")),
    )
    return with_n.select(src.alias("src"), F.inline(both))


def link_table(spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf).select(F.col("src").alias("from_page"), F.col("dst").alias("to_page")).distinct()


def links(spark: SparkSession, sf: str) -> DataFrame:
    """(seq, parent_url, url, host): links in order of discovery, URLs as written."""
    urls = pages(spark, sf).select("page_id", "url")
    return (
        edges(spark, sf)
        .join(urls.select(F.col("page_id").alias("src"), F.col("url").alias("parent_url")), "src")
        .join(urls.select(F.col("page_id").alias("dst"), "url"), "dst")
        .select((F.col("src") * 2 + F.col("pos")).alias("seq"), "parent_url", "url", _host(F.col("url")).alias("host"))
    )


def seen(spark: SparkSession, sf: str) -> DataFrame:
    """Seen-set: the pages served over https."""
    return pages(spark, sf).select("url").where(F.col("url").startswith("https:"))


def stored_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(id, url): page index of the store, the pages without query or fragment."""
    return pages(spark, sf).select(F.col("page_id").alias("id"), "url").where(~F.col("url").rlike("[?#]"))


def host_lists(spark: SparkSession, sf: str) -> DataFrame:
    """(domain, include, exclude)."""
    return sites(spark, sf).select(
        "domain", F.col("domain").rlike("[.](com|net)$").alias("include"), F.col("domain").contains("://blog.").alias("exclude")
    )


def redirects(spark: SparkSession, sf: str) -> DataFrame:
    """(domain, robots_content, status, location): hosts without a robots text point elsewhere.

    Some reach a text, some point to themselves or in a circle, some run out of tries.
    """
    s = sites(spark, sf)
    hn = F.col("id") - 1
    empty = hn % 6 == 0
    target = F.when(hn % 24 == 6, F.col("id")).when(hn % 24 == 12, F.col("id") - 1).otherwise(F.col("id") + 5)
    moved = s.select("domain", "robots_content", F.when(empty, target).otherwise(-F.col("id")).alias("_to"),
                     F.when(empty & ~((hn % 48 == 0) & (hn > 0)), F.lit(301)).otherwise(F.lit(200)).alias("status"))
    places = s.select((F.col("id") - 1).alias("_to"), F.col("domain").alias("location"))
    return moved.join(places, "_to", "left").select("domain", "robots_content", "status", "location")


def images(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, pos, src, content_type)."""
    page_id = F.col("page_id")
    kinds = F.array(
        F.struct(F.lit(0).alias("pos"), _cat("http://img.example.com/i/", page_id.cast("string"), ".png").alias("src"),
                 F.lit("image/png").alias("content_type")),
        F.struct(F.lit(1).alias("pos"), F.lit("data:image/gif;base64,R0lGODlh").alias("src"),
                 F.lit("data:image/gif;base64,R0lGODlh").alias("content_type")),
        F.struct(F.lit(2).alias("pos"), F.lit("http://www.cms.com/x.jpg").alias("src"), F.lit("image/jpeg").alias("content_type")),
        F.struct(F.lit(3).alias("pos"), F.lit("").alias("src"), F.lit(None).cast("string").alias("content_type")),
    )
    return pages(spark, sf).select(page_id, F.inline(F.slice(kinds, F.lit(1), (page_id % 4 + 1).cast("int"))))


def page_data(spark: SparkSession, sf: str) -> DataFrame:
    """(id, page_id, data_type_code, content) from the documents."""
    kind = F.col("doc_id") % 5
    code = F.when(kind == 0, "PDF").when(kind == 1, "DOC").when(kind == 2, "DOCX").when(kind == 3, "PPT").otherwise("PPTX")
    return given_table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), (F.col("doc_id") % _n_pages(spark, sf)).alias("page_id"),
        code.alias("data_type_code"), F.col("text").alias("content"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """(seq, host, arrival_us, limit_us): events as arriving requests, users as hosts, limits of 0 to 16 hours."""
    utc = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    return given_table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("host"), F.unix_micros(utc).alias("arrival_us"),
        (F.col("user_id") % 5 * 14400000000).alias("limit_us"),
    )


def hrefs(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, url, pos, href): fourteen kinds of links for every page."""
    i = F.col("page_id").cast("string")
    url = F.col("url")
    kinds = [
        _cat("/p/q", i), _cat("q", i, ".html"), _cat("//B.example.com/x", i), _cat("mailto:a", i, "@b.example.com"),
        _cat("http://c.example.org/x?b=", i, "&a=1#t"), F.lit(""), F.lit(None).cast("string"), _cat("tel:", i),
        F.lit("https://D.example.net"), _cat("/für/", i), _cat("http://e.example.com/x?to=sms:", i),
        _cat("/f%c3%bc%2f%41 ", i), F.upper(url), _cat(url, "&z=a b&é=", i),
    ]
    return pages(spark, sf).select("page_id", "url", F.posexplode(F.array(*kinds)).alias("pos", "href"))


def marked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, url, html): the pages with further links, images, comments and scripts at the end."""
    i = F.col("page_id").cast("string")
    kind = F.col("page_id") % 3
    more = (
        F.when(kind == 0, _cat('<a href="/x">1</a><A class="b" HREF="/y?a=1&amp;b=', i, '">2</A><img src="/i/', i,
                               '.png"><img alt="z" src="data:image/gif;base64,R0">'))
        .when(kind == 1, F.lit('<!-- <a href="/no"><img src="/no.png"> --><script>var s = "<a href=/no2>";</script>'
                               '<a name="t">anchor</a><a href="">e</a><img>'))
        .otherwise(F.lit("<img class=x src='/i/q.gif'><IMG SRC=http://cms.com/y alt=y><a id=k href=/bare>b</a>"))
    )
    return pages(spark, sf).select("page_id", "url", F.concat("html", more).alias("html"))


def sitemap_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """(domain, pos, body): three sitemap bodies of every site, not in order."""
    host = F.substr("domain", F.lit(8))
    parts = F.array(
        F.struct(F.lit(2).alias("pos"), F.col("sitemap_content").alias("body")),
        F.struct(F.lit(0).alias("pos"), _cat("<urlset>", host, "</urlset>").alias("body")),
        F.struct(F.lit(10).alias("pos"), _cat("<url>", F.col("id").cast("string"), "</url>").alias("body")),
    )
    return sites(spark, sf).select("domain", F.inline(parts))


def listed_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, host): hosts of the pages, and hosts under nine kinds of public suffixes, some of no rule, a wildcard or an exception."""
    kinds = F.array(*[F.lit(x) for x in ("co.uk", "foo.ck", "www.ck", "city.kawasaki.jp", "x.kawasaki.jp", "io", "unlisted", "com.au", "ck")])
    page = F.col("page_id")
    own = F.substr(_host(F.col("url")), F.lit(8))
    made = [F.concat(F.lit(front), page.cast("string"), F.lit("."), F.get(kinds, (page % 9).cast("int"))) for front in ("a.b", "w")]
    return pages(spark, sf).select("page_id", F.explode(F.array(own, *made, F.get(kinds, (page % 9).cast("int")))).alias("host"))


def marked_fetches(spark: SparkSession, sf: str) -> DataFrame:
    """The pages with images as fetches, in order of ``seq``."""
    return marked_pages(spark, sf).select(
        F.col("page_id").alias("seq"), "url", F.lit(None).cast("string").alias("parent_url"), "html", F.lit("text/html").alias("content_type"),
        F.lit(200).alias("status"), (F.lit(1704067200) + F.lit(60) * F.col("page_id")).alias("accessed_s"),
    )


def resources(spark: SparkSession, sf: str) -> DataFrame:
    """(url, content_type, content, accessed_s): images fetched for every other page, and one image of each host, some of an unknown type."""
    page = F.col("page_id")
    own = pages(spark, sf).where(page % 2 == 0).select(
        _cat(_host(F.col("url")), "/i/", page.cast("string"), ".png").alias("url"), F.lit("image/png").alias("content_type"),
        _cat("image ", page.cast("string")).alias("content"), (F.lit(1800000000) + page).alias("accessed_s"),
    )
    shared = pages(spark, sf).select(_host(F.col("url")).alias("host")).distinct().select(
        _cat(F.col("host"), "/i/q.gif").alias("url"), F.when(F.col("host").endswith("net"), "text/html").otherwise("image/gif").alias("content_type"),
        F.col("host").alias("content"), F.lit(1900000000).cast("long").alias("accessed_s"),
    )
    return own.unionByName(shared)


#: Hosts outside ASCII.
FOREIGN_HOSTS = ["münchen.de", "BÜCHER.example:8080", "日本語.jp", "правда.рф", "faß.de", "čaj.gov.si", "例え。テスト"]


def foreign_urls(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, url): a URL on one of seven hosts outside ASCII for every page."""
    host = F.get(F.array(*[F.lit(h) for h in FOREIGN_HOSTS]), (F.col("page_id") % len(FOREIGN_HOSTS)).cast("int"))
    return pages(spark, sf).select("page_id", _cat("https://", host, "/p", F.col("page_id").cast("string"), "#x").alias("url"))
