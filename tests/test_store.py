"""Writers and readers of the crawl store."""

import hashlib

from pyspark.sql import functions as F

from crawlframe import schema
from crawlframe.operators.frontier import frontier_heads
from crawlframe.operators.store import fk_violations, unique_violations
from crawlframe.plans.pages import page_image_sources, store_batch, store_pages
from crawlframe.sources import store, tables

FETCHES = "seq long, url string, parent_url string, html string, content_type string, status int, accessed_s long"


def test_store_pages(spark, tmp_path):
    rows = [
        (1, "https://A.si", None, "<p>one</p>", "text/html", 200, 10),
        (2, "http://a.si/x", "http://a.si/", "<p>one</p>", "text/html", None, 20),
        (3, "http://a.si/", "http://a.si/x", "<p>again</p>", "text/html", 200, 30),
        (4, "http://b.si/d.pdf", "http://a.si/", "pdf text", None, 200, 40),
        (5, "http://b.si/t", "http://a.si/", "text", "text/plain", 200, 50),
    ]
    path = str(tmp_path / "page")
    sites = spark.createDataFrame([(9, "http://b.si")], "id long, domain string")
    store_pages(spark.createDataFrame(rows, FETCHES), sites, path)
    got = {r.url: r for r in tables.scan_pages(spark, path).collect()}
    assert set(got) == {"http://a.si/", "http://a.si/x", "http://b.si/d.pdf"}
    assert {u: r.page_type_code for u, r in got.items()} == {
        "http://a.si/": "HTML", "http://a.si/x": "DUPLICATE", "http://b.si/d.pdf": "BINARY"}
    first = got["http://a.si/"]
    assert first.html_content == "<p>one</p>" and first.html_hash == hashlib.sha512(b"<p>one</p>").hexdigest()
    assert got["http://a.si/x"].html_content is None and got["http://a.si/x"].http_status_code == 204
    assert got["http://b.si/d.pdf"].site_id == 9 and first.site_id == got["http://a.si/x"].site_id == 10
    assert sorted(r.id for r in got.values()) == [1, 2, 3]
    assert tables.scan_pages(spark, path, ["url"]).columns == ["url"]


def test_schema_of_stored_pages(spark, tmp_path):
    path = str(tmp_path / "page")
    store.write_pages(spark.createDataFrame([(1, "http://a.si/", "HTML")], "id int, url string, page_type_code string"), path)
    stored = tables.scan_pages(spark, path)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema.PAGE]
    row = stored.first()
    assert (row.id, row.url, row.page_type_code, row.html_hash) == (1, "http://a.si/", "HTML", None)


def test_page_data_and_images(spark, tmp_path):
    docs = spark.createDataFrame([(1, 5, "PDF", "für"), (2, 5, "DOC", "")], "id long, page_id long, data_type_code string, content string")
    store.write_page_data(docs, str(tmp_path / "d"))
    got = spark.read.schema(schema.PAGE_DATA).parquet(str(tmp_path / "d")).orderBy("id").collect()
    assert [bytes(r.data) for r in got] == ["für".encode(), b""]
    images = spark.createDataFrame(
        [(5, 0, "http://a.si/i/x.png", "image/png", "bytes"), (5, 1, "data:image/gif;base64,R0", None, None), (6, 0, "", "image/png", None),
         (6, 1, "http://a.cms.si/y.png", "image/png", ""), (6, 2, "http://a.si/z", "text/html", ""), (6, 3, None, "image/png", "")],
        "page_id long, pos int, src string, content_type string, content string")
    store.write_images(images, str(tmp_path / "i"))
    got = spark.read.schema(schema.IMAGE).parquet(str(tmp_path / "i")).collect()
    assert {(r.page_id, r.filename, r.content_type, bytes(r.data)) for r in got} == {
        (5, "x.png", ".png", b"bytes"), (5, "", ".gif", b"data:image/gif;base64,R0")}
    assert sorted(r.id for r in got) == [1, 2]


def test_image_sources_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.si/", '<img src="/1.png"><img src=""><img src="http://x.cms.si/2"><img src="data:image/png;base64,AA">')],
                                  "seq long, url string, html string")
    assert [r.src for r in page_image_sources(pages).orderBy("pos").collect()] == ["/1.png", "data:image/png;base64,AA"]


def test_frontier_versions(spark, tmp_path):
    root = str(tmp_path)
    queue = spark.createDataFrame([("http://a.si/1", None, 5), ("http://a.si/2", "http://a.si/1", 3), ("http://b.si/", None, 4)],
                                  "url string, parent_url string, seq long")
    store.save_frontier(queue, root, 1)
    got = {(r.host, r.url): r.position for r in store.load_frontier(spark, root).collect()}
    assert got == {("http://a.si", "http://a.si/2"): 1, ("http://a.si", "http://a.si/1"): 2, ("http://b.si", "http://b.si/"): 1}
    store.save_frontier(queue.where("seq = 4"), root, 2)
    assert [r.url for r in store.load_frontier(spark, root).collect()] == ["http://b.si/"]
    store.save_frontier(queue.limit(0), root, 3)
    assert store.load_frontier(spark, root).isEmpty()


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    edges = spark.range(4).select(F.col("id").alias("from_page"), (F.col("id") + 1).alias("to_page"))
    for _ in range(2):
        store.write_links(edges, str(tmp_path), batch_id=7)
    assert spark.read.parquet(str(tmp_path)).count() == 4


def test_host_list(spark):
    got = {r.domain for r in tables.host_list(spark, ["www.A.si", "https://b.si:80/x"]).collect()}
    assert got == {"http://www.a.si", "http://b.si:80"}
    assert tables.host_list(spark, schema.SEED_HOSTS).count() == 5


FETCHES = "seq long, url string, parent_url string, html string, content_type string, status int, accessed_s long"


def _fetch(seq, url, html, parent=None, kind="text/html"):
    return (seq, url, parent, html, kind, 200, 1000 + seq)


def test_a_second_batch_knows_the_first(spark, tmp_path):
    root = str(tmp_path / "store")
    one = [_fetch(1, "http://a.si/", "A"), _fetch(2, "http://b.si/x", "B", "http://a.si/")]
    two = [_fetch(3, "http://a.si", "again"), _fetch(4, "http://c.si/", "A", "http://b.si/x"), _fetch(5, "http://b.si/d.pdf", "doc", "http://c.si/", "application/pdf")]
    store_batch(spark.createDataFrame(one, FETCHES), root, 0)
    for _ in range(2):
        store_batch(spark.createDataFrame(two, FETCHES), root, 1)
    read = {n: store.stored_before(spark, f"{root}/{n}", t, 2) for n, t in (("page", schema.PAGE), ("site", schema.SITE), ("link", schema.LINK), ("page_data", schema.PAGE_DATA))}
    sites = {r.domain: r.id for r in read["site"].collect()}
    assert sorted(sites.values()) == [1, 2, 3] and len(sites) == 3
    pages = {r.url: r for r in read["page"].collect()}
    assert {u: (p.page_type_code, p.html_content) for u, p in pages.items() if p.url != "http://a.si"} == {
        "http://a.si/": ("HTML", "A"), "http://b.si/x": ("HTML", "B"), "http://c.si/": ("DUPLICATE", None), "http://b.si/d.pdf": ("BINARY", None),
    }
    assert sorted(p.id for p in pages.values()) == list(range(1, len(pages) + 1))
    assert pages["http://b.si/d.pdf"].site_id == pages["http://b.si/x"].site_id
    by_id = {p.id: u for u, p in pages.items()}
    edges = {(by_id[r.from_page], by_id[r.to_page]) for r in read["link"].collect()}
    assert edges == {("http://a.si/", "http://b.si/x"), ("http://b.si/x", "http://c.si/"), ("http://c.si/", "http://b.si/d.pdf")}
    assert [(r.page_id, bytes(r.data)) for r in read["page_data"].collect()] == [(pages["http://b.si/d.pdf"].id, b"doc")]
    keys = [("page_id", read["page"], ["id"]), ("page_url", read["page"], ["url"]), ("site_id", read["site"], ["id"]), ("domain", read["site"], ["domain"]), ("link", read["link"], ["from_page", "to_page"])]
    assert unique_violations(keys).count() == 0
    assert fk_violations([("page_site", read["page"], "site_id", read["site"], "id"), ("link_to", read["link"], "to_page", read["page"], "id")]).count() == 0


def test_keys_with_commas_are_not_confused(spark):
    rows = spark.createDataFrame([("a,b", "c"), ("a", "b,c"), ("x", "y"), ("x", "y")], "p string, q string")
    assert [(r.key, r.n_rows) for r in unique_violations([("k", rows, ["p", "q"])]).collect()] == [("x,y", 2)]


def test_links_of_one_page_keep_their_order(spark, tmp_path):
    root = str(tmp_path / "frontier")
    rows = [("http://a.si", f"http://a.si/{k}", None, 7, pos) for pos, k in enumerate((5, 3, 9, 1))]
    queue = spark.createDataFrame(rows, "host string, url string, parent_url string, seq long, pos int")
    store.save_frontier(queue.orderBy("url"), root, 1)
    loaded = store.load_frontier(spark, root)
    assert [r.url[-1] for r in loaded.orderBy("position").collect()] == list("5391")
    assert frontier_heads(queue.orderBy("url"), ["pos"]).first().url == "http://a.si/5"


def test_images_of_batches(spark, tmp_path):
    """Ids go on over batches, a batch that runs twice included; of a source the first fetch counts; unknown types and sources give nothing."""
    root = str(tmp_path / "store")
    pages = [
        _fetch(1, "http://a.si/", '<img src="/x.png"><img src="data:image/gif;base64,R0"><img src="/none.png">'),
        _fetch(2, "http://b.si/d.pdf", '<img src="/x.png">', kind="application/pdf"),
        _fetch(3, "http://a.si/2", '<img src="x.png"><img src="/t.html"><img src="http://x.cms.si/x.png">'),
        _fetch(4, "http://a.si/2", '<img src="/x.png">'),
    ]
    fetched = [("https://a.si/x.png", "image/png", "late", 9), ("http://a.si/x.png", "image/png", "early", 5), ("http://a.si/t.html", "text/html", "t", 5), (None, "image/png", "n", 1)]
    resources = spark.createDataFrame(fetched, "url string, content_type string, content string, accessed_s long")
    for batch, rows in ((0, pages[:2]), (1, pages[2:]), (1, pages[2:]), (2, [])):
        store_batch(spark.createDataFrame(rows, FETCHES), root, batch, resources=resources)
    urls = {r.id: r.url for r in store.stored_before(spark, f"{root}/page", schema.PAGE, 3).collect()}
    images = store.stored_before(spark, f"{root}/image", schema.IMAGE, 3).collect()
    assert sorted((urls[r.page_id], r.filename, r.content_type, bytes(r.data), int(r.accessed_time.timestamp())) for r in images) == [
        ("http://a.si/", "", ".gif", b"data:image/gif;base64,R0", 1001), ("http://a.si/", "x.png", ".png", b"early", 5), ("http://a.si/2", "x.png", ".png", b"early", 5)]
    assert sorted(r.id for r in images) == [1, 2, 3]


def test_written_images_go_on_from_the_highest_id(spark, tmp_path):
    images = spark.createDataFrame([(1, 0, "http://a.si/1.png", "image/png"), (1, 1, "http://a.si/2.png", "image/png")], "page_id long, pos int, src string, content_type string")
    for batch in (0, 1, 1):
        store.write_images(images, str(tmp_path / "i"), batch)
    assert sorted(r.id for r in spark.read.schema("id long").parquet(str(tmp_path / "i")).collect()) == [1, 2, 3, 4]
    for _ in range(2):
        store.write_images(images, str(tmp_path / "j"))
    assert sorted(r.id for r in spark.read.schema("id long").parquet(str(tmp_path / "j")).collect()) == [1, 2, 3, 4]
