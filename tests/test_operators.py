"""Operators against plain Python on small tables, with hot groups cut on purpose."""

import random

import pytest
from pyspark.sql import functions as F

from crawlframe.operators import dedup, filters, frontier, graph, reports, store
from crawlframe.operators.ids import assign_ids
from crawlframe.operators.skew import rank_in_group
from crawlframe.plans import pages as page_plans
from crawlframe.plans.crawl import crawl_bfs, crawl_pages
from crawlframe.sources import tables


@pytest.fixture(scope="module")
def requests_rows():
    """Arriving requests; host 1 has a third of them."""
    rng = random.Random(3)
    rows = []
    for seq in range(1500):
        host = 1 if rng.random() < 0.35 else rng.randint(2, 40)
        rows.append((seq, host, rng.randint(0, 40_000), host % 4 * 37))
    return rows


def slots_by_rule(rows, last=None, first_waits=False):
    clock, out = dict(last or {}), {}
    for seq, host, arrival, limit in sorted(rows, key=lambda r: (r[2], r[0])):
        if host not in clock and first_waits:
            clock[host] = arrival
        out[seq] = max(arrival, clock[host] + limit) if host in clock else arrival
        clock[host] = out[seq]
    return out, clock


REQUESTS = "seq long, host long, arrival_us long, limit_us long"


@pytest.mark.parametrize("pieces", [1, 8, 300])
@pytest.mark.parametrize("first_waits", [False, True])
def test_politeness_slots(spark, requests_rows, pieces, first_waits):
    df = spark.createDataFrame(requests_rows, REQUESTS)
    got = frontier.politeness_slots(df, first_fetch_waits=first_waits, pieces=pieces).collect()
    assert {r.seq: r.slot_us for r in got} == slots_by_rule(requests_rows, first_waits=first_waits)[0]


@pytest.mark.parametrize("pieces", [1, 8, 300])
@pytest.mark.parametrize("first_waits", [False, True])
def test_politeness_slots_go_on_from_last_slots(spark, requests_rows, pieces, first_waits):
    rows = sorted(requests_rows, key=lambda r: (r[2], r[0]))
    early, late = rows[:600], rows[600:]
    _, clock = slots_by_rule(early, first_waits=first_waits)
    last = spark.createDataFrame(list(clock.items()), "host long, last_slot_us long")
    got = frontier.politeness_slots(spark.createDataFrame(late, REQUESTS), last, first_waits, pieces).collect()
    assert {r.seq: r.slot_us for r in got} == slots_by_rule(late, clock, first_waits)[0]
    assert len(got) == len(late)


@pytest.mark.parametrize("pieces", [1, 8, 300])
def test_rank_in_group_with_a_hot_group(spark, pieces):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", f"h{rng.randint(0, 99)}"]), seq * 7 % 10_007, f"u{seq}") for seq in range(3000)]
    rows += [(None, 5, "n1"), (None, 6, "n2")]
    df = spark.createDataFrame(rows, "host string, seq long, url string")
    want, counts = {}, {}
    for host, _, url in sorted(rows, key=lambda r: r[1]):
        counts[host] = counts.get(host, 0) + 1
        want[url] = counts[host]
    got = rank_in_group(df, "host", "seq", "position", pieces=pieces).collect()
    assert len(got) == len(rows) and {r.url: r.position for r in got} == want


def test_a_hot_group_fills_many_pieces(spark):
    from crawlframe.operators.skew import PIECE, cut_in_pieces

    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("host"),
                                    F.lit(7).alias("arrival_us"), F.col("id").alias("seq"))
    cut = cut_in_pieces(df, "host", ["arrival_us", "seq"], 16)
    of_hot = cut.where("host = 'hot'").groupBy(PIECE).count().collect()
    assert len(of_hot) >= 5 and max(r["count"] for r in cut.groupBy(PIECE).count().collect()) < 2 * 10_000 / 16
    # Others of its group come before a piece of the first group of a range only.
    carried = cut.groupBy("host", PIECE).count().groupBy("host").agg(F.min(PIECE).alias("low"), F.max(PIECE).alias("high"))
    assert carried.where("high > low").count() <= 15


def test_equal_arrivals_are_cut_by_seq(spark):
    rows = [(seq, 1, 5, 10) for seq in range(500)] + [(seq, 2, 7, None) for seq in range(500, 520)]
    got = frontier.politeness_slots(spark.createDataFrame(rows, REQUESTS), pieces=12).collect()
    assert {r.seq: r.slot_us for r in got} == {s: 5 + 10 * s if h == 1 else 7 for s, h, _, _ in rows}


def test_the_plan_is_the_same_at_every_size(spark, requests_rows):
    def shape(rows):
        plan = frontier.frontier_positions(spark.createDataFrame(rows, REQUESTS), pieces=8)._jdf.queryExecution().sparkPlan().toString()
        return [line.strip(" :+-").split(" ")[0].split("(")[0] for line in plan.splitlines()]

    assert shape(requests_rows) == shape(requests_rows[:3])


def test_assign_ids(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") * 2).alias("v"))
    got = assign_ids(keys, "key", start=11).collect()
    assert sorted(r.id for r in got) == list(range(11, 5011))
    assert all(r.v == int(r.key[1:]) * 2 for r in got)
    again = {r.key: r.id for r in assign_ids(keys.repartition(13), "key", start=11).collect()}
    assert again == {r.key: r.id for r in got}


def test_dedup_by_url_and_first_visit(spark):
    rows = [(3, "a", "p3"), (1, "a", None), (2, "b", "p2"), (5, "a", "p5"), (4, "b", "p4")]
    df = spark.createDataFrame(rows, "seq long, url string, parent_url string")
    assert sorted(tuple(r) for r in dedup.dedup_by_url(df).collect()) == [(1, "a", None), (2, "b", "p2")]
    flags = {r.seq: r.is_first for r in dedup.first_visit(df).collect()}
    assert flags == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_dedup_by_content_keeps_one_text_per_hash(spark):
    rng = random.Random(9)
    rows = [(i, rng.randint(0, 50), rng.choice([None, "", "x", "ü", f"t{rng.randint(0, 200)}"])) for i in range(800)]
    df = spark.createDataFrame(rows, "seq long, accessed_s long, html string")
    got = {r.seq: r for r in dedup.dedup_by_content(df).collect()}
    first = {}
    for seq, at, html in sorted(rows, key=lambda r: (r[1], r[0])):
        if html is not None:
            first.setdefault(html, seq)
    for seq, _, html in rows:
        kept = html is None or first[html] == seq
        assert got[seq].page_type_code == ("HTML" if kept else "DUPLICATE")
        assert got[seq].html == (html if kept else None)
        assert (got[seq].html_hash is None) == (not kept or html is None)


def test_anti_and_semi_joins_split_the_input(spark):
    links = spark.range(200).select(F.concat(F.lit("u"), F.col("id") % 90).alias("url"))
    stored = spark.range(40).select(F.concat(F.lit("u"), "id").alias("url"))
    missing = store.links_not_stored(links, stored).count()
    assert missing + links.join(stored, "url", "left_semi").count() == 200 and missing == store.links_not_seen(links, stored).count()


def test_host_filters(spark):
    links = spark.createDataFrame([("http://a.si",), ("http://www.a.si",), ("http://b.si",)], "host string")
    hosts = spark.createDataFrame([("http://a.si",)], "domain string")
    assert [r.host for r in filters.filter_include_hosts(links, hosts).collect()] == ["http://a.si"]
    assert sorted(r.host for r in filters.filter_exclude_hosts(links, hosts).collect()) == ["http://b.si", "http://www.a.si"]
    assert filters.filter_include_hosts(links, None) is links and filters.filter_exclude_hosts(links, None) is links


def test_attach_site_creates_missing_sites(spark):
    pages = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "domain string")
    sites = spark.createDataFrame([(7, "a")], "id long, domain string")
    ids = [(r.domain, r.site_id) for r in store.attach_site(pages, sites).collect()]
    assert ("a", 7) in ids and len(ids) == 4 and {i for _, i in ids} == {7, 8, 9} and len(set(ids)) == 3
    assert sorted(r.id for r in store.new_sites(pages, sites.limit(0)).collect()) == [1, 2, 3]


def test_first_parent_links(spark):
    rows = [(1, "a", None, 1), (2, "b", "a", 2), (3, "c", "d", 3), (4, "d", "a", 4), (5, "e", "e", 5)]
    df = spark.createDataFrame(rows, "id long, url string, parent_url string, seq long")
    assert sorted(tuple(r) for r in store.first_parent_links(df).collect()) == [(1, 2), (1, 4)]


@pytest.mark.parametrize("hosts, want", [
    ([("a", "", 301, "b"), ("b", "R", 200, None)], ("b", 2, "R")),
    ([("a", "", 301, "b"), ("b", "", 302, "c"), ("c", "R", 200, None)], ("c", 3, "R")),
    ([("a", "", 301, "b"), ("b", "", 302, "c"), ("c", "", 301, "d"), ("d", "R", 200, None)], ("c", 3, "")),
    ([("a", "", 301, "a")], ("a", 1, "")),
    ([("a", "", 301, "b"), ("b", "", 301, "a")], ("b", 2, "")),
    ([("a", "R", 301, "b"), ("b", "S", 200, None)], ("a", 1, "R")),
    ([("a", "", 200, "b"), ("b", "S", 200, None)], ("a", 1, "")),
    ([("a", None, 301, "x")], ("x", 2, "")),
])
def test_resolve_host_redirects(spark, hosts, want):
    df = spark.createDataFrame(hosts, "domain string, robots_content string, status int, location string")
    r = store.resolve_host_redirects(df).where("domain = 'a'").first()
    assert (r.final_domain, r.tries, r.robots_content) == want


def test_robots_match(spark):
    sites = spark.createDataFrame([("http://a.si", "User-agent: *\nAllow: /x/y\nDisallow: /x\n"), ("http://b.si", "")],
                                  "domain string, robots_content string")
    urls = spark.createDataFrame([("http://a.si", "http://a.si/x/y/z"), ("http://a.si", "http://a.si/x"), ("http://b.si", "http://b.si/x"),
                                  ("http://c.si", "http://c.si/x")], "domain string, url string")
    got = {r.url: r.allowed for r in store.robots_match(urls, sites).collect()}
    assert got == {"http://a.si/x/y/z": True, "http://a.si/x": False, "http://b.si/x": True, "http://c.si/x": True}


def test_fetch_batch(spark):
    queue = spark.createDataFrame([("a", 5), ("a", 3), ("b", 4), ("c", 9), ("d", 1)], "host string, seq long")
    clocks = spark.createDataFrame([("a", 2, 90, 10), ("b", 1, 95, 10), ("c", 3, None, 10), ("d", 4, 50, 10), ("e", 0, 0, 0)],
                                   "host string, host_seq int, last_fetch_us long, limit_us long")
    assert [(r.host, r.seq) for r in frontier.fetch_batch(queue, clocks, 100, 2).collect()] == [("a", 3), ("c", 9)]


def test_bootstrap_source(spark):
    sites = spark.createDataFrame([("http://a.si", "<loc>https://A.si/x</loc>"), ("http://b.si", None), ("http://c.si", "")],
                                  "domain string, sitemap_content string")
    queue = spark.createDataFrame([("p", "u")], "parent_url string, url string")
    assert [tuple(r) for r in tables.bootstrap_source(queue, sites).collect()] == [("p", "u")]
    seeds = sorted(r.url for r in tables.bootstrap_source(queue.limit(0), sites).collect())
    assert seeds == ["http://a.si", "http://a.si/x", "http://b.si", "http://c.si"]


def test_graph(spark):
    links = spark.createDataFrame([(3, 1), (1, 3), (2, 2), (1, 4)], "from_page long, to_page long")
    assert sorted(tuple(r) for r in graph.graph_undirected(links).collect()) == [(1, 3), (1, 4), (2, 2)]
    assert [r.from_page for r in graph.graph_nodes(links).collect()] == [1, 2, 3]
    assert sorted(r.page for r in graph.graph_all_nodes(links).collect()) == [1, 2, 3, 4]


def test_reports_of_empty_tables(spark):
    empty = spark.createDataFrame([], "site_id long, page_id long, page_type_code string, domain string")
    assert reports.avg_per_group(empty, "site_id", "a").collect()[0].a is None
    got = {r.metric: r.value for r in reports.crawl_summary(empty, reports.pages_by_host(empty), empty, empty).collect()}
    assert got["sites"] == 0 and got["pages"] == 0 and got["avg_images_per_page"] is None and len(got) == 8


def test_averages_round_half_even(spark):
    rows = spark.range(9).select((F.col("id") % 4).alias("k"))
    assert reports.avg_per_group(rows, "k", "a").first().a == 2.2


def test_crawl_bfs(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 60), rng.randint(0, 90)) for _ in range(160)] + [(i, i + 1) for i in range(100, 140)] + [(0, 100)]
    seeds = {0, 7}
    depth, parent, level = {s: 0 for s in seeds}, {s: None for s in seeds}, set(seeds)
    while level:
        found = {}
        for s, d in edges:
            if s in level and d not in depth:
                found[d] = min(s, found.get(d, s))
        for d, s in found.items():
            depth[d], parent[d] = depth[s] + 1, s
        level = set(found)
    df = spark.createDataFrame(edges, "src long, dst long")
    start = spark.createDataFrame([(s,) for s in seeds], "page long")
    got = crawl_bfs(start, df).collect()
    assert {r.page: (r.parent, r.depth) for r in got} == {p: (parent[p], depth[p]) for p in depth} and len(got) == len(depth)
    shallow = crawl_bfs(start, df, max_depth=2).collect()
    assert {r.page for r in shallow} == {p for p in depth if depth[p] <= 2}


def test_expand_frontier_raw_filter(spark):
    pages = spark.createDataFrame([(1, "http://a.gov.si/z", '<a href="/x"><a href="http://b.gov.si/y"><a href="http://c.com/"><a href="mailto:a@gov.si">')],
                                  "seq long, url string, html string")
    stored = spark.createDataFrame([], "url string")
    wide = page_plans.expand_frontier(pages, stored, registered=[("gov", "si")])
    assert sorted(r.url for r in wide.collect()) == ["http://a.gov.si/x", "http://b.gov.si/y"]
    raw = page_plans.expand_frontier(pages, stored, registered=[("gov", "si")], raw_filter=True)
    assert [r.url for r in raw.collect()] == ["http://b.gov.si/y"]


def test_crawl_pages(spark):
    pages = spark.createDataFrame([
        (1, "http://a.si", '<a href="/x"><a href="http://b.si/"><a href="/no/1">'),
        (2, "https://a.si/x", '<a href="/y#t"><a href="/"><a href="/x">'),
        (3, "http://b.si/", '<a href="http://c.si/z">'),
        (4, "http://c.si/z", '<a href="http://a.si/never">'),
    ], "seq long, url string, html string")
    sites = spark.createDataFrame([("http://a.si", "User-agent: *\nDisallow: /no/\n")], "domain string, robots_content string")
    exclude = spark.createDataFrame([("http://c.si",)], "domain string")
    seeds = spark.createDataFrame([("https://A.si",)], "url string")
    got = {(r.page, r.parent, r.depth) for r in crawl_pages(seeds, pages, sites, exclude=exclude).collect()}
    assert got == {("http://a.si/", None, 0), ("http://a.si/x", "http://a.si/", 1), ("http://b.si/", "http://a.si/", 1),
                   ("http://a.si/y", "http://a.si/x", 2)}
