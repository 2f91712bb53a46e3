"""The query catalog: every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe import schema
from crawlframe.functions import content, domains, robots, urls
from crawlframe.functions.html import extract_images, extract_links
from crawlframe.operators import dedup, filters, frontier, graph, reports, store
from crawlframe.operators.ids import assign_ids
from crawlframe.plans import derived, pages as page_plans
from crawlframe.plans.crawl import crawl_bfs
from crawlframe.session import checkpointed, run_dir
from crawlframe.sources import store as sinks
from crawlframe.sources import tables
from crawlframe.streaming import batches
from crawlframe.streaming import dedup as stream_dedup
from crawlframe.streaming import frontier as stream_frontier
from crawlframe.streaming import routing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Registered domains the catalog's pages are filtered by.
DOMAINS = [("example", "com"), ("ththen", "net"), ("example", "org")]
# Suffixes for the catalog's hosts, one of them of two labels.
SUFFIXES = ("com", "org", "net", "example.net")
HOUR_US = 3_600_000_000


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _canonical_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links with canonical URLs."""
    return derived.links(spark, sf).select(
        "seq", urls.canonicalize_url(F.col("parent_url")).alias("parent_url"),
        urls.canonicalize_url(F.col("url")).alias("url"), "host",
    )


def _canonical(df: DataFrame, url: str = "url") -> DataFrame:
    """Rows with a URL, made canonical. Declared not to be NULL: a join would else compute it twice, once for that test."""
    return df.where(F.col(url).isNotNull()).withColumn(url, F.coalesce(urls.canonicalize_url(F.col(url)), F.lit("")))


def _stored_index(spark: SparkSession, sf: str) -> DataFrame:
    """Stored pages, one row per canonical URL."""
    return _canonical(derived.stored_pages(spark, sf)).groupBy("url").agg(F.min("id").alias("id"))


def _pages_with_domain(spark: SparkSession, sf: str) -> DataFrame:
    return derived.pages(spark, sf).select("page_id", "url", urls.url_domain(F.col("url")).alias("domain"))


def _page_rows(spark: SparkSession, sf: str) -> DataFrame:
    return page_plans.page_rows(derived.fetches(spark, sf))


# Scans, sources and sinks


@query("scan_pages")
def scan_pages(spark: SparkSession, sf: str) -> DataFrame:
    return derived.pages(spark, sf).select("page_id", "url")


@query("scan_sites")
def scan_sites(spark: SparkSession, sf: str) -> DataFrame:
    return derived.sites(spark, sf)


@query("seed_table")
def seed_table(spark: SparkSession, sf: str) -> DataFrame:
    return tables.seed_table(derived.sites(spark, sf))


@query("code_tables")
def code_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Both code lists with the number of rows that use each code."""
    used = (
        _page_rows(spark, sf).groupBy(F.col("page_type_code").alias("code")).agg(F.count("*").alias("n_rows"))
        .withColumn("code_table", F.lit("page_type"))
        .unionByName(
            derived.page_data(spark, sf).groupBy(F.col("data_type_code").alias("code")).agg(F.count("*").alias("n_rows"))
            .withColumn("code_table", F.lit("data_type"))
        )
    )
    # Nine fixed rows.
    return used.join(F.broadcast(tables.code_tables(spark)), ["code_table", "code"], "right").select(
        "code_table", "code", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


@query("write_pages")
def write_pages(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "page")
    page_plans.store_pages(derived.fetches(spark, sf), derived.stored_sites(spark, sf), path)
    return tables.scan_pages(spark, path).select(
        "id", "site_id", "page_type_code", "url", F.octet_length("html_content").cast("long").alias("html_bytes"),
        "http_status_code", F.unix_seconds("accessed_time").alias("accessed_s"),
        F.length("html_hash").cast("long").alias("hash_chars"),
    )


@query("store_batches")
def store_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The fetches in two batches, the second given once more; pages with site, parent and document as stored."""
    fetches = checkpointed(derived.fetches(spark, sf))
    half = fetches.agg(F.floor(F.max("seq") / 2)).first()[0]
    root = run_dir(spark, "store")
    page_plans.store_batch(fetches.where(F.col("seq") <= half), root, 0, derived.stored_sites(spark, sf))
    for _ in range(2):
        page_plans.store_batch(fetches.where(F.col("seq") > half), root, 1)
    rows = {name: sinks.stored_before(spark, f"{root}/{name}", kind, 2) for name, kind in
            (("page", schema.PAGE), ("site", schema.SITE), ("link", schema.LINK), ("page_data", schema.PAGE_DATA))}
    pages = rows["page"]
    parents = pages.select(F.col("id").alias("from_page"), F.col("url").alias("parent"))
    return (
        pages.join(rows["site"].select(F.col("id").alias("site_id"), "domain"), "site_id", "left")
        .join(rows["link"].withColumnRenamed("to_page", "id").join(parents, "from_page"), "id", "left")
        .join(rows["page_data"].select(F.col("page_id").alias("id"), F.octet_length("data").cast("long").alias("data_bytes")), "id", "left")
        .select(
            "url", "domain", "page_type_code", F.octet_length("html_content").cast("long").alias("html_bytes"), "http_status_code",
            F.unix_seconds("accessed_time").alias("accessed_s"), "parent", "data_bytes",
        )
    )


@query("store_batch_images")
def store_batch_images(spark: SparkSession, sf: str) -> DataFrame:
    """The images that two batches of pages store, the second given twice, with the page's URL."""
    fetches = checkpointed(derived.marked_fetches(spark, sf))
    half = fetches.agg(F.floor(F.max("seq") / 2)).first()[0]
    root, fetched = run_dir(spark, "store"), derived.resources(spark, sf)
    page_plans.store_batch(fetches.where(F.col("seq") <= half), root, 0, resources=fetched)
    for _ in range(2):
        page_plans.store_batch(fetches.where(F.col("seq") > half), root, 1, resources=fetched)
    pages, images = (sinks.stored_before(spark, f"{root}/{n}", kind, 2) for n, kind in (("page", schema.PAGE), ("image", schema.IMAGE)))
    repeated = store.unique_violations([("pk_image_id", images, ["id"])]).select(F.col("key").cast("long").alias("id"), F.col("n_rows"))
    return (
        images.join(pages.select(F.col("id").alias("page_id"), "url"), "page_id", "left").join(repeated, "id", "left")
        .select("url", "filename", "content_type", F.md5("data").alias("data_md5"), F.unix_seconds("accessed_time").alias("accessed_s"), "n_rows")
    )


@query("write_page_data")
def write_page_data(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "page_data")
    sinks.write_page_data(derived.page_data(spark, sf), path)
    return spark.read.schema(schema.PAGE_DATA).parquet(path).select(
        "id", "page_id", "data_type_code", F.octet_length("data").cast("long").alias("n_bytes"), F.md5("data").alias("data_md5")
    )


@query("write_images")
def write_images(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "image")
    sinks.write_images(derived.images(spark, sf), path)
    return spark.read.schema(schema.IMAGE).parquet(path).select(
        "id", "page_id", "filename", "content_type", F.octet_length("data").cast("long").alias("n_bytes")
    )


@query("write_links")
def write_links(spark: SparkSession, sf: str) -> DataFrame:
    table = assign_ids(checkpointed(_page_rows(spark, sf).select("url", "parent_url", "seq")), "url")
    path = run_dir(spark, "link")
    sinks.write_links(store.first_parent_links(table), path)
    return spark.read.schema(schema.LINK).parquet(path)


@query("frontier_save_load")
def frontier_save_load(spark: SparkSession, sf: str) -> DataFrame:
    queue = dedup.dedup_by_url(_canonical_links(spark, sf))
    root = run_dir(spark, "frontier")
    sinks.save_frontier(queue, root, version=1)
    return sinks.load_frontier(spark, root).select("host", "url", "parent_url", "seq", "position")


@query("bootstrap_source")
def bootstrap_source(spark: SparkSession, sf: str) -> DataFrame:
    """Both starts: from a frontier with rows, and from an empty one."""
    sites = derived.sites(spark, sf)
    queue = derived.links(spark, sf)
    resumed = tables.bootstrap_source(queue, sites).withColumn("start", F.lit("frontier"))
    fresh = tables.bootstrap_source(queue.where(F.col("url") == ""), sites).withColumn("start", F.lit("seeds"))
    return resumed.unionByName(fresh)


# Projections, filters, predicates


@query("filter_include_hosts")
def filter_include_hosts(spark: SparkSession, sf: str) -> DataFrame:
    listed = derived.host_lists(spark, sf).where("include")
    return filters.filter_include_hosts(derived.links(spark, sf), listed).select("seq", "url", "host")


@query("filter_exclude_hosts")
def filter_exclude_hosts(spark: SparkSession, sf: str) -> DataFrame:
    listed = derived.host_lists(spark, sf).where("exclude")
    return filters.filter_exclude_hosts(derived.links(spark, sf), listed).select("seq", "url", "host")


@query("filter_registered_domain")
def filter_registered_domain(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_registered_domain(derived.pages(spark, sf).select("page_id", "url"), "url", DOMAINS, SUFFIXES)


@query("filter_nonweb_links")
def filter_nonweb_links(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_nonweb_links(derived.hrefs(spark, sf)).select("page_id", "pos", "href")


@query("filter_empty_refs")
def filter_empty_refs(spark: SparkSession, sf: str) -> DataFrame:
    links = derived.hrefs(spark, sf).select("page_id", "pos", F.col("href").alias("ref"), F.lit("href").alias("kind"))
    images = derived.images(spark, sf).select("page_id", "pos", F.col("src").alias("ref"), F.lit("src").alias("kind"))
    return filters.filter_empty_refs(links.unionByName(images), "ref")


@query("route_fetches")
def route_fetches(spark: SparkSession, sf: str) -> DataFrame:
    return filters.route_fetches(derived.fetches(spark, sf)).select("seq", "url", "extension", "data_type_code", "route")


@query("filter_image_types")
def filter_image_types(spark: SparkSession, sf: str) -> DataFrame:
    typed = derived.images(spark, sf).withColumn("extension", content.mime_extension(F.col("content_type")))
    return filters.filter_image_types(typed).select("page_id", "pos", "src", "extension")


@query("filter_image_sources")
def filter_image_sources(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_image_sources(derived.images(spark, sf), suffixes=SUFFIXES).select("page_id", "pos", "src")


@query("robots_allowed")
def robots_allowed(spark: SparkSession, sf: str) -> DataFrame:
    return store.robots_allowed(_pages_with_domain(spark, sf), derived.sites(spark, sf))


def _clock_state(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, int]:
    """Queue and host clocks at one moment, six hours after the last fetch was made.

    Fetched is what had a slot up to the middle of the time span; queued is what had arrived six
    hours later and had no slot by the middle.
    """
    slots = frontier.politeness_slots(derived.requests(spark, sf))
    span = derived.requests(spark, sf).agg(F.min("arrival_us"), F.max("arrival_us")).first()
    middle = span[0] + (span[1] - span[0]) // 2
    now = middle + 6 * HOUR_US
    clocks = slots.groupBy("host").agg(
        F.min("seq").alias("host_seq"),
        F.max(F.when(F.col("slot_us") <= middle, F.col("slot_us"))).alias("last_fetch_us"),
        F.max("limit_us").alias("limit_us"),
    )
    queue = slots.where((F.col("slot_us") > middle) & (F.col("arrival_us") <= now)).select("host", "seq", "arrival_us")
    return queue, clocks, now


@query("ready_hosts")
def ready_hosts(spark: SparkSession, sf: str) -> DataFrame:
    queue, clocks, now = _clock_state(spark, sf)
    hosts = clocks.join(frontier.frontier_queue_lengths(queue), "host")
    return filters.ready_hosts(hosts, now).select("host", "last_fetch_us", "limit_us", "queued")


@query("filter_duplicates")
def filter_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_duplicates(_page_rows(spark, sf)).select("seq", "url", "page_type_code")


@query("sites_with_sitemap")
def sites_with_sitemap(spark: SparkSession, sf: str) -> DataFrame:
    return filters.sites_with_sitemap(derived.sites(spark, sf)).select("id", "domain", "sitemap_content")


@query("default_status")
def default_status(spark: SparkSession, sf: str) -> DataFrame:
    return filters.default_status(derived.fetches(spark, sf)).select("seq", "status")


# Removal of repeats


@query("dedup_by_url")
def dedup_by_url(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_by_url(_canonical_links(spark, sf))


@query("dedup_by_content")
def dedup_by_content(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_by_content(derived.fetches(spark, sf)).select(
        "seq", "url", "page_type_code", F.octet_length("html").cast("long").alias("html_bytes"), F.md5("html").alias("html_md5"),
        F.length("html_hash").cast("long").alias("hash_chars"),
    )


@query("dedup_documents_by_content")
def dedup_documents_by_content(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.given_table(spark, sf, "documents").select("doc_id", "text")
    return dedup.dedup_by_content(docs, html="text", seq="doc_id", at="doc_id").select(
        "doc_id", "page_type_code", F.md5("text").alias("text_md5")
    )


@query("content_duplicate_groups")
def content_duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.given_table(spark, sf, "documents").select("doc_id", "text")
    return dedup.content_duplicate_groups(docs, "text", "doc_id").select("first", "n_rows", F.col("n_bytes").cast("long"))


# Joins


@query("links_not_stored")
def links_not_stored(spark: SparkSession, sf: str) -> DataFrame:
    return store.links_not_stored(_canonical_links(spark, sf), _canonical(derived.stored_pages(spark, sf))).select("seq", "url")


@query("links_not_seen")
def links_not_seen(spark: SparkSession, sf: str) -> DataFrame:
    return store.links_not_seen(_canonical_links(spark, sf), _canonical(derived.seen(spark, sf))).select("seq", "url")


@query("attach_site")
def attach_site(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived.fetches(spark, sf).select("seq", "url", "domain")
    return store.attach_site(rows, derived.stored_sites(spark, sf))


@query("first_parent_links")
def first_parent_links(spark: SparkSession, sf: str) -> DataFrame:
    rows = checkpointed(_page_rows(spark, sf).select(F.col("seq").alias("id"), "url", "parent_url", "seq"))
    return store.first_parent_links(rows)


@query("new_links_only")
def new_links_only(spark: SparkSession, sf: str) -> DataFrame:
    all_edges = derived.edges(spark, sf).withColumnsRenamed({"src": "from_page", "dst": "to_page"})
    stored = all_edges.where("pos = 0")
    return store.new_links_only(all_edges.where("pos = 1"), stored).select("from_page", "to_page")


@query("robots_match")
def robots_match(spark: SparkSession, sf: str) -> DataFrame:
    return store.robots_match(_pages_with_domain(spark, sf), derived.sites(spark, sf))


@query("missing_seed_sites")
def missing_seed_sites(spark: SparkSession, sf: str) -> DataFrame:
    return store.missing_seed_sites(derived.host_lists(spark, sf), derived.stored_sites(spark, sf))


@query("full_links")
def full_links(spark: SparkSession, sf: str) -> DataFrame:
    return store.full_links(_canonical_links(spark, sf), _stored_index(spark, sf))


@query("fk_violations")
def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    stored = derived.stored_pages(spark, sf)
    codes = tables.code_tables(spark)
    page_types, data_types = codes.where("code_table = 'page_type'"), codes.where("code_table = 'data_type'")
    link = derived.link_table(spark, sf)
    documents = derived.page_data(spark, sf)
    # Pages with the site id of their host among all hosts, of which the store has some.
    every = derived.sites(spark, sf).select("domain", F.col("id").alias("site_id"))
    page = _page_rows(spark, sf).select("domain", "page_type_code").join(every, "domain", "left")
    return store.fk_violations([
        ("fk_image_page_data", derived.images(spark, sf), "page_id", stored, "id"),
        ("fk_link_page", link, "from_page", stored, "id"),
        ("fk_link_page_1", link, "to_page", stored, "id"),
        ("fk_page_site", page, "site_id", derived.stored_sites(spark, sf), "id"),
        ("fk_page_page_type", page, "page_type_code", page_types, "code"),
        ("fk_page_data_page", documents, "page_id", stored, "id"),
        ("fk_page_data_data_type", documents, "data_type_code", data_types, "code"),
    ])


@query("resolve_host_redirects")
def resolve_host_redirects(spark: SparkSession, sf: str) -> DataFrame:
    return store.resolve_host_redirects(derived.redirects(spark, sf))


# Aggregates and reports


@query("count_sites")
def count_sites(spark: SparkSession, sf: str) -> DataFrame:
    return reports.count_rows(derived.sites(spark, sf), "n_sites")


@query("count_pages")
def count_pages(spark: SparkSession, sf: str) -> DataFrame:
    return reports.count_rows(derived.pages(spark, sf), "n_pages")


@query("count_duplicates")
def count_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return reports.count_rows(filters.filter_duplicates(_page_rows(spark, sf)), "n_duplicates")


@query("pages_by_type")
def pages_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return reports.group_counts(_page_rows(spark, sf), "page_type_code")


@query("page_type_share")
def page_type_share(spark: SparkSession, sf: str) -> DataFrame:
    return reports.group_share(_page_rows(spark, sf), "page_type_code")


@query("pages_per_site")
def pages_per_site(spark: SparkSession, sf: str) -> DataFrame:
    return reports.group_counts(_pages_with_domain(spark, sf), "domain", "n_pages")


@query("avg_pages_per_site")
def avg_pages_per_site(spark: SparkSession, sf: str) -> DataFrame:
    return reports.avg_per_group(_pages_with_domain(spark, sf), "domain", "avg_pages")


@query("count_images")
def count_images(spark: SparkSession, sf: str) -> DataFrame:
    return reports.count_rows(derived.images(spark, sf), "n_images")


@query("images_per_page")
def images_per_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.group_counts(derived.images(spark, sf), "page_id", "n_images")


@query("avg_images_per_page")
def avg_images_per_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.avg_per_group(derived.images(spark, sf), "page_id", "avg_images")


@query("documents_by_type")
def documents_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return reports.group_share(derived.page_data(spark, sf), "data_type_code")


@query("documents_per_page")
def documents_per_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.group_counts(derived.page_data(spark, sf), "page_id", "n_documents")


@query("avg_documents_per_page")
def avg_documents_per_page(spark: SparkSession, sf: str) -> DataFrame:
    return reports.avg_per_group(derived.page_data(spark, sf), "page_id", "avg_documents")


@query("crawl_summary")
def crawl_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = _page_rows(spark, sf).select("domain", "page_type_code")
    per_host = checkpointed(reports.pages_by_host(rows))
    stored = derived.stored_sites(spark, sf).select("domain")
    all_sites = stored.unionByName(per_host.select("domain")).distinct()
    return reports.crawl_summary(all_sites, per_host, derived.images(spark, sf), derived.page_data(spark, sf))


@query("unique_violations")
def unique_violations(spark: SparkSession, sf: str) -> DataFrame:
    all_edges = derived.edges(spark, sf).withColumnsRenamed({"src": "from_page", "dst": "to_page"})
    sites, codes = derived.sites(spark, sf), tables.code_tables(spark)
    pages = _canonical(derived.pages(spark, sf).select("page_id", "url"))
    # Image ids as a store would have that numbers each page's images anew: repeated wherever pages have as many.
    images = derived.images(spark, sf).select(F.col("pos").alias("id"))
    return store.unique_violations([
        ("pk_frontier_url", derived.links(spark, sf), ["url"]),
        ("unq_domain_idx", sites, ["domain"]),
        ("pk_site_id", sites, ["id"]),
        ("unq_url_idx", pages, ["url"]),
        ("pk_page_id", pages, ["page_id"]),
        ("pk_page_data_id", derived.page_data(spark, sf), ["id"]),
        ("pk_image_id", images, ["id"]),
        ("pk_data_type_code", codes.where("code_table = 'data_type'"), ["code"]),
        ("pk_page_type_code", codes.where("code_table = 'page_type'"), ["code"]),
        ("pk_link", all_edges, ["from_page", "to_page"]),
    ])


@query("frontier_queue_lengths")
def frontier_queue_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.frontier_queue_lengths(derived.links(spark, sf))


@query("concat_sitemaps")
def concat_sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    return tables.concat_sitemaps(derived.sitemap_bodies(spark, sf))


@query("graph_nodes")
def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_nodes(derived.link_table(spark, sf))


# Order within hosts


@query("frontier_positions")
def frontier_positions(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.frontier_positions(derived.links(spark, sf)).select("host", "seq", "url", "position")


@query("frontier_heads")
def frontier_heads(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.frontier_heads(derived.links(spark, sf)).select("host", "seq", "parent_url", "url")


@query("first_parent")
def first_parent(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.first_parent(_canonical_links(spark, sf))


@query("first_visit")
def first_visit(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.first_visit(_canonical_links(spark, sf)).select("seq", "url", "is_first")


@query("politeness_slots")
def politeness_slots(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.politeness_slots(derived.requests(spark, sf)).select("host", "seq", "slot_us")


@query("politeness_slots_first_waits")
def politeness_slots_first_waits(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.politeness_slots(derived.requests(spark, sf), first_fetch_waits=True).select("host", "seq", "slot_us")


@query("politeness_slots_few_hosts")
def politeness_slots_few_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Slots of three hosts, each cut into many pieces."""
    few = derived.requests(spark, sf).withColumns({"host": F.col("host") % 3, "limit_us": F.col("host") % 3 * 60_000_000})
    return frontier.politeness_slots(few, pieces=61).select("host", "seq", "slot_us")


@query("assign_ids")
def assign_ids_query(spark: SparkSession, sf: str) -> DataFrame:
    hosts = _pages_with_domain(spark, sf).select("domain").distinct()
    return assign_ids(hosts, "domain")


@query("fetch_batch")
def fetch_batch(spark: SparkSession, sf: str) -> DataFrame:
    queue, clocks, now = _clock_state(spark, sf)
    return frontier.fetch_batch(queue, clocks, now, workers=8).select("host", "seq", "host_seq")


# Sort, limit, set operations


@query("ordered_nodes")
def ordered_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_nodes(derived.link_table(spark, sf))


@query("lookup_first")
def lookup_first(spark: SparkSession, sf: str) -> DataFrame:
    """First page of the host of page 0."""
    pages = _pages_with_domain(spark, sf)
    host = pages.where("page_id = 0").select("domain").scalar()
    return store.lookup_first(pages, "domain", host, "page_id")


@query("seeds_union_sitemaps")
def seeds_union_sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    return tables.seed_table(derived.sites(spark, sf)).select("url")


@query("distinct_frontier")
def distinct_frontier(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.distinct_frontier(_canonical_links(spark, sf))


# Scalar functions


@query("canonicalize_url")
def canonicalize_url(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical form of the pages' URLs and, with their scheme, of all kinds of links."""
    href = filters.filter_empty_refs(derived.hrefs(spark, sf), "href").select("page_id", "pos", F.col("href").alias("raw"))
    own = derived.pages(spark, sf).select("page_id", F.lit(-1).alias("pos"), F.col("url").alias("raw"))
    return own.unionByName(href).select("page_id", "pos", urls.canonicalize_url(F.col("raw")).alias("canonical"))


@query("resolve_link")
def resolve_link(spark: SparkSession, sf: str) -> DataFrame:
    href = filters.filter_empty_refs(derived.hrefs(spark, sf), "href")
    return href.select("page_id", "pos", urls.resolve_link(F.col("href"), F.col("url")).alias("resolved"))


@query("url_domain")
def url_domain(spark: SparkSession, sf: str) -> DataFrame:
    return _pages_with_domain(spark, sf)


@query("url_parts")
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    return derived.pages(spark, sf).select("page_id", urls.url_parts(F.col("url")).alias("p")).select("page_id", "p.*")


@query("url_basename")
def url_basename(spark: SparkSession, sf: str) -> DataFrame:
    return derived.pages(spark, sf).select("page_id", urls.url_basename(F.col("url")).alias("basename"))


@query("registered_domain")
def registered_domain(spark: SparkSession, sf: str) -> DataFrame:
    host = domains.host_name(F.col("url"))
    return derived.pages(spark, sf).select("page_id", host.alias("host")).select(
        "page_id", "host", domains.registered_domain(F.col("host"), SUFFIXES).alias("d")
    ).select("page_id", "host", "d.*")


@query("canonicalize_url_hosts")
def canonicalize_url_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """URLs of every page with a host outside ASCII."""
    return derived.foreign_urls(spark, sf).select("page_id", "url", urls.canonicalize_url(F.col("url")).alias("canonical"))


@query("registered_domain_listed")
def registered_domain_listed(spark: SparkSession, sf: str) -> DataFrame:
    """Registered domains by the whole public-suffix list."""
    return derived.listed_hosts(spark, sf).select("page_id", "host", domains.registered_domain(F.col("host")).alias("d")).select("page_id", "host", "d.*")


@query("filter_registered_domain_listed")
def filter_registered_domain_listed(spark: SparkSession, sf: str) -> DataFrame:
    urls_of = derived.listed_hosts(spark, sf).select("page_id", F.concat(F.lit("https://"), "host", F.lit("/x")).alias("url"))
    kept = [("example", "com"), ("w8", "io"), ("b8", "com.au"), ("www", "ck"), ("city", "kawasaki.jp")]
    return filters.filter_registered_domain(urls_of, "url", kept)


@query("extract_links")
def extract_links_query(spark: SparkSession, sf: str) -> DataFrame:
    return derived.marked_pages(spark, sf).select("page_id", F.posexplode(extract_links(F.col("html"))).alias("pos", "href"))


@query("extract_images")
def extract_images_query(spark: SparkSession, sf: str) -> DataFrame:
    return derived.marked_pages(spark, sf).select("page_id", F.posexplode(extract_images(F.col("html"))).alias("pos", "src"))


@query("mime_extension")
def mime_extension(spark: SparkSession, sf: str) -> DataFrame:
    return derived.fetches(spark, sf).select("seq", content.mime_extension(F.col("content_type")).alias("extension"))


@query("url_extension_fallback")
def url_extension_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Fallback for every page URL with, in turn, each suffix put behind it."""
    suffix = F.explode(F.array(*[F.lit(s) for s in ["", "pdf", ".ppt", "pptx", ".doc", "x.docx"]])).alias("suffix")
    named = derived.pages(spark, sf).select("page_id", "url", suffix)
    return named.select("page_id", "suffix", content.url_extension(F.concat("url", "suffix")).alias("extension"))


@query("extension_datatype")
def extension_datatype(spark: SparkSession, sf: str) -> DataFrame:
    return filters.route_fetches(derived.fetches(spark, sf)).select("seq", "extension", "data_type_code")


@query("robots_rules")
def robots_rules(spark: SparkSession, sf: str) -> DataFrame:
    rules = robots.robots_rules(F.col("robots_content"))
    return derived.sites(spark, sf).select("domain", F.posexplode(rules).alias("rule_seq", "rule")).select(
        "domain", "rule_seq", "rule.allow", "rule.path"
    )


@query("robots_limits")
def robots_limits(spark: SparkSession, sf: str) -> DataFrame:
    limits = robots.robots_limits(F.col("robots_content"))
    return derived.sites(spark, sf).select("domain", limits.alias("l")).select("domain", "l.*")


@query("robots_sitemaps")
def robots_sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    found = robots.robots_sitemaps(F.col("robots_content"))
    return derived.sites(spark, sf).select("domain", F.posexplode(found).alias("pos", "sitemap"))


@query("sitemap_locations")
def sitemap_locations(spark: SparkSession, sf: str) -> DataFrame:
    found = robots.sitemap_locations(F.col("sitemap_content"))
    return derived.sites(spark, sf).select("domain", F.posexplode(found).alias("pos", "url"))


@query("robots_normalized")
def robots_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return derived.sites(spark, sf).select("domain", robots.robots_normalized(F.col("robots_content")).alias("robots"))


@query("content_hash")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return derived.pages(spark, sf).select("page_id", content.content_hash(F.col("html")).alias("html_hash"))


@query("content_hash_groups")
def content_hash_groups(spark: SparkSession, sf: str) -> DataFrame:
    """First document, number of documents and digest length of every digest."""
    hashed = tables.given_table(spark, sf, "documents").select("doc_id", content.content_hash(F.col("text")).alias("html_hash"))
    groups = hashed.where(F.col("html_hash").isNotNull()).groupBy("html_hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_rows"))
    return groups.select("first", "n_rows", F.length("html_hash").cast("long").alias("hash_chars"))


@query("content_bytes")
def content_bytes(spark: SparkSession, sf: str) -> DataFrame:
    data = content.content_bytes(F.col("text"))
    return tables.given_table(spark, sf, "documents").select(
        "doc_id", F.octet_length(data).cast("long").alias("n_bytes"), F.md5(data).alias("data_md5")
    )


# Whole plans


@query("expand_frontier")
def expand_frontier(spark: SparkSession, sf: str) -> DataFrame:
    """New queue rows from all pages: extraction, resolution, filters and both joins with the store."""
    pages = derived.marked_pages(spark, sf).withColumnRenamed("page_id", "seq")
    excluded = derived.host_lists(spark, sf).where("exclude")
    return page_plans.expand_frontier(
        pages, _canonical(derived.stored_pages(spark, sf)), _canonical(derived.seen(spark, sf)), exclude=excluded
    )


# Link graph


@query("graph_edges")
def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_edges(derived.link_table(spark, sf))


@query("graph_undirected")
def graph_undirected(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_undirected(derived.link_table(spark, sf))


@query("graph_all_nodes")
def graph_all_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_all_nodes(derived.link_table(spark, sf))


@query("crawl_bfs")
def crawl_bfs_query(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl from the pages with a trailing slash, leaving out listed hosts and what robots rules deny."""
    pages = _pages_with_domain(spark, sf)
    allowed = store.robots_allowed(pages, derived.sites(spark, sf))
    excluded = derived.host_lists(spark, sf).where("exclude")
    open_pages = filters.filter_exclude_hosts(allowed, excluded, host="domain").select(F.col("page_id").alias("dst"))
    edges = derived.edges(spark, sf).join(open_pages, "dst", "left_semi")
    seeds = pages.where(F.col("url").endswith("/")).select(F.col("page_id").alias("page"))
    return crawl_bfs(seeds, edges)


# Streams. Each is fed in two parts and drained after each, so the second run starts from the first's state.


def _replay(spark: SparkSession, rows: DataFrame, order: str, root: str, start: Callable[[DataFrame], object]) -> None:
    """Write ``rows`` in two parts by ``order`` and drain the stream over them after each."""
    middle = rows.agg(F.percentile_approx(order, 0.5)).first()[0]
    in_first = F.col(order) <= middle
    for part in (rows.where(in_first), rows.where(~in_first)):
        part.write.mode("append").parquet(f"{root}/input")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/input")
        start(stream).awaitTermination()


@query("stream_dedup_urls")
def stream_dedup_urls(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "stream-urls")
    _replay(spark, derived.links(spark, sf), "seq", root, lambda s: stream_dedup.start_dedup_urls(s, root, order="seq"))
    return spark.read.parquet(f"{root}/urls").select("url")


@query("stream_dedup_content")
def stream_dedup_content(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "stream-content")
    _replay(spark, derived.fetches(spark, sf), "seq", root, lambda s: stream_dedup.start_dedup_content(s, root))
    return spark.read.parquet(f"{root}/pages").select(
        "seq", "url", "page_type_code", F.octet_length("html").cast("long").alias("html_bytes"), F.md5("html").alias("html_md5"),
        F.length("html_hash").cast("long").alias("hash_chars"),
    )


@query("stream_frontier_expand")
def stream_frontier_expand(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "stream-frontier")
    pages = derived.marked_pages(spark, sf).withColumnRenamed("page_id", "seq")
    known = _canonical(derived.stored_pages(spark, sf)).select("url").unionByName(_canonical(derived.seen(spark, sf)))
    excluded = derived.host_lists(spark, sf).where("exclude")
    _replay(spark, pages, "seq", root, lambda s: stream_frontier.start_frontier_expand(s, root, known, exclude=excluded))
    return spark.read.parquet(f"{root}/frontier").select("host", "seq", "pos", "parent_url", "url")


@query("stream_politeness")
def stream_politeness(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "stream-politeness")
    _replay(spark, derived.requests(spark, sf), "arrival_us", root, lambda s: stream_frontier.start_politeness(s, root))
    return spark.read.parquet(f"{root}/slots").select("host", "seq", "slot_us")


@query("stream_route_results")
def stream_route_results(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "stream-routes")
    handlers = {
        route: (lambda df, batch_id, route=route: batches.write_batch(
            df.select("seq", "url", "data_type_code"), f"{root}/out/route={route}", batch_id))
        for route in ("website", "document")
    }
    _replay(spark, derived.fetches(spark, sf), "seq", root, lambda s: routing.start_route_results(s, root, handlers))
    return spark.read.parquet(f"{root}/out").select("route", "seq", "url", "data_type_code")
