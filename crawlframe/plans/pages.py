"""From fetched pages to the tables of the crawl store and to new frontier rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe import schema
from crawlframe.functions.content import content_hash, default_status
from crawlframe.functions.html import extract_images, extract_links
from crawlframe.functions.place import place, place_high, place_low
from crawlframe.functions.urls import canonicalize_url, resolve_link, url_domain
from crawlframe.operators import filters
from crawlframe.operators.dedup import dedup_by_url, firsts_by_hash
from crawlframe.operators.ids import assign_ids
from crawlframe.operators.store import attach_site, first_parent_links, links_not_seen, links_not_stored
from crawlframe.session import checkpointed
from crawlframe.sources.keyed import KeyedView
from crawlframe.sources.store import conform, store_index, stored_before, write_images, write_links, write_page_data, write_pages, write_rows


def page_rows(fetches: DataFrame, urls: KeyedView | None = None, contents: KeyedView | None = None) -> DataFrame:
    """Narrow page rows of a set of fetches: everything of a page but its text and id.

    Skipped fetches store nothing; of a URL only the first fetch counts. The text enters as its
    hash alone, so neither step by URL nor by content moves page texts. Stored ``urls`` give no row, and
    one of the stored ``contents`` is a repeat; both stay where they are.
    """
    routed = filters.route_fetches(fetches).where(F.col("route") != "skip").withColumns({
        "url": canonicalize_url(F.col("url")),
        "parent_url": canonicalize_url(F.col("parent_url")),
        "http_status_code": default_status(F.col("status")),
    })
    narrow = routed.select(
        "seq", "url", "parent_url", "route", "data_type_code", "http_status_code", "accessed_s",
        F.when(F.col("route") == "website", content_hash(F.col("html"))).alias("_hash"),
    )
    visits = dedup_by_url(narrow)
    if urls is not None:
        visits = urls.without(visits)
    firsts = firsts_by_hash(visits.select("seq", "accessed_s", "_hash"), "seq", "accessed_s")
    if contents is not None:
        firsts = contents.without(firsts, ["_hash"])
    firsts = firsts.select("seq", F.lit(True).alias("_kept"))
    kept = F.col("_kept").isNotNull()
    kind = (
        F.when(F.col("route") == "document", F.lit("BINARY"))
        .when(kept | F.col("_hash").isNull(), F.lit("HTML"))
        .otherwise(F.lit("DUPLICATE"))
    )
    return visits.join(firsts, "seq", "left").select(
        "seq", "url", "parent_url", url_domain(F.col("url")).alias("domain"), kind.alias("page_type_code"),
        "data_type_code", "http_status_code", F.timestamp_seconds("accessed_s").alias("accessed_time"),
        F.when(kept, F.col("_hash")).alias("html_hash"),
    )


def page_table(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """Narrow page rows with site ids and page ids. Reads ``rows`` several times: pass a stored table."""
    return assign_ids(attach_site(rows, sites), "url")


def with_html(pages: DataFrame, fetches: DataFrame) -> DataFrame:
    """Add the page text where it is kept: the one step that moves texts, on an unskewed key."""
    texts = fetches.select("seq", F.col("html").alias("html_content"))
    kept = pages.where(F.col("page_type_code") == "HTML").join(texts, "seq", "left")
    others = pages.where(F.col("page_type_code") != "HTML").withColumn("html_content", F.lit(None).cast("string"))
    return kept.unionByName(others)


def store_pages(fetches: DataFrame, sites: DataFrame, path: str, batch_id: int | None = None) -> DataFrame:
    """Write the page rows of a set of fetches; returns them without their texts.

    The narrow rows are checkpointed before sites and ids are attached and again after, so each
    step runs once and the texts are hashed once.
    """
    table = checkpointed(page_table(checkpointed(page_rows(fetches)), sites))
    write_pages(with_html(table, fetches), path, batch_id)
    return table


def batch_links(table: DataFrame, urls: KeyedView) -> DataFrame:
    """Edges (from_page, to_page) of the first visits in a batch; parents are pages stored before or earlier in the batch."""
    children = table.where(F.col("parent_url").isNotNull()).select("parent_url", F.col("id").alias("to_page"))
    old = urls.lookup(children, "parent_url", "id", "from_page").where(F.col("from_page").isNotNull())
    return old.select("from_page", "to_page").unionByName(first_parent_links(table))


def store_batch(
    fetches: DataFrame, root: str, batch_id: int, sites: DataFrame | None = None, resources: DataFrame | None = None
) -> DataFrame:
    """Store a batch of fetches beside what earlier batches stored: sites, pages, documents, images, links below ``root``.

    Stored URLs are not stored again, stored contents are repeats, hosts keep their site, parents are
    looked up among stored and new pages, and new ids follow the stored ones. All of this is looked up in
    keyed tables (``root/index``) that stay where they are: what moves is the batch. ``sites`` are rows
    known at the start; the first batch writes them with its own. ``resources`` (url, content_type, content,
    accessed_s) are fetched images, see :func:`batch_images`. Everything depends on earlier batches
    and the arguments alone: a batch that is repeated replaces its own rows by the same ones. Returns
    the page rows without texts.
    """
    spark = fetches.sparkSession
    index = store_index(spark, root)
    urls, contents, hosts = (index[name].before(batch_id) for name in ("url", "content", "site"))
    last = {r["name"]: r["id"] for r in index["last"].before(batch_id).all().collect()}
    given = conform(sites if sites is not None and batch_id == 0 else spark.createDataFrame([], schema.SITE), schema.SITE)
    rows = checkpointed(page_rows(fetches, urls, contents))

    domains = checkpointed(rows.select("domain").distinct())
    known = checkpointed(hosts.matching(domains).unionByName(given.select("domain", "id")))
    top = max(last.get("site", 0), given.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0])
    fresh = checkpointed(assign_ids(domains.join(known, "domain", "left_anti"), "domain", start=top + 1).select("domain", "id"))
    write_rows(given.unionByName(conform(fresh, schema.SITE)), f"{root}/site", batch_id)
    every = known.unionByName(fresh).withColumnRenamed("id", "site_id")

    table = checkpointed(assign_ids(rows.join(every, "domain", "left"), "url", start=last.get("page", 0) + 1))
    write_pages(with_html(table, fetches), f"{root}/page", batch_id)
    write_links(batch_links(table, urls), f"{root}/link", batch_id)
    write_page_data(batch_documents(table, fetches, last.get("page_data", 0) + 1), f"{root}/page_data", batch_id)
    write_images(batch_images(table, fetches, resources), f"{root}/image", batch_id, last.get("image", 0) + 1)

    index["url"].add(table.select("url", "id"), batch_id)
    index["content"].add(table.where(F.col("html_hash").isNotNull()).select("html_hash"), batch_id)
    index["site"].add(given.select("domain", "id").unionByName(fresh), batch_id)
    count = table.agg(F.count("*"), F.count(F.when(F.col("page_type_code") == "BINARY", 1))).first()
    images = stored_before(spark, f"{root}/image", schema.IMAGE, batch_id + 1, batch_id).count()
    ids = {"page": last.get("page", 0) + count[0], "page_data": last.get("page_data", 0) + count[1], "image": last.get("image", 0) + images, "site": top + fresh.count()}
    index["last"].add(spark.createDataFrame(list(ids.items()), "name string, id long"), batch_id)
    return table


def batch_documents(table: DataFrame, fetches: DataFrame, start: int) -> DataFrame:
    """Document rows (id, page_id, data_type_code, content) of the binary pages of a batch, ids from ``start``."""
    pages = table.where(F.col("page_type_code") == "BINARY").select(F.col("id").alias("page_id"), "data_type_code", "seq")
    numbered = assign_ids(pages, "page_id", start=start)
    return numbered.join(fetches.select("seq", F.col("html").alias("content")), "seq", "left").drop("seq")


def batch_images(table: DataFrame, fetches: DataFrame, resources: DataFrame | None = None) -> DataFrame:
    """(page_id, pos, src, content_type, content, accessed_time) of the images on the stored pages of a batch.

    A ``data:`` URI is its own content, seen when its page was. Another source counts if ``resources`` has its
    canonical URL, fetched at whatever time; of several fetches of a URL the first counts. Page texts stay where
    they are: sources are taken out of them first. Repeated pages have images as well.
    """
    pages = table.where(F.col("page_type_code").isin("HTML", "DUPLICATE")).select("seq", F.col("id").alias("page_id"), "accessed_time")
    found = page_image_sources(fetches.select("seq", canonicalize_url(F.col("url")).alias("url"), "html")).join(pages, "seq")
    is_data = F.lower(F.substring("src", 1, 5)) == "data:"
    own = found.where(is_data).select("page_id", "pos", "src", F.col("src").alias("content_type"), F.col("src").alias("content"), "accessed_time")
    if resources is None:
        return own
    fetched = dedup_by_url(resources.select(canonicalize_url(F.col("url")).alias("url"), "content_type", "content", "accessed_s"), order="accessed_s")
    linked = found.where(~is_data).select("page_id", "pos", "src", resolve_link(F.col("src"), F.col("page_url")).alias("url"))
    linked = linked.join(fetched, "url").select("page_id", "pos", "src", "content_type", "content", F.timestamp_seconds("accessed_s").alias("accessed_time"))
    return own.unionByName(linked)


def page_hrefs(pages: DataFrame, html: str = "html") -> DataFrame:
    """Links of pages as (seq, parent_url, pos, href), empty and non-web ones left out."""
    found = pages.select("seq", F.col("url").alias("parent_url"), F.posexplode(extract_links(F.col(html))).alias("pos", "href"))
    return filters.filter_nonweb_links(filters.filter_empty_refs(found, "href"), "href")


def page_image_sources(pages: DataFrame, html: str = "html") -> DataFrame:
    """Image sources of pages as (seq, page_url, pos, src)."""
    found = pages.select("seq", F.col("url").alias("page_url"), F.posexplode(extract_images(F.col(html))).alias("pos", "src"))
    return filters.filter_image_sources(filters.filter_empty_refs(found, "src"))


def page_links(
    pages: DataFrame,
    include: DataFrame | None = None,
    exclude: DataFrame | None = None,
    registered: Sequence[tuple[str, str]] | None = None,
    suffixes: Sequence[str] | None = None,
    raw_filter: bool = False,
) -> DataFrame:
    """Filtered links (seq, pos, parent_url, url, host) of pages (seq, url, html), the target canonical.

    With ``raw_filter`` the registered-domain filter sees the link as written, which drops
    relative ones; without, the resolved URL.
    """
    links = page_hrefs(pages)
    if registered is not None and raw_filter:
        links = filters.filter_registered_domain(links, "href", registered, suffixes)
    links = links.select("seq", "pos", "parent_url", resolve_link(F.col("href"), F.col("parent_url")).alias("url"))
    if registered is not None and not raw_filter:
        links = filters.filter_registered_domain(links, "url", registered, suffixes)
    links = links.withColumn("host", url_domain(F.col("url")))
    return filters.filter_exclude_hosts(filters.filter_include_hosts(links, include), exclude)


def expand_frontier(pages: DataFrame, stored: DataFrame | KeyedView, queued: DataFrame | KeyedView | None = None, **link_filters) -> DataFrame:
    """New queue rows (host, seq, pos, parent_url, url) from the links of pages (seq, url, html).

    ``link_filters`` go to :func:`page_links`; they come before the shuffle, which brings a URL's
    links together as (URL, place of the link) only. Site menus, repeated on every page, combine
    before it. The parent's URL is looked up at the end, for new links alone.
    """
    links = page_links(pages, **link_filters).select("url", place(F.col("seq"), F.col("pos")).alias("_place"))
    fresh = links_not_stored(links.groupBy("url").agg(F.min("_place").alias("_place")), stored)
    if queued is not None:
        fresh = links_not_seen(fresh, queued)
    found = fresh.select(
        url_domain(F.col("url")).alias("host"), place_high(F.col("_place")).alias("seq"),
        place_low(F.col("_place")).cast("int").alias("pos"), "url",
    )
    parents = pages.select("seq", canonicalize_url(F.col("url")).alias("parent_url"))
    return found.join(parents, "seq").select("host", "seq", "pos", "parent_url", "url")
