"""Filters on links, images, fetches and sites."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.content import IMAGE_EXTENSIONS, extension_datatype, extension_route, fetch_extension
from crawlframe.functions.content import default_status as status_or_default
from crawlframe.functions.domains import host_name, registered_domain
from crawlframe.schema import REGISTERED_DOMAINS

# Link schemes that lead to no page, wherever they stand in the link.
NONWEB_SCHEMES = ["mailto:", "callto:", "sms:", "tel:"]
# Fixed value: registered domain whose images are left out.
IMAGE_EXCLUDED_DOMAIN = "cms"


def filter_include_hosts(links: DataFrame, hosts: DataFrame | None, host: str = "host") -> DataFrame:
    """Links whose host key is listed in ``hosts.domain``; no list keeps all.

    The list is joined without a hint: it is broadcast only if its measured size allows.
    """
    if hosts is None:
        return links
    return links.join(hosts.select(F.col("domain").alias(host)), host, "left_semi")


def filter_exclude_hosts(links: DataFrame, hosts: DataFrame | None, host: str = "host") -> DataFrame:
    """Links whose host key is not listed: exact hosts, no subdomains."""
    if hosts is None:
        return links
    return links.join(hosts.select(F.col("domain").alias(host)), host, "left_anti")


def filter_registered_domain(
    df: DataFrame,
    url: str,
    allowed: Sequence[tuple[str, str]] = REGISTERED_DOMAINS,
    suffixes: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose URL lies under one of the allowed (domain, suffix) pairs.

    Apply it to resolved URLs; on raw hrefs it drops every relative link.
    """
    names = [f"{domain}.{suffix}" for domain, suffix in allowed]
    host = host_name(F.col(url))
    # A host can only belong to a name it ends in: this cheap test spares most hosts the full one.
    ends = reduce(or_, [(host == name) | host.endswith(f".{name}") for name in names], F.lit(False))
    parts = registered_domain(host, suffixes)
    return df.where(ends & F.concat_ws(".", parts["domain"], parts["suffix"]).isin(names))


def filter_nonweb_links(df: DataFrame, href: str = "href") -> DataFrame:
    return df.where(~F.col(href).rlike("|".join(NONWEB_SCHEMES)))


def filter_empty_refs(df: DataFrame, ref: str) -> DataFrame:
    return df.where(F.col(ref).isNotNull() & (F.col(ref) != ""))


def route_fetches(fetches: DataFrame) -> DataFrame:
    """Add extension, data type and route of each fetch."""
    typed = fetches.withColumn("extension", fetch_extension(F.col("content_type"), F.col("url")))
    return typed.withColumns({
        "data_type_code": extension_datatype(F.col("extension")),
        "route": extension_route(F.col("extension")),
    })


def filter_image_types(images: DataFrame, extension: str = "extension") -> DataFrame:
    return images.where(F.col(extension).isin(IMAGE_EXTENSIONS))


def filter_image_sources(images: DataFrame, src: str = "src", suffixes: Sequence[str] | None = None) -> DataFrame:
    """Images that are ``data:`` URIs or lie outside the excluded registered domain."""
    is_data = F.col(src).rlike("(?i)^data:")
    domain = registered_domain(host_name(F.col(src)), suffixes)["domain"]
    return images.where(is_data | (domain != IMAGE_EXCLUDED_DOMAIN))


def ready_hosts(hosts: DataFrame, now_us: int) -> DataFrame:
    """Hosts with a queue whose last fetch lies at least their limit before ``now_us``.

    A host that was never fetched is ready.
    """
    waited = F.lit(now_us) - F.col("last_fetch_us") >= F.col("limit_us")
    return hosts.where((F.col("queued") > 0) & (F.col("last_fetch_us").isNull() | waited))


def filter_duplicates(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page_type_code") == "DUPLICATE")


def sites_with_sitemap(sites: DataFrame) -> DataFrame:
    return filter_empty_refs(sites, "sitemap_content")


def default_status(fetches: DataFrame, status: str = "status") -> DataFrame:
    return fetches.withColumn(status, status_or_default(F.col(status)))
