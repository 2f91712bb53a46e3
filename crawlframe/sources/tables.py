"""Scans, seeds and code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe import schema
from crawlframe.functions.robots import sitemap_locations
from crawlframe.functions.urls import url_domain
from crawlframe.operators.filters import sites_with_sitemap


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan_sites(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.SITE).parquet(path)


def scan_pages(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Page table; only the named columns are read."""
    return spark.read.schema(schema.PAGE).parquet(path).select(*(columns or schema.PAGE.names))


def code_tables(spark: SparkSession) -> DataFrame:
    """Both code lists as (code_table, code)."""
    rows = [("data_type", c) for c in schema.DATA_TYPE_CODES] + [("page_type", c) for c in schema.PAGE_TYPE_CODES]
    return spark.createDataFrame(rows, "code_table string, code string")


def host_list(spark: SparkSession, hosts: Sequence[str]) -> DataFrame:
    """(domain): host keys of host names or URLs, for include, exclude and seed lists."""
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    return rows.select(url_domain(F.col("host")).alias("domain")).distinct()


def seed_table(sites: DataFrame) -> DataFrame:
    """Start set (parent_url, url): every site's domain and its sitemap's locations, repeats kept."""
    domains = sites.select(F.col("domain").alias("url"))
    locations = sites_with_sitemap(sites).select(F.explode(sitemap_locations(F.col("sitemap_content"))).alias("url"))
    return domains.unionByName(locations).select(F.lit(None).cast("string").alias("parent_url"), "url")


def bootstrap_source(frontier: DataFrame, sites: DataFrame) -> DataFrame:
    """The stored frontier if it has rows, else the seeds."""
    is_empty = frontier.limit(1).agg(F.count("*") == 0).scalar()
    return frontier.select("parent_url", "url").unionByName(seed_table(sites).where(is_empty))


def concat_sitemaps(bodies: DataFrame) -> DataFrame:
    """(domain, sitemap_content): the bodies of a host's sitemaps joined in listed order.

    ``bodies`` has (domain, pos, body), one row per sitemap line of the host's robots text; the
    result of a host is one cell by definition.
    """
    ordered = F.array_sort(F.collect_list(F.struct("pos", "body")))
    return bodies.groupBy("domain").agg(F.array_join(F.transform(ordered, lambda s: s["body"]), "").alias("sitemap_content"))
