"""Counts, shares and averages over the crawl store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, alias: str) -> DataFrame:
    return df.agg(F.count("*").alias(alias))


def group_counts(df: DataFrame, key: str, alias: str = "n_rows") -> DataFrame:
    """Rows per key; NULL is a key of its own."""
    return df.groupBy(key).agg(F.count("*").alias(alias))


def group_share(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their percentage of all, to one decimal."""
    counts = group_counts(df, key)
    share = F.lit(100.0) * F.col("n_rows") / counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("share", F.bround(share, 1))


def avg_per_group(df: DataFrame, key: str, alias: str) -> DataFrame:
    """Mean number of rows per key to one decimal; NULL if there are no rows."""
    return group_counts(df, key).agg(F.bround(F.try_divide(F.sum("n_rows"), F.count("*")), 1).alias(alias))


def pages_by_host(pages: DataFrame, host: str = "domain") -> DataFrame:
    """(host, n_pages, n_duplicates): what the summary needs of the pages, a row per host."""
    duplicates = F.count_if(F.col("page_type_code") == "DUPLICATE")
    return pages.groupBy(host).agg(F.count("*").alias("n_pages"), duplicates.alias("n_duplicates"))


def crawl_summary(sites: DataFrame, per_host: DataFrame, images: DataFrame, page_data: DataFrame) -> DataFrame:
    """All totals and averages as (metric, value), one aggregate per table; ``per_host`` as :func:`pages_by_host` gives it."""

    def metrics(df: DataFrame, names: list[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
        return df.select(F.inline(pairs))

    page_metrics = per_host.agg(
        F.coalesce(F.sum("n_pages"), F.lit(0)).alias("pages"),
        F.coalesce(F.sum("n_duplicates"), F.lit(0)).alias("duplicates"),
        F.bround(F.try_divide(F.sum("n_pages"), F.count("*")), 1).alias("avg_pages_per_site"),
    )

    def per_page(df: DataFrame, total: str, mean: str) -> DataFrame:
        return group_counts(df, "page_id").agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias(total),
            F.bround(F.try_divide(F.sum("n_rows"), F.count("*")), 1).alias(mean),
        )

    return reduce(DataFrame.unionByName, [
        metrics(count_rows(sites, "sites"), ["sites"]),
        metrics(page_metrics, ["pages", "duplicates", "avg_pages_per_site"]),
        metrics(per_page(images, "images", "avg_images_per_page"), ["images", "avg_images_per_page"]),
        metrics(per_page(page_data, "documents", "avg_documents_per_page"), ["documents", "avg_documents_per_page"]),
    ])
