"""The crawl over a known link table, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlframe.functions.urls import canonicalize_url
from crawlframe.operators.store import robots_allowed
from crawlframe.plans.pages import page_links
from crawlframe.session import run_dir
from crawlframe.sources.keyed import KeyedTable, KeyedView, buckets_of, read_bucketed, write_bucketed


def next_level(edges: DataFrame, visited: KeyedView, depth: int) -> DataFrame:
    """(page, parent, depth) of the pages first reached at ``depth``.

    ``edges`` (src, dst) are bucketed by src, the visited pages by page; the last run has the level before.
    Neither moves: the one shuffle brings together the links to a page, after combining them.
    """
    level = visited.frames()[-1].where(F.col("depth") == depth - 1).select(F.col("page").alias("src"))
    found = edges.join(level, "src").groupBy(F.col("dst").alias("page")).agg(F.min("src").alias("parent"))
    return visited.without(found).select("page", "parent", F.lit(depth).alias("depth"))


def crawl_bfs(seeds: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(page, parent, depth) of all pages reached from ``seeds.page`` over ``edges`` (src, dst).

    Filters and robots rules belong on ``edges`` before the call. The parent is the lowest page
    of the level before that links to the page. Edges are bucketed once; every level is written to the
    shared folder, so a lost executor costs at most the level it was working on.
    """
    spark = edges.sparkSession
    root, n = run_dir(spark, "crawl"), buckets_of(spark)
    kind = edges.schema["src"].dataType
    pages = T.StructType([T.StructField("page", kind), T.StructField("parent", kind), T.StructField("depth", T.IntegerType())])
    links = edges.select("src", F.col("dst").cast(kind).alias("dst")).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    write_bucketed(links.repartition(n, "src"), f"{root}/edges", ["src"], n)
    links = read_bucketed(spark, f"{root}/edges", T.StructType([T.StructField("src", kind), T.StructField("dst", kind)]), ["src"], n)

    table = KeyedTable(spark, f"{root}/visited", pages, ["page"], fold=F.min)
    table.add(seeds.select("page").where(F.col("page").isNotNull()).distinct().select("page", F.lit(None).cast(kind).alias("parent"), F.lit(0).alias("depth")), 0)
    visited, depth = table.before(1), 0
    while visited.runs and (max_depth is None or depth < max_depth):
        depth += 1
        table.add(next_level(links, visited, depth), depth)
        before, visited = visited.rows, table.before(depth + 1)
        if visited.rows == before:
            break
    return visited.union()


def crawl_pages(
    seeds: DataFrame, pages: DataFrame, sites: DataFrame | None = None, max_depth: int | None = None, **link_filters
) -> DataFrame:
    """(page, parent, depth), all URLs: the crawl from ``seeds.url`` over stored pages (seq, url, html).

    Links are extracted and filtered as for the frontier (``link_filters``, see
    :func:`crawlframe.plans.pages.page_links`); with ``sites`` links that the robots rules of their
    host deny are left out. Seeds are not filtered.
    """
    links = page_links(pages, **link_filters)
    if sites is not None:
        links = robots_allowed(links, sites, domain="host")
    edges = links.select(canonicalize_url(F.col("parent_url")).alias("src"), F.col("url").alias("dst")).distinct()
    return crawl_bfs(seeds.select(canonicalize_url(F.col("url")).alias("page")), edges, max_depth)
