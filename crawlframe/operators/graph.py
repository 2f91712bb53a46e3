"""The link table as a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def graph_edges(links: DataFrame) -> DataFrame:
    return links.select("from_page", "to_page")


def graph_undirected(links: DataFrame) -> DataFrame:
    """Each pair once, lower page first; self-loops stay."""
    return links.select(
        F.least("from_page", "to_page").alias("page_a"), F.greatest("from_page", "to_page").alias("page_b")
    ).distinct()


def graph_nodes(links: DataFrame) -> DataFrame:
    """Distinct source pages in ascending order."""
    return links.select("from_page").distinct().orderBy("from_page")


def graph_all_nodes(links: DataFrame) -> DataFrame:
    """Distinct pages at either end of an edge, from one scan of the links."""
    return links.select(F.explode(F.array("from_page", "to_page")).alias("page")).distinct()
