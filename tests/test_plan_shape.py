"""What plans must and must not contain."""

import re

import pytest

from __spark_entry__ import queries
from crawlframe.plans import derived
from crawlframe.operators.dedup import content_firsts

# Bounded broadcasts: hot-group bounds and summaries, per-bucket id offsets, the nine code rows.
NO_ALL_PAIRS = [
    "robots_match", "attach_site", "first_parent_links", "full_links", "links_not_stored", "filter_include_hosts", "dedup_by_content",
    "politeness_slots", "frontier_positions", "assign_ids", "fk_violations", "resolve_host_redirects", "expand_frontier", "fetch_batch",
]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_ALL_PAIRS)
def test_no_all_pairs_join_and_no_python(spark, sf, name):
    plan = physical(queries()[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search("Python|Arrow|Pandas", plan)


def test_scan_reads_only_the_columns_asked_for(spark, sf):
    for name, columns in {"pages_per_site": "url:string", "scan_pages": "page_id:bigint,url:string", "count_pages": ""}.items():
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", physical(queries()[name](spark, sf)))
        assert set(schemas) == {columns}, name


def test_filters_reach_the_scan(spark, sf):
    plan = physical(derived.pages(spark, sf).where("page_id = 7").select("url"))
    assert "PushedFilters: [IsNotNull(page_id), EqualTo(page_id,7)]" in plan


def test_hashes_are_found_without_moving_texts(spark, sf):
    plan = physical(content_firsts(derived.fetches(spark, sf).select("seq", "html", "accessed_s").repartition(3)))
    last_shuffle = plan.split("Exchange")[1]
    assert "html#" not in last_shuffle.split("\n")[0]


def test_a_level_of_the_crawl_has_one_shuffle(spark, tmp_path):
    """Edges and visited pages stay where they are; only the links to a page come together."""
    from pyspark.sql import types as T

    from crawlframe.plans.crawl import next_level
    from crawlframe.sources.keyed import KeyedTable, read_bucketed, write_bucketed

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = T.LongType()
    edges = spark.range(200).selectExpr("id as src", "id * 7 % 200 as dst")
    write_bucketed(edges, f"{tmp_path}/edges", ["src"], n)
    edges = read_bucketed(spark, f"{tmp_path}/edges", T.StructType([T.StructField("src", ids), T.StructField("dst", ids)]), ["src"], n)
    pages = T.StructType([T.StructField("page", ids), T.StructField("parent", ids), T.StructField("depth", T.IntegerType())])
    visited = KeyedTable(spark, f"{tmp_path}/visited", pages, ["page"])
    for depth in range(3):
        visited.add(spark.range(depth, depth + 1).selectExpr("id + 1 as page", "id as parent", f"{depth} as depth"), depth)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(next_level(edges, visited.before(3), 3))
        assert len(re.findall(r"\bExchange\b", plan)) == 1 and plan.count("SortMergeJoin") == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
