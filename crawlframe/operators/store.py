"""Joins between new rows and the crawl store, and checks of its keys.

No join here is hinted: Spark broadcasts a side whose size it has measured as small, otherwise
it shuffles, and adaptive execution splits hot hosts and hub pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.robots import index_allows, robots_rules, rules_index
from crawlframe.operators.ids import assign_ids
from crawlframe.sources.keyed import KeyedView


def links_not_stored(links: DataFrame, pages: DataFrame | KeyedView) -> DataFrame:
    """Links whose URL is not stored. URLs in a keyed table are met where they lie, without a shuffle of them."""
    if isinstance(pages, KeyedView):
        return pages.without(links, ["url"])
    return links.join(pages.select("url"), "url", "left_anti")


def links_not_seen(links: DataFrame, seen: DataFrame | KeyedView) -> DataFrame:
    return links_not_stored(links, seen)


def new_sites(domains: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows for hosts that have no site yet, numbered after the last site."""
    missing = domains.select("domain").distinct().join(sites.select("domain"), "domain", "left_anti")
    start = sites.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).scalar()
    return assign_ids(missing, "domain", start=start)


def attach_site(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Add ``site_id`` by host key; hosts without a site get a new one."""
    known = sites.select(F.col("id").cast("long").alias("id"), "domain")
    all_sites = known.unionByName(new_sites(pages, known))
    return pages.join(all_sites.select("domain", F.col("id").alias("site_id")), "domain", "left")


def first_parent_links(visits: DataFrame) -> DataFrame:
    """Edges (from_page, to_page) of first visits.

    ``visits`` has (id, url, parent_url, seq) with one row per URL, the first visit. There is no
    edge if the parent was not yet stored when the page was visited.
    """
    parents = visits.select(F.col("url").alias("parent_url"), F.col("id").alias("from_page"), F.col("seq").alias("_at"))
    return (
        visits.select("parent_url", F.col("id").alias("to_page"), "seq")
        .join(parents, "parent_url")
        .where(F.col("_at") < F.col("seq"))
        .select("from_page", "to_page")
    )


def new_links_only(edges: DataFrame, stored: DataFrame) -> DataFrame:
    return edges.join(stored.select("from_page", "to_page"), ["from_page", "to_page"], "left_anti")


def robots_match(urls: DataFrame, sites: DataFrame, url: str = "url", domain: str = "domain") -> DataFrame:
    """Add ``allowed``: what the rules of the URL's host say for any agent.

    The rules of a host are one look-up table on its site row, so a URL meets exactly one row and looks up
    its own prefixes of the lengths that occur: no prefix join, no grouping, and no walk over the rules.
    """
    # A text without an agent line has no rules; its host needs no row in the join.
    ruled = sites.where(F.col("robots_content").rlike("(?i)user-agent"))
    rules = ruled.select(F.col("domain").alias(domain), rules_index(robots_rules(F.col("robots_content"))).alias("_rules"))
    return urls.join(rules, domain, "left").select(
        *[F.col(c) for c in urls.columns], F.coalesce(index_allows(F.col("_rules"), F.col(url)), F.lit(True)).alias("allowed")
    )


def robots_allowed(urls: DataFrame, sites: DataFrame, url: str = "url", domain: str = "domain") -> DataFrame:
    return robots_match(urls, sites, url, domain).where("allowed").drop("allowed")


def missing_seed_sites(seeds: DataFrame, sites: DataFrame) -> DataFrame:
    return seeds.select("domain").join(sites.select("domain"), "domain", "left_anti")


def full_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """All distinct (from_page, to_page) pairs whose two URLs are stored."""
    index = pages.select("id", "url")
    sources = index.select(F.col("id").alias("from_page"), F.col("url").alias("parent_url"))
    targets = index.select(F.col("id").alias("to_page"), "url")
    return (
        links.select("parent_url", "url")
        .distinct()
        .join(targets, "url")
        .join(sources, "parent_url")
        .select("from_page", "to_page")
        .distinct()
    )


def resolve_host_redirects(hosts: DataFrame) -> DataFrame:
    """Robots text of each host, following redirects of hosts whose text is empty.

    ``hosts`` has (domain, robots_content, status, location), location being a host key. At most
    three hosts are tried; a text that is not empty, a status other than 3xx or a host already
    visited ends the walk. Result: (domain, final_domain, tries, robots_content).
    """
    text = F.coalesce(F.col("robots_content"), F.lit(""))
    moved = (text == "") & (F.floor(F.col("status") / 100) % 10 == 3) & F.col("location").isNotNull()
    step = hosts.select("domain", text.alias("text"), F.when(moved, F.col("location")).alias("next"))

    def hop(i: int) -> DataFrame:
        return step.select(*[F.col(c).alias(f"{c}{i}") for c in step.columns])

    h1, h2, h3 = hop(1), hop(2), hop(3)
    second = F.when(F.col("next1") != F.col("domain1"), F.col("next1"))
    third = F.when(~F.col("next2").isin(F.col("domain1"), F.col("domain2")), F.col("next2"))

    def key(go: str) -> Column:
        # Hosts that go nowhere get keys of their own: as NULLs they would all meet in one task.
        return F.coalesce(F.col(go), F.concat(F.lit("-"), F.col("domain1")))

    walked = (
        h1.withColumn("go2", second)
        .join(h2, key("go2") == F.col("domain2"), "left")
        .withColumn("go3", third)
        .join(h3, key("go3") == F.col("domain3"), "left")
    )
    tries = F.when(F.col("go3").isNotNull(), F.lit(3)).when(F.col("go2").isNotNull(), F.lit(2)).otherwise(F.lit(1))
    return walked.select(
        F.col("domain1").alias("domain"),
        F.coalesce(F.col("go3"), F.col("go2"), F.col("domain1")).alias("final_domain"),
        tries.alias("tries"),
        F.when(tries == 3, F.col("text3")).when(tries == 2, F.col("text2")).otherwise(F.col("text1")).alias("_text"),
    ).select("domain", "final_domain", "tries", F.coalesce(F.col("_text"), F.lit("")).alias("robots_content"))


def lookup_first(df: DataFrame, key: str, value, order: str) -> DataFrame:
    """First row with the key, by ``order``."""
    return df.where(F.col(key) == value).orderBy(order).limit(1)


def _by_table(checks: Sequence[tuple], table: int) -> list[list[tuple]]:
    """Checks grouped by the DataFrame they read, so that each table is read once."""
    grouped: dict[int, list[tuple]] = {}
    for check in checks:
        grouped.setdefault(id(check[table]), []).append(check)
    return list(grouped.values())


def _named_keys(df: DataFrame, keys: Sequence[tuple[str, Column]]) -> DataFrame:
    """(constraint_name, key) for each row and each named key that is not NULL."""
    pairs = F.array(*[F.struct(F.lit(name).alias("constraint_name"), key.alias("key")) for name, key in keys])
    return df.select(F.inline(pairs)).where(F.col("key").isNotNull())


def fk_violations(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Keys that refer to no row: (constraint_name, key, n_rows) for all given checks.

    A check is (name, rows, foreign key, referred rows, key). Every table is read once and all
    checks share one aggregate and one join. Keys are counted before the join, so a key that many
    rows share is one row in it.
    """
    used = reduce(DataFrame.unionByName, [
        _named_keys(group[0][1], [(name, F.col(fk).cast("string")) for name, _, fk, _, _ in group]) for group in _by_table(checks, 1)
    ])
    known = reduce(DataFrame.unionByName, [
        _named_keys(group[0][3], [(name, F.col(key).cast("string")) for name, _, _, _, key in group]) for group in _by_table(checks, 3)
    ])
    counted = used.groupBy("constraint_name", "key").agg(F.count("*").alias("n_rows"))
    return counted.join(known, ["constraint_name", "key"], "left_anti")


def unique_violations(checks: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Keys that occur more than once: (constraint_name, key, n_rows). A check is (name, rows, key columns).

    Every table is read once; rows with a NULL in a key are left out.
    """

    def key_text(keys: Sequence[str]) -> Column:
        texts = [F.col(k).cast("string") for k in keys]
        if len(texts) == 1:
            return texts[0]
        # A comma inside a part is escaped, so that different keys never read the same.
        parts = [F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,")) for t in texts]
        return F.concat(parts[0], *[t for k in parts[1:] for t in (F.lit(","), k)])

    named = reduce(DataFrame.unionByName, [
        _named_keys(group[0][1], [(name, key_text(keys)) for name, _, keys in group]) for group in _by_table(checks, 1)
    ])
    return named.groupBy("constraint_name", "key").agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
