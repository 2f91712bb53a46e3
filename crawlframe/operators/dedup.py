"""Removal of repeats by URL and by content.

"First" always follows an explicit order column. Groups are reduced by aggregates, which combine
before the shuffle, so a URL or content with very many copies costs no more than another; rows
are joined back by their own sequence number, which is never skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.content import content_hash
from crawlframe.functions.place import place, place_low


def dedup_by_url(df: DataFrame, url: str = "url", order: str = "seq") -> DataFrame:
    """First row of each URL."""
    rest = [c for c in df.columns if c != url]
    first = df.groupBy(url).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
    return first.select(*[F.col(url) if c == url else F.col("_first")[c].alias(c) for c in df.columns])


def first_parent(links: DataFrame) -> DataFrame:
    """(url, parent_url, seq) of the first discovery of each URL."""
    return dedup_by_url(links.select("url", "parent_url", "seq"))


def first_visit(df: DataFrame, url: str = "url", order: str = "seq") -> DataFrame:
    """Add ``is_first``: whether the row is the first of its URL. ``order`` must be unique."""
    firsts = df.groupBy(url).agg(F.min(order).alias(order)).select(order, F.lit(True).alias("_hit"))
    return df.join(firsts, order, "left").select(
        *[df[c] for c in df.columns], F.coalesce(F.col("_hit"), F.lit(False)).alias("is_first")
    )


def firsts_by_hash(hashed: DataFrame, seq: str, at: str) -> DataFrame:
    """(_hash, seq) of the first row of each content hash; rows without a hash have none."""
    known = hashed.where(F.col("_hash").isNotNull())
    firsts = known.groupBy("_hash").agg(F.min(place(F.col(at), F.col(seq))).alias("_first"))
    return firsts.select("_hash", place_low(F.col("_first")).alias(seq))


def content_firsts(
    pages: DataFrame, html: str = "html", seq: str = "seq", at: str = "accessed_s", known: DataFrame | None = None
) -> DataFrame:
    """(html_hash, seq) of the first page of each content; contents in ``known.html_hash`` have none."""
    # The text is tested, not its hash, which would be computed once more for the test.
    hashed = pages.where(F.col(html).isNotNull()).select(seq, F.col(at).alias("_at"), content_hash(F.col(html)).alias("_hash"))
    firsts = firsts_by_hash(hashed, seq, "_at").withColumnRenamed("_hash", "html_hash")
    return firsts if known is None else firsts.join(known.select("html_hash"), "html_hash", "left_anti")


def dedup_by_content(
    pages: DataFrame, html: str = "html", seq: str = "seq", at: str = "accessed_s", firsts: DataFrame | None = None
) -> DataFrame:
    """Label pages HTML or DUPLICATE; a duplicate loses its text and hash.

    The first pages are found on hashes alone, and every other sequence number is a repeat: two
    passes, one over the texts. The repeats are joined back without a hint: a small set of them is
    broadcast, and the page texts are shuffled only if it is not.
    """
    if firsts is None:
        firsts = content_firsts(pages, html, seq, at)
    repeats = pages.select(seq).join(firsts.select(seq), seq, "left_anti").withColumn("_repeat", F.lit(True))
    kept = F.col("_repeat").isNull() | F.col(html).isNull()
    return pages.join(repeats, seq, "left").select(
        *[F.when(kept, F.col(c)).alias(c) if c == html else F.col(c) for c in pages.columns],
        F.when(kept, F.lit("HTML")).otherwise(F.lit("DUPLICATE")).alias("page_type_code"),
        F.when(kept, content_hash(F.col(html))).alias("html_hash"),
    )


def content_duplicate_groups(df: DataFrame, text: str, order: str) -> DataFrame:
    """Contents that occur more than once: first row, number of rows, size in bytes."""
    return (
        df.groupBy(content_hash(F.col(text)).alias("html_hash"))
        .agg(F.min(order).alias("first"), F.count("*").alias("n_rows"), F.min(F.octet_length(text)).alias("n_bytes"))
        .where(F.col("n_rows") > 1)
    )
