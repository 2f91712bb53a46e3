"""Removal of repeats on streams.

What a stream knows is a keyed table (:mod:`crawlframe.sources.keyed`), one row per key. A batch folds its
copies by an aggregate, which combines before the shuffle, and only then meets the table, so a key with very
many copies is one row there and in every join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crawlframe.functions.urls import canonicalize_url
from crawlframe.operators.dedup import content_firsts, dedup_by_content, dedup_by_url
from crawlframe.session import checkpointed
from crawlframe.sources.keyed import KeyedTable
from crawlframe.streaming.batches import run_batches, write_batch

_URL = T.StructType([T.StructField("url", T.StringType())])
_FIRSTS = T.StructType([T.StructField("html_hash", T.StringType()), T.StructField("seq", T.LongType())])


def known_urls(stream: DataFrame, root: str) -> KeyedTable:
    return KeyedTable(stream.sparkSession, f"{root}/state", _URL, ["url"])


def start_dedup_urls(stream: DataFrame, root: str, order: str | None = None) -> StreamingQuery:
    """Each canonical URL (column ``url``) once, ever, into ``root/urls``: its first row by ``order``, any of the first batch without.

    The state, ``root/state``, has one row per URL, however many copies arrive. Rows without a URL are dropped.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col("url").isNotNull()).withColumn("url", canonicalize_url(F.col("url")))
        rest = [c for c in rows.columns if c != "url"]
        if order is not None:
            folded = dedup_by_url(rows, order=order)
        elif rest:
            folded = rows.groupBy("url").agg(F.first(F.struct(*rest)).alias("_row")).select("url", "_row.*").select(*rows.columns)
        else:
            folded = rows.distinct()
        table = known_urls(batch, root)
        fresh = checkpointed(table.before(batch_id).without(folded))
        write_batch(fresh, f"{root}/urls", batch_id)
        table.add(fresh.select("url"), batch_id)

    return run_batches(stream, root, handle)


def start_dedup_content(stream: DataFrame, root: str) -> StreamingQuery:
    """Label arriving pages (seq, accessed_s, html, ...) against all earlier ones, into ``root/pages``.

    ``root/hashes`` keeps the first page of each content, one row per content.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, f"{root}/hashes", _FIRSTS, ["html_hash"], fold=F.min)
        fresh = checkpointed(table.before(batch_id).without(content_firsts(batch)))
        write_batch(dedup_by_content(batch, firsts=fresh), f"{root}/pages", batch_id)
        table.add(fresh, batch_id)

    return run_batches(stream, root, handle)
