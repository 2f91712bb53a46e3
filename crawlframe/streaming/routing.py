"""Sending the results of a stream of fetches to their handlers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlframe.operators.filters import route_fetches
from crawlframe.streaming.batches import run_batches

Handler = Callable[[DataFrame, int], None]


def start_route_results(stream: DataFrame, root: str, handlers: Mapping[str, Handler]) -> StreamingQuery:
    """Call ``handlers[route](rows, batch_id)`` with each batch's rows of that route.

    Handlers must be repeatable for the same ``batch_id``; routes without a handler are dropped.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = route_fetches(batch).persist()
        try:
            for route, handler in handlers.items():
                handler(routed.where(F.col("route") == route), batch_id)
        finally:
            routed.unpersist()

    return run_batches(stream, root, handle)
