"""Frontier growth and politeness on streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from crawlframe.operators.frontier import politeness_slots
from crawlframe.plans.pages import expand_frontier
from crawlframe.session import checkpointed
from crawlframe.sources.keyed import KeyedTable
from crawlframe.streaming.batches import keyed_state, run_batches, write_batch

_URL = T.StructType([T.StructField("url", T.StringType())])
# Below any time, and far enough from the least number to take a limit off.
_NEVER = -(1 << 62)


def start_frontier_expand(stream: DataFrame, root: str, stored: DataFrame, **filters) -> StreamingQuery:
    """Append the new links of each batch of pages (seq, url, html) to ``root/frontier``.

    ``stored`` are the URLs known at the start, seeds included; they go into the table of known URLs,
    ``root/known``, before the first batch, and the links of every batch after it, so a batch meets that
    table alone. ``filters`` go to :func:`crawlframe.plans.pages.expand_frontier`.
    """
    table = KeyedTable(stream.sparkSession, f"{root}/known", _URL, ["url"])
    if not table.started():
        table.add(checkpointed(stored.select("url").where(F.col("url").isNotNull()).distinct()), -1)

    def handle(batch: DataFrame, batch_id: int) -> None:
        known = KeyedTable(batch.sparkSession, f"{root}/known", _URL, ["url"])
        found = checkpointed(expand_frontier(batch, known.before(batch_id), **filters))
        write_batch(found, f"{root}/frontier", batch_id)
        known.add(found.select("url"), batch_id)

    return run_batches(stream, root, handle)


def next_slots(arrival_us: np.ndarray, limit_us: int, last_slot_us: int | None) -> np.ndarray:
    """Slots of a host's requests in order: ``slot(n) = max(arrival(n), slot(n-1) + limit)``, in closed form."""
    n = np.arange(1, len(arrival_us) + 1, dtype=np.int64)
    start = np.maximum.accumulate(arrival_us - n * limit_us)
    return n * limit_us + (start if last_slot_us is None else np.maximum(start, last_slot_us))


def stream_politeness(requests: DataFrame, first_fetch_waits: bool = False) -> DataFrame:
    """Add ``slot_us`` to a stream of requests (host, seq, arrival_us, limit_us, ...), in order of arrival within a batch.

    The state of a host is its last slot, kept by key in the state store: a batch reads and writes the
    hosts it has and no others. The requests of one host in one batch meet in one task, so the source's
    batch size bounds the memory; where a host may fill a batch, :func:`start_politeness_batches` cuts it.
    """
    keyed_state(requests.sparkSession)
    names = requests.columns

    def slots(_key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True).sort_values(["arrival_us", "seq"], na_position="first", ignore_index=True)
        arrival = rows["arrival_us"].astype("Int64").to_numpy(np.int64, na_value=_NEVER)
        limits = rows["limit_us"].dropna()
        last = state.get[0] if state.exists else int(arrival[0]) if first_fetch_waits else None
        found = next_slots(arrival, int(limits.iloc[0]) if len(limits) else 0, last)
        state.update((int(found[-1]),))
        slot = pd.Series(found, dtype="Int64").mask(found < _NEVER // 2)
        yield rows[names].assign(slot_us=slot)

    out = T.StructType([*requests.schema.fields, T.StructField("slot_us", T.LongType())])
    return requests.groupBy("host").applyInPandasWithState(slots, out, "last_slot_us long", "append", GroupStateTimeout.NoTimeout)


def start_politeness(stream: DataFrame, root: str, first_fetch_waits: bool = False) -> StreamingQuery:
    """Give each arriving request its slot, into ``root/slots``; the hosts' last slots are the stream's keyed state."""
    return (
        stream_politeness(stream, first_fetch_waits)
        .writeStream.format("parquet")
        .option("path", f"{root}/slots")
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def start_politeness_batches(stream: DataFrame, root: str) -> StreamingQuery:
    """As :func:`start_politeness`, for hosts of any size: each batch is a job that cuts its hosts into pieces.

    The last slot of each host is a row of the keyed table ``root/state``; slots of a host only grow, so its
    last one is the maximum.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        host = next(f for f in batch.schema.fields if f.name == "host")
        state = T.StructType([host, T.StructField("last_slot_us", T.LongType())])
        table = KeyedTable(batch.sparkSession, f"{root}/state", state, ["host"], fold=F.max)
        last = table.before(batch_id).matching(batch.select("host"))
        slots = checkpointed(politeness_slots(batch, last))
        write_batch(slots, f"{root}/slots", batch_id)
        table.add(checkpointed(slots.groupBy("host").agg(F.max("slot_us").alias("last_slot_us"))), batch_id)

    return run_batches(stream, root, handle)
