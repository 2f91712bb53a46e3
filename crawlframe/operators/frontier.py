"""Host queues and politeness times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.operators.filters import ready_hosts
from crawlframe.operators.skew import PIECE, cut_in_pieces, earlier_pieces, piece_window, rank_in_group, with_carried


def frontier_positions(queue: DataFrame, ties: Sequence[str] = (), pieces: int | None = None) -> DataFrame:
    """Add ``position``: first-in-first-out place of each row in its host's queue, by ``seq``, then ``ties``."""
    return rank_in_group(queue, "host", "seq", "position", ties, pieces)


def frontier_heads(queue: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Next row of each host's queue by ``seq``, then ``ties``; an aggregate, so no queue is sorted."""
    rest = [c for c in queue.columns if c != "host"]
    order = F.struct("seq", *ties) if ties else F.col("seq")
    heads = queue.groupBy("host").agg(F.min_by(F.struct(*rest), order).alias("_head"))
    return heads.select("host", *[F.col("_head")[c].alias(c) for c in rest])


def frontier_queue_lengths(queue: DataFrame) -> DataFrame:
    return queue.groupBy("host").agg(F.count("*").alias("queued"))


def distinct_frontier(queue: DataFrame) -> DataFrame:
    return queue.select("host", "parent_url", "url").distinct()


def politeness_slots(
    requests: DataFrame, last_slots: DataFrame | None = None, first_fetch_waits: bool = False, pieces: int | None = None
) -> DataFrame:
    """Add ``slot_us``, the earliest permitted fetch time of each request.

    ``requests`` has (host, seq, arrival_us, limit_us), the limit being one per host. The rule
    ``slot(n) = max(arrival(n), slot(n-1) + limit)`` is taken in closed form, ``n * limit +
    max over k <= n of (arrival(k) - k * limit)``: a running maximum. Requests are cut into pieces in order of
    host, arrival and ``seq``; a piece needs of the host's earlier ones only their row count and maximum.

    ``last_slots`` (host, last_slot_us) continues from earlier requests: a host's last slot goes
    in as its request number 0, which costs no join. With ``first_fetch_waits`` the clock of a
    host without one starts at its first arrival.
    """
    key, order = "host", ["_new", "arrival_us", "seq"]
    rows = requests.withColumn("_new", F.lit(1))
    if last_slots is not None:
        rows = rows.unionByName(
            last_slots.select(key, F.col("last_slot_us").alias("arrival_us"), F.lit(0).alias("_new")), allowMissingColumns=True
        )
    cut = cut_in_pieces(rows, key, order, pieces)
    so_far = piece_window(key, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    limit = F.coalesce("limit_us", F.lit(0))
    numbered = cut.withColumn("_n", F.sum("_new").over(so_far)).withColumn("_v", F.col("arrival_us") - F.col("_n") * limit)
    running = numbered.withColumn("_run", F.max("_v").over(so_far)).withColumn("_open", F.first("arrival_us").over(so_far))

    earlier = earlier_pieces(key)
    carried = (
        numbered.groupBy(key, PIECE)
        .agg(F.sum("_new").alias("_m"), F.max("_v").alias("_vmax"), F.coalesce(F.max("limit_us"), F.lit(0)).alias("_limit"),
             F.min_by("arrival_us", F.struct("_new", "arrival_us")).alias("_start"))
        .withColumn("_before", F.sum("_m").over(earlier))
        .withColumn("_prior", F.max(F.col("_vmax") - F.coalesce("_before", F.lit(0)) * F.col("_limit")).over(earlier))
        .select(key, PIECE, "_before", "_prior", F.first("_start").over(earlier).alias("_opened"))
        .where(F.col("_before").isNotNull())
    )
    running = with_carried(running, key, carried)

    before = F.coalesce("_before", F.lit(0))
    best = F.greatest(F.col("_run") - before * limit, F.col("_prior"))
    if first_fetch_waits:
        # The first row of a host is its last slot, where it has one, else its first arrival.
        best = F.greatest(best, F.coalesce("_opened", "_open"))
    slot = (F.col("_n") + before) * limit + best
    return running.where("_new = 1").select(*[F.col(c) for c in requests.columns], slot.alias("slot_us"))


def fetch_batch(queue: DataFrame, clocks: DataFrame, now_us: int, workers: int = 8) -> DataFrame:
    """One round at ``now_us``: the head of every ready host, oldest hosts first, one per worker.

    ``clocks`` has (host, host_seq, last_fetch_us, limit_us). The hosts are picked first; only their
    queues are then looked through, by a broadcast of at most ``workers`` rows.
    """
    hosts = clocks.join(frontier_queue_lengths(queue), "host")
    chosen = ready_hosts(hosts, now_us).select("host", "host_seq").orderBy("host_seq").limit(workers)
    ties = ["pos"] if "pos" in queue.columns else []
    return frontier_heads(queue.join(F.broadcast(chosen), "host"), ties).orderBy("host_seq")
