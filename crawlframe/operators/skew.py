"""Windows over groups of any size, by one plan at every size.

A window puts a whole group into one task, and adaptive execution splits only joins. Rows are therefore cut
into ranges of (group, full order) with about the same number of rows each, whatever the groups: a host with
a third of the links fills a third of the ranges, thousands of small hosts share one. A range of a group, a
piece, is one window partition. Of the groups in a range only the first can have rows before it, so what
earlier pieces carry into later ones (a count, a maximum) is at most one row for each range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from crawlframe.session import checkpointed

PIECE = "_piece"


def cut_in_pieces(df: DataFrame, key: str, order: Sequence[str], pieces: int | None = None) -> DataFrame:
    """Add ``_piece``, the number of the row's range of (key, order).

    There are ``pieces`` ranges, as many as the session's shuffles have partitions if not given. ``order``
    must tell the rows of a group apart, else rows alike share a piece. The result is checkpointed: range
    bounds come from a sample, which a second evaluation could draw differently.
    """
    n = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, key, *order)
    return checkpointed(ranged.withColumn(PIECE, F.spark_partition_id()))


def piece_window(key: str, *order: str | Column) -> WindowSpec:
    return Window.partitionBy(key, PIECE).orderBy(*order)


def earlier_pieces(key: str) -> WindowSpec:
    """Over a row per piece: the pieces of the group before the current one."""
    return Window.partitionBy(key).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)


def with_carried(rows: DataFrame, key: str, carried: DataFrame) -> DataFrame:
    """Rows with the columns of ``carried`` (key, _piece, ...), NULL where nothing is carried.

    ``carried`` has the pieces that others of their group come before: one for each range at most, which
    bounds what is broadcast by the number of ranges.
    """
    known = carried.withColumnsRenamed({key: "_of", PIECE: "_in"})
    same = (rows[PIECE] == known["_in"]) & rows[key].eqNullSafe(known["_of"])
    return rows.join(F.broadcast(known), same, "left").drop("_of", "_in")


def rank_in_group(df: DataFrame, key: str, order: str, alias: str, ties: Sequence[str] = (), pieces: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group by ``order``, then ``ties``."""
    cut = cut_in_pieces(df, key, [order, *ties], pieces)
    ranked = cut.withColumn("_rank", F.row_number().over(piece_window(key, order, *ties)))
    counts = cut.groupBy(key, PIECE).agg(F.count("*").alias("_n"))
    before = counts.select(key, PIECE, F.sum("_n").over(earlier_pieces(key)).alias("_before")).where(F.col("_before").isNotNull())
    position = F.col("_rank") + F.coalesce(F.col("_before"), F.lit(0))
    return with_carried(ranked, key, before).select(*df.columns, position.cast("long").alias(alias))
