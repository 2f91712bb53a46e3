"""Merkle manifest of a table: a tree over its rows per group, a root over the groups, a proof for every row.

Rows of a group are numbered in order; node ``p`` of level ``j`` covers the rows from ``p * 2^j`` on. Its
digest stands on the first of them. In a window over an aligned block of ``2^LEVELS`` rows the sibling of a
node is then ``2^j`` rows ahead of it or behind it: a lead or a lag by a fixed offset, masked by the node's
slot (left or right) and by the length of the run, so that the last node of an odd run has none. Left nodes
hash the parents. The sibling that a row needs at level ``j`` is the last one that stands at or before it.

A block is one window partition, whatever the group's size: a group with most of the rows has many blocks.
Tops of blocks are the rows of the next round, ``2^LEVELS`` times fewer, until each group has one node. The
tree over the groups is made the same way. Digests are kept as 32 bytes and hashed as hexadecimal text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.common import stored

#: Levels of a tree that one window partition holds: 256 rows.
LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def encoded(value: Column) -> Column:
    """``-`` for null, else the size in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[encoded(v) for v in values]))


def _numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Add ``pos`` (from 0) in each group ``g`` and its number of rows ``n``; also the largest ``n``.

    Rows go to ranges of (group, order), so that a large group lies in many; their places follow from the
    counts of the ranges before. Equal rows may lie in several ranges: their order makes no difference.
    """
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange("g", *[F.col(c).asc_nulls_first() for c in order], "spread").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("g", "part").agg(F.count("*").alias("here"))
    counts = counts.select("g", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"), F.sum("here").over(Window.partitionBy("g")).alias("n"))
    counts = stored(counts, "counts")
    place = F.row_number().over(Window.partitionBy("g", "part").orderBy(*[F.col(c).asc_nulls_first() for c in order], "spread"))
    numbered = ranged.withColumn("place", place).join(counts, ["g", "part"])
    largest = counts.agg(F.max("n")).first()[0] or 0
    return numbered.select(*rows.columns, (F.col("before") + F.col("place") - 1).alias("pos"), "n"), largest


def _climbed(nodes: DataFrame) -> DataFrame:
    """Add ``path``, the siblings of each node up to the top of its block, and ``top`` on the block's first row.

    ``nodes`` has ``g, pos, n, h``. A step of a path is (sibling or null, whether the node is the left one).
    """
    block = Window.partitionBy("g", F.shiftright("pos", LEVELS)).orderBy("pos")
    rows = nodes.withColumn("h0", F.col("h"))
    for j in range(LEVELS):
        step, own = 1 << j, F.col(f"h{j}")
        carries, left = F.col("pos") % step == 0, F.shiftright("pos", j) % 2 == 0
        # Nodes are hashed while their group has several on a level.
        active = F.col("n") > step
        ahead = F.when(F.col("pos") + step < F.col("n"), F.lead(own, step).over(block))
        behind = F.lag(own, step).over(block)
        rows = rows.withColumns({"ahead": ahead, "behind": behind})
        sibling = F.struct(F.when(left, F.col("ahead")).otherwise(F.col("behind")).alias("sibling"), left.alias("left"))
        parent = digest(F.concat(hex_text(own), F.coalesce(hex_text(F.col("ahead")), F.lit(""))))
        rows = rows.withColumns({
            f"s{j}": F.when(carries & active, sibling),
            f"h{j + 1}": F.when(carries & left, F.when(active, parent).otherwise(own)),
        })
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.array_compact(F.array(*[F.last(f"s{j}", ignorenulls=True).over(so_far) for j in range(LEVELS)]))
    return rows.select(*nodes.columns, path.alias("path"), F.col(f"h{LEVELS}").alias("top"))


def tree(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` (``g``, a digest ``h``, more) with ``path`` to the root of their group, and the roots ``(g, root)``.

    ``g`` must not be null. ``order`` should tell rows of a group apart; equal ones stand in any order.
    """
    nodes, size = _numbered(rows, order)
    rounds = [stored(_climbed(nodes), "nodes")]
    # A group of one block has its root early and goes through the later rounds as a single node.
    while size > 1 << LEVELS:
        size = -(-size >> LEVELS)
        count = F.shiftright(F.col("n") + ((1 << LEVELS) - 1), LEVELS)
        tops = rounds[-1].filter("top is not null").select("g", F.shiftright("pos", LEVELS).alias("pos"), count.alias("n"), F.col("top").alias("h"))
        rounds.append(stored(_climbed(tops), "nodes"))
    roots = rounds[-1].filter("pos = 0").select("g", F.col("top").alias("root"))
    found = rounds.pop()
    while rounds:
        above = found.select("g", F.col("pos").alias("up"), F.col("path").alias("rest"))
        joined = rounds.pop().withColumn("up", F.shiftright("pos", LEVELS)).join(above, ["g", "up"])
        found = joined.withColumn("path", F.concat("path", "rest")).drop("up", "rest")
    return found.select(*rows.columns, "path"), roots


def proof_digest(*paths: Column) -> Column:
    """Hexadecimal digest of the siblings along the paths."""
    siblings = F.transform(F.filter(F.concat(*paths), lambda s: s["sibling"].isNotNull()), lambda s: hex_text(s["sibling"]))
    return F.sha2(F.array_join(siblings, ""), 256)


def folded(leaf: Column, *paths: Column) -> Column:
    """Digest at the end of the paths for a row digest at their beginning."""

    def up(own: Column, step: Column) -> Column:
        sibling, own = F.coalesce(hex_text(step["sibling"]), F.lit("")), hex_text(own)
        return digest(F.when(step["left"], F.concat(own, sibling)).otherwise(F.concat(sibling, own)))

    return F.aggregate(F.concat(*paths), leaf, up)


def manifest(docs: DataFrame, changed: Column | None = None, add: int = 1) -> DataFrame:
    """``doc_id, lang, leaf, altered, path, subroot, group_path, root``, a row for each row of ``docs``; digests as bytes.

    Rows are leaves in order of doc_id within their lang, null first, rows of one doc_id in order of their
    digest; langs stand in byte order, null first. ``altered`` is the digest with ``add`` added to n_chars
    where ``changed`` holds and n_chars is known, elsewhere the leaf. Repeated rows are leaves each. An empty
    table gives no rows. Only the columns of ``FIELDS`` are read, nulls in any of them count as such.
    """
    values = [F.col(c) for c in FIELDS]
    leaf = row_digest(values)
    more = [(v.cast("decimal(20,0)") + add) if c == "n_chars" else v for c, v in zip(FIELDS, values, strict=True)]
    where = F.lit(False) if changed is None else F.coalesce(changed, F.lit(False)) & F.col("n_chars").isNotNull()
    # Texts are read and hashed here; what moves is narrow.
    rows = docs.select(encoded(F.col("lang")).alias("g"), "lang", "doc_id", leaf.alias("h"), F.when(where, row_digest(more)).alias("altered"))
    leaves, subroots = tree(rows, ["doc_id", "h"])
    name = F.when(F.col("g") != "-", F.expr("substring(g, instr(g, ':') + 1)"))
    groups = stored(subroots.select(F.lit("").alias("g"), F.col("g").alias("own"), name.alias("name"), F.col("root").alias("h")), "groups")
    paths, root = tree(groups, ["name"])
    # Stored, so that its size is known when the join is planned.
    top = stored(paths.join(root, "g").select(F.col("own").alias("g"), F.col("h").alias("subroot"), F.col("path").alias("group_path"), "root"), "top")
    return leaves.join(top, "g").select(
        "doc_id", "lang", F.col("h").alias("leaf"), F.coalesce("altered", "h").alias("altered"), "path", "subroot", "group_path", "root"
    )
