"""Nearest neighbours by inner product: multi-index hashing over learned rotated binary codes.

Rows are parted into classes of like length: the shortest of a class has ``RATIO`` of the length of the
longest at least. Within a class, vectors get one more component so that all are as long as the longest
of the class; the nearest by angle are then those with the largest inner product. Rotations are learned
on a bounded sample (iterative quantisation: turn the sample so that its signs lose least), several from
different starts, and the signs after all of them are a vector's code. A code is cut into substrings of
16 bits, each with an index of its own.

A query goes through the classes from the longest rows to the shortest and keeps its k best so far. No
inner product is over the product of lengths, so it stops at the first class whose longest row cannot
reach the k-th score. In a class it probes, in each index, every value within a radius of its own
substring; all that the probes meet are candidates, ranked by inner product of the original vectors, in
double precision, component by component. The k-th score divided by the product of lengths is the
cosine that a better row has at least, and ``fit`` finds what radius meets all but ``MISS`` of the rows
at each cosine. The radius is widened until it is that of the k-th score. A class is looked at whole
where that takes less than the probes, and as long as there are fewer than k scores.

The table is cut into blocks of rows, each parted into classes and indexed in its task, and the queries
into blocks as well; each pair of blocks meets once. A block returns at most k rows per query; the best
k of all blocks are chosen by rank, within tasks first.
"""

from __future__ import annotations

import math
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.common import stored

#: Rows that rotations are learned from at most; rotations; turns of learning.
SAMPLE, ROTATIONS, TURNS = 4096, 8, 20
SUBSTRING, RADIUS = 16, 3
ROW_BLOCK, QUERY_BLOCK = 16_384, 1_024
#: Least length in a class, as a share of its greatest.
RATIO = 0.9
#: Share of the rows at the cosine of the k-th score that the probes may miss.
MISS = 0.1
#: Rows of the sample that stand for queries when radii are found; steps of the cosine; pairs that a step needs.
TRIALS, STEPS, PAIRS = 256, 200, 200
#: A class is looked at whole where there are more probes than this for each of its rows.
PROBES = 8


def usable(vector: str) -> Column:
    """Vectors with at least one component, none of them null or not finite, not all zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)


def learn_rotations(sample: np.ndarray, rotations: int, turns: int = TURNS) -> np.ndarray:
    """``rotations`` orthogonal matrices, one after the other, from rows of equal length."""
    width, out = sample.shape[1], []
    for k in range(rotations):
        turn, _ = np.linalg.qr(np.random.default_rng(k).standard_normal((width, width)))
        for _ in range(turns if len(sample) > 1 else 0):
            signs = np.where(sample @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(sample.T @ signs)
            turn = left @ right
        out.append(turn)
    return np.stack(out)


def length_classes(lengths: np.ndarray) -> list[np.ndarray]:
    """Places of rows by class of length, the longest first."""
    order, at, out = np.argsort(-lengths, kind="stable"), 0, []
    falling = lengths[order]
    while at < len(order):
        end = max(at + 1, int(np.searchsorted(-falling, -RATIO * falling[at], side="right")))
        out.append(order[at:end])
        at = end
    return out


class Coder:
    """Codes of vectors, as substrings: rows and queries differ in the added component alone.

    ``radii`` has the radius that rows of each step of the cosine need, from -1 upwards.
    """

    def __init__(self, rotations: np.ndarray, longest: float, radii: np.ndarray | None = None) -> None:
        self.rotations, self.longest, self.radii = rotations, longest, radii

    def of_class(self, longest: float) -> Coder:
        return Coder(self.rotations, longest, self.radii)

    def extended(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        norms = np.linalg.norm(vectors, axis=1)
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.longest**2 - norms**2, 0.0))
        whole = np.column_stack([vectors, extra])
        return whole / np.maximum(np.linalg.norm(whole, axis=1, keepdims=True), 1e-300)

    def substrings(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        x = self.extended(vectors, query)
        bits = np.concatenate([x @ turn >= 0 for turn in self.rotations], axis=1)
        count = bits.shape[1] // SUBSTRING * SUBSTRING or bits.shape[1]
        bits = np.pad(bits[:, :count], ((0, 0), (0, -count % SUBSTRING)))
        return np.packbits(bits, axis=1).view(">u2").astype(np.int64)

    def radius(self, cosine: float) -> int:
        """The radius whose probes miss no more than ``MISS`` of the rows at this cosine or over it."""
        return int(self.radii[_step(cosine)])


def _step(cosine: float | np.ndarray) -> np.ndarray:
    return np.clip(np.floor((np.asarray(cosine) + 1) / 2 * STEPS), 0, STEPS - 1).astype(int)


def _radii(cosines: np.ndarray, nearest: np.ndarray, substrings: int, bits: int) -> np.ndarray:
    """Radius for each step of the cosine, from pairs' cosines and the distances of their nearest substrings.

    Never less than independent bits need at the lower end of the step, each of which differs with the
    share that the angle has of half a turn.
    """
    out = np.zeros(STEPS, int)
    steps = _step(cosines)
    for step in range(STEPS):
        p = math.acos(2 * step / STEPS - 1) / math.pi
        within = np.cumsum([math.comb(bits, r) * p**r * (1 - p) ** (bits - r) for r in range(bits + 1)])
        out[step] = np.argmax((1 - np.minimum(within, 1.0)) ** substrings <= MISS)
        own = nearest[steps == step]
        if len(own) >= PAIRS:
            out[step] = max(out[step], np.quantile(own, 1 - MISS, method="higher"))
    return np.maximum.accumulate(out[::-1])[::-1]


def fit(rows: DataFrame, sample: int = SAMPLE, rotations: int = ROTATIONS) -> Coder:
    """Rotations, and radii by cosine, from the ``sample`` rows of the smallest hash of vec_id."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").collect()
    return fit_sample(np.array([r["vector"] for r in chosen], float), rotations)


def fit_sample(vectors: np.ndarray, rotations: int = ROTATIONS) -> Coder:
    if not len(vectors):
        return Coder(np.zeros((rotations, 1, 1)), 0.0, np.full(STEPS, SUBSTRING))
    lengths, coder = np.linalg.norm(vectors, axis=1), Coder(np.empty(0), 0.0)
    classes = [(part, coder.of_class(lengths[part[0]])) for part in length_classes(lengths)]
    extended = np.empty((len(vectors), vectors.shape[1] + 1))
    for part, own in classes:
        extended[part] = own.extended(vectors[part], False)
    coder.rotations = learn_rotations(extended, rotations)
    trials = coder.substrings(vectors[:TRIALS], True)
    codes = np.empty((len(vectors), trials.shape[1]), np.int64)
    for part, own in classes:
        codes[part] = coder.of_class(own.longest).substrings(vectors[part], False)
    cosines = coder.extended(vectors[:TRIALS], True) @ extended.T
    nearest = np.stack([np.bitwise_count(codes ^ trial).min(axis=1) for trial in trials])
    apart = ~np.eye(len(trials), len(vectors), dtype=bool)
    bits = min(SUBSTRING, rotations * extended.shape[1])
    coder.radii = _radii(cosines[apart], nearest[apart], trials.shape[1], bits)
    return coder


def _masks(radius: int) -> np.ndarray:
    """All 16-bit values of at most ``radius`` ones."""
    values = np.arange(1 << SUBSTRING)
    return values[np.bitwise_count(values) <= radius]


class Block:
    """Rows with an index for each substring: rows in order of its value, and where values begin."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, coder: Coder) -> None:
        self.ids, self.vectors, self.coder = ids, vectors, coder

    @cached_property
    def index(self) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for values in self.coder.substrings(self.vectors, False).T:
            order = np.argsort(values, kind="stable").astype(np.int32)
            sizes = np.bincount(values, minlength=1 << SUBSTRING)
            out.append((order, np.append(0, np.cumsum(sizes)).astype(np.int32)))
        return out

    def candidates(self, substrings: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """Places of rows met by the probes."""
        seen = np.zeros(len(self.ids), bool)
        for (order, begins), value in zip(self.index, substrings, strict=True):
            probes = value ^ masks
            lo, sizes = begins[probes], begins[probes + 1] - begins[probes]
            full = sizes > 0
            lo, sizes = lo[full], sizes[full]
            if len(sizes):
                ends = np.cumsum(sizes)
                seen[order[np.arange(ends[-1]) + np.repeat(lo - ends + sizes, sizes)]] = True
        return np.flatnonzero(seen)

    def best(self, at: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best of the rows at these places."""
        at = at[self.ids[at] != query_id]
        if len(at) > 4 * k:
            rough = self.vectors[at] @ query
            # Rounding of the fast product is far below this margin.
            floor = np.partition(rough, len(at) - k)[len(at) - k]
            at = at[rough >= floor - 1e-9 * self.coder.longest * np.linalg.norm(query)]
        scores = np.zeros(len(at))
        for d in range(len(query)):
            scores += self.vectors[at, d] * query[d]
        best = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at][best], scores[best]


class Classes:
    """Rows in blocks by class of length, the longest first. ``looked`` counts the rows that were ranked."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, coder: Coder) -> None:
        lengths, self.looked = np.linalg.norm(vectors, axis=1), 0
        self.blocks = [Block(ids[part], vectors[part], coder.of_class(float(lengths[part[0]]))) for part in length_classes(lengths)]

    def nearest(self, query_id: int, query: np.ndarray, substrings: np.ndarray, k: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
        ids, scores, length = np.empty(0, np.int64), np.empty(0), float(np.linalg.norm(query))
        for block in self.blocks:
            bound = length * block.coder.longest
            if len(scores) == k and scores[-1] > bound * (1 + 1e-9):
                break
            reach = block.coder.radius(scores[-1] / bound) if len(scores) == k and bound else radius
            before = ids, scores
            while True:
                whole = reach >= SUBSTRING or len(substrings) * len(_masks_of(reach)) > PROBES * len(block.ids)
                at = np.arange(len(block.ids)) if whole else block.candidates(substrings, _masks_of(reach))
                own = block.best(at, query_id, query, k)
                ids, scores = np.append(before[0], own[0]), np.append(before[1], own[1])
                order = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[order], scores[order]
                if whole or (len(scores) == k and bound and reach >= block.coder.radius(scores[-1] / bound)):
                    break
                reach += 1
            self.looked += len(at)
        return ids, scores


_MASKS: dict[int, np.ndarray] = {}


def _masks_of(radius: int) -> np.ndarray:
    if radius not in _MASKS:
        _MASKS[radius] = _masks(radius)
    return _MASKS[radius]


def search(table: DataFrame, queries: Column, k: int = 20, radius: int = RADIUS, rotations: int = ROTATIONS, sample: int = SAMPLE, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for the rows that ``queries`` marks.

    ``table`` has ``vec_id`` and ``embedding``. Vectors null, empty, zero or with null or non-finite
    components take no part, nor do rows without vec_id or of another width than the table's widest
    group. A row is no neighbour of a query of its own vec_id; ties go to the smaller vec_id. Rows alike
    in vec_id and vector count once. Fewer than k other rows: all of them. Empty table: no rows.
    """
    rows = table.filter(F.col("vec_id").isNotNull() & usable("embedding")).select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), queries.alias("asked"))
    rows = stored(rows, "vectors")
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    if not widths:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == widths[0]["width"])
    coder = table.sparkSession.sparkContext.broadcast(fit(rows, sample, rotations))
    counts = rows.agg(F.count("*"), F.count(F.when(F.col("asked"), 1))).first()
    row_blocks, query_blocks = max(1, -(-counts[0] // row_block)), max(1, -(-counts[1] // query_block))

    deal = F.xxhash64("vec_id")
    left = rows.withColumn("row", F.pmod(deal, F.lit(row_blocks)).cast("int")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).select("row", "col", "vec_id", "vector")
    right = rows.filter("asked").withColumn("col", F.pmod(deal, F.lit(query_blocks)).cast("int")).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))).select("row", "col", "vec_id", "vector")

    def meet(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        block, asked = block.drop_duplicates("vec_id"), asked.drop_duplicates("vec_id")
        if block.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        held = Classes(block["vec_id"].to_numpy(np.int64), np.stack(block["vector"]).astype(float), coder.value)
        vectors = np.stack(asked["vector"]).astype(float)
        parts = []
        for query_id, query, own in zip(asked["vec_id"].tolist(), vectors, coder.value.substrings(vectors, True), strict=True):
            ids, scores = held.nearest(query_id, query, own, k, radius)
            parts.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores}))
        return pd.concat(parts)

    found = left.groupBy("row", "col").cogroup(right.groupBy("row", "col")).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, table: DataFrame, queries: Column, k: int = 20) -> float:
    """Share of the true k nearest that ``found`` has; brute force, for tables that fit in memory."""
    rows = table.filter(usable("embedding")).select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), queries.alias("asked")).toPandas()
    ids, vectors = rows["vec_id"].to_numpy(), np.stack(rows["vector"])
    have = found.toPandas().groupby("query_id")["vec_id"].apply(set)
    hits = total = 0
    for at in np.flatnonzero(rows["asked"].to_numpy(bool)):
        scores = vectors @ vectors[at]
        scores[ids == ids[at]] = -np.inf
        best = ids[np.lexsort((ids, -scores))[: min(k, int((ids != ids[at]).sum()))]]
        hits, total = hits + len(have.get(ids[at], set()) & set(best.tolist())), total + len(best)
    return hits / total if total else 1.0
