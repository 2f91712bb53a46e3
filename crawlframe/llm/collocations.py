"""Phrases whose words stand together more often than their parts do, from sorted streams of counts.

Texts are cut into tokens once. Tokens of a chunk of documents are numbered; words that occur often enough
in their language get an id, others part the stream (no phrase with them is frequent). A window is the up
to four ids from a position on. Each chunk writes its windows as a sorted run with counts. Runs are cut at
bounds taken from a sample of them, as range partitioning does, and the runs of a range are merged: in this
prefix order every phrase of two, three and four words is a stretch of neighbouring windows, so one pass
sums all counts without a hash table. Phrases that reach over a bound are summed from their parts.

Frequent phrases are then merge-joined, in prefix order with the counts of their first words, in suffix
order with the counts of their last words. Extensions come from the same stream: a longer phrase that holds
a shorter one is at most as frequent as those one word longer, so these are enough.

Memory of a task is bounded by a chunk's size or by the windows of a range, whatever the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.common import map_arrow, stored
from crawlframe.operators.ids import assign_ids

#: Bytes of text in a chunk, windows in a range, windows for each one in the sample.
CHUNK, RANGE, STRIDE = 16_000_000, 2_000_000, 4096
LEAST, TOP = 30, 2000
#: A phrase goes if a longer one has this share of its count, in hundredths.
HELD = 80
#: Stands between pieces; no word, since it separates them.
BREAK = b"."
_SMALL = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b"\n" * 10)


def tokens(texts: list[bytes]) -> pa.DictionaryArray:
    """Words of texts one after the other, with ``BREAK`` between pieces."""
    joined = b"\n".join(texts).translate(_SMALL).replace(b"\n", b" " + BREAK + b" ").strip(b" \t")
    said = pa.array([joined], pa.large_binary()).cast(pa.large_string())
    words = pc.ascii_split_whitespace(said).values if joined else said.slice(1)
    return words.dictionary_encode()


def _chunks(docs: DataFrame, size: int) -> DataFrame:
    """``chunk, lang, words, n, total, codes``: distinct words of a chunk with counts, and its tokens as their numbers."""
    names = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("n", pa.list_(pa.int64())), ("total", pa.int64()), ("codes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        number, held_bytes = (TaskContext.get().partitionId() << 32), 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, texts in held.items():
                coded = tokens(texts)
                words, codes = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int32)
                n = np.bincount(codes, minlength=len(words))
                total = len(codes) - int(sum(n[k] for k, w in enumerate(words.to_pylist()) if w == BREAK.decode()))
                columns = ([number], [lang], [words.to_pylist()], [n], [total], [codes.tobytes()])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, names, strict=True)], schema=names)
                number += 1
            held.clear()

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for k, lang in enumerate(langs):
                text = texts[k].as_py()
                held.setdefault(lang, []).append(text)
                held_bytes += len(text)
                if held_bytes >= size:
                    yield from flush()
                    held_bytes = 0
        yield from flush()

    rows = docs.filter("text is not null").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(cut, "chunk long, lang string, words array<string>, n array<long>, total long, codes binary")


def _pack(values: np.ndarray) -> bytes:
    """A sorted column is kept as differences, which are small."""
    return zstandard.compress(np.diff(values, prepend=values.dtype.type(0)).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), np.int64))


def merged(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (first, second) once, in order, with the sum of ``n``."""
    if not len(first):
        return first, second, n
    order = np.lexsort((second, first))
    first, second, n = first[order], second[order], n[order]
    starts = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1]))))
    return first[starts], second[starts], np.add.reduceat(n, starts)


def windows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of two ids or more at the positions of a stream, 0 for none, as two numbers of two ids each."""
    w = [ids]
    for k in range(1, 4):
        ahead = np.zeros_like(ids)
        ahead[:-k] = ids[k:]
        w.append(np.where(w[-1] > 0, ahead, 0))
    used = w[1] > 0
    return ((w[0] << 32) | w[1])[used], ((w[2] << 32) | w[3])[used]


def _runs(chunks: DataFrame, ids: DataFrame, stride: int) -> DataFrame:
    """``rows, first, second, n, at``: the windows of a chunk as a sorted run, and a sample of it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("rows", "first", "second", "n", "at")}
        codes, own = right["code"].to_numpy(), right["id"].to_numpy()
        for data in left["codes"].to_pylist():
            stream = np.frombuffer(data, np.int32)
            names = np.zeros(int(stream.max(initial=0)) + 1, np.int64)
            names[codes] = own
            first, second = windows(names[stream])
            first, second, n = merged(first, second, np.ones(len(first), np.int64))
            if len(first):
                at = slice(min(stride // 2, len(first) // 2), None, stride)
                out["rows"].append(len(first))
                out["first"].append(_pack(first))
                out["second"].append(zstandard.compress(second.tobytes(), 1))
                out["n"].append(zstandard.compress(n.tobytes(), 1))
                out["at"].append([{"first": int(a), "second": int(b)} for a, b in zip(first[at], second[at], strict=True)])
        kinds = [("rows", pa.int64()), ("first", pa.binary()), ("second", pa.binary()), ("n", pa.binary()), ("at", pa.list_(pa.struct([("first", pa.int64()), ("second", pa.int64())])))]
        return pa.table({name: pa.array(out[name], kind) for name, kind in kinds})

    schema = "rows long, first binary, second binary, n binary, at array<struct<first: long, second: long>>"
    return chunks.select("chunk", "codes").groupBy("chunk").cogroup(ids.groupBy("of")).applyInArrow(run, schema)


def _bounds(runs: DataFrame, size: int) -> np.ndarray:
    """Lower bounds of all ranges but the first: as many as there are ranges of about ``size`` windows, like Spark's own for a range partitioning."""
    rows = runs.agg(F.sum("rows")).first()[0] or 0
    parts = -(-rows // size)
    if parts < 2:
        return np.zeros((0, 2), np.int64)
    sample = runs.select(F.explode("at").alias("at")).select("at.first", "at.second")
    ranged = sample.repartitionByRange(parts, "first", "second").groupBy(F.spark_partition_id()).agg(F.min(F.struct("first", "second")).alias("low"))
    lows = sorted((r["low"]["first"], r["low"]["second"]) for r in ranged.collect())
    return np.array(lows[1:], np.int64).reshape(-1, 2)


def _places(first: np.ndarray, second: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Row of a sorted run at which each bound stands."""
    low, high = np.searchsorted(first, bounds[:, 0]), np.searchsorted(first, bounds[:, 0], "right")
    for k in np.flatnonzero(high > low):
        low[k] += np.searchsorted(second[low[k] : high[k]], bounds[k, 1])
    return low


def _cut(runs: DataFrame, bounds: np.ndarray) -> DataFrame:
    """``part, first, second, n``: each run's windows by range."""

    def cut(rows: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("part", "first", "second", "n")}
        for packed, other, counts in zip(rows["first"], rows["second"], rows["n"], strict=True):
            first = _unpack(packed)
            second, n = (np.frombuffer(zstandard.decompress(x), np.int64) for x in (other, counts))
            places = [0, *_places(first, second, bounds).tolist(), len(first)]
            for part, (a, b) in enumerate(zip(places, places[1:], strict=False)):
                if b > a:
                    out["part"].append(part)
                    out["first"].append(_pack(first[a:b]))
                    out["second"].append(zstandard.compress(second[a:b].tobytes(), 1))
                    out["n"].append(zstandard.compress(n[a:b].tobytes(), 1))
        return out

    columns = {"part": pa.int32(), "first": pa.binary(), "second": pa.binary(), "n": pa.binary()}
    return map_arrow(runs.select("first", "second", "n"), cut, "part int, first binary, second binary, n binary", columns, rows=1)


def _stretches(keys: list[np.ndarray], n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sums of stretches of equal keys: frequent ones, and the outer ones, which may go on in the next range."""
    new = np.zeros(len(n), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(n, starts)
    kept = sums >= least
    kept[[0, -1]] = True
    return starts[kept], sums[kept]


def _phrases(cut: DataFrame, least: int) -> DataFrame:
    """``gram, f``: phrases of a range with their counts there, ids as an array."""

    def merge(table: pa.Table) -> pa.Table:
        first = np.concatenate([_unpack(x) for x in table["first"].to_pylist()])
        second, n = (np.concatenate([np.frombuffer(zstandard.decompress(x), np.int64) for x in table[c].to_pylist()]) for c in ("second", "n"))
        first, second, n = merged(first, second, n)
        ids = [first >> 32, first & 0xFFFFFFFF, second >> 32, second & 0xFFFFFFFF]
        grams, sums = [], []
        for size, keys in ((2, [first]), (3, [first, ids[2]]), (4, [first, second])):
            whole = np.flatnonzero(ids[size - 1])
            if len(whole):
                starts, f = _stretches([k[whole] for k in keys], n[whole], least)
                grams += np.stack([i[whole][starts] for i in ids[:size]], axis=1).astype(np.int32).tolist()
                sums += f.tolist()
        return pa.table({"gram": pa.array(grams, pa.list_(pa.int32())), "f": pa.array(sums, pa.int64())})

    return cut.groupBy("part").applyInArrow(merge, "gram array<int>, f long")


def phrase_counts(docs: DataFrame, least: int = LEAST, chunk: int = CHUNK, size: int = RANGE, stride: int = STRIDE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words ``(lang, word, f, id)``, frequent phrases ``(gram, f)`` of 2 to 4 ids, and ``(lang, n)``."""
    chunks = stored(_chunks(docs, chunk), "chunks")
    totals = stored(chunks.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    said = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "n")).alias("code", "w"))
    said = said.select("chunk", "lang", "code", F.col("w.words").alias("word"), F.col("w.n").alias("n")).filter(F.col("word") != BREAK.decode())
    counts = stored(said.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "words")
    # The key of a word is its language's length, the language and the word: no two read the same.
    keyed = counts.withColumn("key", F.concat(F.length("lang").cast("string"), F.lit(":"), "lang", "word"))
    words = stored(assign_ids(keyed, "key").drop("key"), "ids")
    if (words.agg(F.max("id")).first()[0] or 0) >= 1 << 31:
        raise OverflowError("more than 2^31 frequent words: raise `least`")
    ids = said.select("chunk", "lang", "code", "word").join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("chunk").alias("of"), "code", "id")
    runs = stored(_runs(chunks, ids, stride), "runs")
    partial = _phrases(_cut(runs, _bounds(runs, size)), least)
    phrases = partial.groupBy("gram").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return words, stored(phrases, "phrases"), totals


def _score(a: Column, l: Column, r: Column) -> Column:
    """``floor(2000000 * a / (l + r))``, exactly."""
    wide: Callable[[Column], Column] = lambda c: c.cast("decimal(20,0)")
    above, below = wide(a) * F.lit(2_000_000).cast("decimal(8,0)"), wide(l) + wide(r)
    return ((above - above % below) / below).cast("decimal(20,0)").cast("long")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **sizes: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each lang, null as ``und``.

    Null and empty texts have no words; repeated rows each count. An empty table, or no phrase of ``least``
    occurrences, gives no rows. Only lang and text are read.
    """
    words, phrases, totals = phrase_counts(docs, least, **sizes)
    counts = phrases.unionByName(words.select(F.array(F.col("id").cast("int")).alias("gram"), "f"))
    size = F.size("gram")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("gram", "f", "k", F.slice("gram", F.lit(1), F.col("k")).alias("head"), F.slice("gram", F.col("k") + 1, size - F.col("k")).alias("tail"))
    heads = counts.select(F.col("gram").alias("head"), F.col("f").alias("l"))
    tails = counts.select(F.col("gram").alias("tail"), F.col("f").alias("r"))
    joined = cuts.join(heads.hint("merge"), "head").join(tails.hint("merge"), "tail")
    best = F.min(F.struct(_score(F.col("f"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    scored = joined.groupBy("gram", "f").agg(best.alias("best"))

    parts = F.array(F.slice("gram", F.lit(1), size - 1), F.slice("gram", F.lit(2), size - 1))
    longer = phrases.filter(size > 2).select(F.explode(parts).alias("gram"), "f").groupBy("gram").agg(F.max("f").alias("held"))
    kept = scored.join(longer.hint("merge"), "gram", "left").filter(F.col("held").isNull() | (F.col("held").cast("decimal(20,0)") * 100 < F.col("f").cast("decimal(20,0)") * HELD))

    spelled = kept.select("gram", "f", "best", F.posexplode("gram").alias("pos", "id")).join(words.select(F.col("id").cast("int").alias("id"), "lang", "word"), "id")
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ")
    rows = spelled.groupBy("gram", "f", "best").agg(F.first("lang").alias("lang"), said.alias("phrase")).select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A lang's phrases are ranked in as many parts as shuffles have, then the first of each part together.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
