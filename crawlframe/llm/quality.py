"""Quality by the perplexity of an interpolated modified Kneser-Ney model of characters.

The model predicts each character of a text from the two before it. Counts come from trusted texts:
trigrams as they occur, lower orders by how many different characters precede them; each order takes
three discounts (for counts of one, two and more) from its counts of counts and gives what it takes
to the next lower order, the last to all characters alike, unseen ones included.

Texts are summed up once, as packs: for up to 2,048 texts, each trigram with the texts that hold it
and how often. Packs are what moves, about a fifth of the texts' bytes. The trigrams of all texts meet
the counts in joins by trigram, context and suffix, which give each its log probability; these, cut
into shards by trigram, then meet the packs shard by shard, and sums per text come back. The model
grows with the corpus, and no task holds more than a shard and a few packs.

A text is rejected if its log perplexity is over its language's limit, taken from quantiles of the
trusted texts in that language: median + ``spread`` * (95 % quantile - median). Short texts vary more
for chance alone, so theirs is widened by ``slack`` / sqrt(characters).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.common import map_arrow, stored

#: Stands before a text's first character; a text's own U+FDD0, which is no character, reads the same.
BEGIN = 0xFDD0
BITS = 21
PACK_ROWS, PACK_CHARS = 2048, 1_000_000
#: Trigrams in a shard of the model, and texts whose packs meet in one task.
SHARD_GRAMS, SALT_ROWS = 250_000, 16_384
#: Bits of the filter that spares other texts than trusted ones the join with the trusted ids.
FILTER_BITS = 1 << 23
SPREAD, SLACK = 3.0, 5.0
#: A language with fewer trusted texts than this takes the limit of all languages.
LEAST_TEXTS = 20


# ---- trigrams of texts


def postings(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(trigram, text number, times)`` in order of trigram, then text number."""
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(c) for c in codes], np.int64)
    if not sizes.sum():
        return (np.empty(0, np.int64),) * 3
    begin = np.full(2, BEGIN, np.uint32)
    flat = np.concatenate([part for c in codes for part in (begin, c)])
    used = np.flatnonzero(np.bincount(flat))
    small, base = np.searchsorted(used, flat) if len(used) > 60_000 else _lookup(used)[flat], len(used)
    text = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(text)) + 2 * text
    key = (small[at] * base + small[at + 1]) * base + small[at + 2]
    if base**3 * len(texts) < 2**63:
        key = key * len(texts) + text
        key.sort()
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times = np.diff(np.append(heads, len(key)))
        key, text = key[heads] // len(texts), key[heads] % len(texts)
    else:
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        heads = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])))
        times = np.diff(np.append(heads, len(key)))
        key, text = key[heads], text[heads]
    gram = used[key // base // base] << 2 * BITS | used[key // base % base] << BITS | used[key % base]
    return gram, text, times


def _lookup(used: np.ndarray) -> np.ndarray:
    out = np.zeros(int(used[-1]) + 1, np.int64)
    out[used] = np.arange(len(used))
    return out


def _squeeze(values: np.ndarray, kind: type) -> bytes:
    """Whole numbers by byte planes, compressed."""
    planes = values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueeze(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


PACK = "docs binary, prints binary, grams binary, sizes binary, texts binary, times binary"
PACK_COLUMNS = {name: pa.binary() for name in ("docs", "prints", "grams", "sizes", "texts", "times")}


def text_print(text: str | None) -> int:
    """Signed XXH64 of a text, as the SQL function of that name gives it."""
    if text is None:
        return 42
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >> 63 else h


def _parts(texts: list) -> list[tuple[int, int]]:
    """Bounds of parts of at most PACK_CHARS characters, or of one longer text."""
    bounds, size = [0], 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size > PACK_CHARS and k > bounds[-1]:
            bounds.append(k)
            size = len(text or "")
    return list(zip(bounds, [*bounds[1:], len(texts)], strict=True))


def packs(docs: DataFrame) -> DataFrame:
    """Trigrams of all texts, in packs of texts. Rows of ids and texts alike may share a pack or not."""

    def pack(rows: dict) -> dict:
        out: dict[str, list] = {name: [] for name in PACK_COLUMNS}
        for at, stop in _parts(rows["text"]):
            _add_pack(out, rows["doc_id"][at:stop], rows["text"][at:stop])
        return out

    return map_arrow(docs.select("doc_id", "text"), pack, PACK, PACK_COLUMNS, rows=PACK_ROWS)


def _add_pack(out: dict, ids: list, texts: list) -> None:
    gram, text, times = postings([t or "" for t in texts])
    heads = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.empty(0, np.int64)
    out["docs"].append(np.array([0 if d is None else d for d in ids], np.int64).tobytes())
    out["prints"].append(np.array([text_print(t) for t in texts], np.int64).tobytes())
    out["grams"].append(_squeeze(np.diff(gram[heads], prepend=0), np.int64))
    out["sizes"].append(_squeeze(np.diff(np.append(heads, len(gram))), np.int32))
    out["texts"].append(_squeeze(np.diff(text, prepend=0), np.int16))
    out["times"].append(_squeeze(times, np.int32 if len(times) and times.max() > 32767 else np.int16))


def _read_pack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams, texts per trigram, and text number and times of each posting."""
    sizes, text = _unsqueeze(row["sizes"], np.int32), np.cumsum(_unsqueeze(row["texts"], np.int16), dtype=np.int64)
    plain = zstandard.ZstdDecompressor().decompress(row["times"])
    kind = np.int32 if len(text) and len(plain) == 4 * len(text) else np.int16
    return np.cumsum(_unsqueeze(row["grams"], np.int64)), sizes, text, _unsqueeze(row["times"], kind)


# ---- counts and the model


def trusted_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``trusted``. A filter of fixed size keeps most other texts out of the join."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    word = trusted.select(F.shiftright(slot, 5).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(31).cast("int")).alias("bit"))
    rows = word.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS // 32, np.int64)
    bits[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bits.astype(np.uint32))

    @F.pandas_udf("boolean")
    def maybe(slots: pd.Series) -> pd.Series:
        at = slots.to_numpy(np.int64)
        return pd.Series((shared.value[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool))

    # One plan at every size: the ids are never broadcast.
    return docs.filter("doc_id is not null").filter(maybe(slot)).join(trusted.hint("merge"), "doc_id", "left_semi")


def trigram_counts(texts: DataFrame) -> DataFrame:
    """``gram, n``: how often each trigram occurs in the texts."""

    def count(rows: dict) -> dict:
        out: dict[str, list] = {"gram": [], "n": []}
        for at, stop in _parts(rows["text"]):
            gram, _, times = postings([t or "" for t in rows["text"][at:stop]])
            heads = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.empty(0, np.int64)
            out["gram"].append(gram[heads])
            out["n"].append(np.add.reduceat(times, heads) if len(heads) else times)
        return {name: np.concatenate(parts) for name, parts in out.items()}

    counts = map_arrow(texts.select("text"), count, "gram long, n long", {"gram": pa.int64(), "n": pa.int64()}, rows=PACK_ROWS)
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """Discounts of counts of one, two and more, from the counts of counts; halves and wholes where there are too few."""
    n = counts.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(str(k)) for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (n[str(k)] for k in range(1, 5))
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


def _discounted(n: str | Column, d: list[float]) -> Column:
    n = F.col(n) if isinstance(n, str) else n
    return n - F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def _contexts(counts: DataFrame, context: Column, d: list[float], level: int) -> DataFrame:
    """Per context: the sum of its counts and the weight it gives to the lower order."""
    many = [F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1)), F.count(F.when(F.col("n") > 2, 1))]
    given = sum((c * x for c, x in zip(many, d, strict=True)), F.lit(0.0))
    total = F.sum("n")
    return counts.groupBy(context.alias(f"context{level}")).agg(total.alias(f"total{level}"), (given / total).alias(f"given{level}"))


def gram_logs(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``gram, log_p`` for every trigram of ``grams`` under the trusted ``counts`` (both distinct by gram)."""
    low2, low1 = (1 << 2 * BITS) - 1, (1 << BITS) - 1
    context3, suffix2 = F.shiftright("gram", BITS), F.col("gram").bitwiseAND(F.lit(low2))
    count2 = stored(counts.groupBy(suffix2.alias("gram")).agg(F.count("*").alias("n")), "bigrams")
    count1 = stored(count2.groupBy(F.col("gram").bitwiseAND(F.lit(low1)).alias("gram")).agg(F.count("*").alias("n")), "characters")
    d3, d2, d1 = _discounts(counts), _discounts(count2), _discounts(count1)
    sums = count1.agg(F.sum("n"), F.count("*"), *[F.count(F.when(c, 1)) for c in (F.col("n") == 1, F.col("n") == 2, F.col("n") > 2)]).first()
    total1, kinds = sums[0] or 0, sums[1] + 1
    if not total1:
        return grams.select("gram", F.lit(-math.log(kinds)).alias("log_p"))
    given1 = sum(c * d for c, d in zip(sums[2:], d1, strict=True)) / total1

    keyed = grams.select("gram", context3.alias("context3"), suffix2.alias("suffix2"), F.shiftright(suffix2, BITS).alias("context2"), F.col("gram").bitwiseAND(F.lit(low1)).alias("suffix1"))
    joined = keyed.join(counts.withColumnRenamed("n", "n3"), "gram", "left")
    joined = joined.join(_contexts(counts, context3, d3, 3), "context3", "left")
    joined = joined.join(count2.select(F.col("gram").alias("suffix2"), F.col("n").alias("n2")), "suffix2", "left")
    joined = joined.join(_contexts(count2, F.shiftright("gram", BITS), d2, 2), "context2", "left")
    joined = joined.join(count1.select(F.col("gram").alias("suffix1"), F.col("n").alias("n1")), "suffix1", "left")
    p1 = F.coalesce(_discounted("n1", d1) / total1, F.lit(0.0)) + given1 / kinds
    p2 = F.coalesce(_discounted("n2", d2) / F.col("total2"), F.lit(0.0)) + F.coalesce(F.col("given2"), F.lit(1.0)) * p1
    p3 = F.coalesce(_discounted("n3", d3) / F.col("total3"), F.lit(0.0)) + F.coalesce(F.col("given3"), F.lit(1.0)) * p2
    return joined.select("gram", F.log(p3).alias("log_p"))


# ---- scores


def _split(packed: DataFrame, shards: int, salts: int) -> DataFrame:
    """Packs by shard of trigrams; a pack goes to one salt."""

    def split(rows: dict) -> dict:
        out: dict[str, list] = {name: [] for name in ("shard", "salt", *PACK_COLUMNS)}
        for k in range(len(rows["docs"])):
            row = {name: rows[name][k] for name in PACK_COLUMNS}
            salt = xxhash.xxh64_intdigest(row["prints"]) % salts
            if shards == 1:
                parts = [(0, row)]
            else:
                grams, sizes, text, times = _read_pack(row)
                owner = np.repeat(_shard_of(grams, shards), sizes)
                parts = []
                for s in range(shards):
                    mine, own = owner == s, _shard_of(grams, shards) == s
                    kind = np.int32 if mine.any() and times[mine].max() > 32767 else np.int16
                    arrays = {"grams": _squeeze(np.diff(grams[own], prepend=0), np.int64), "sizes": _squeeze(sizes[own], np.int32), "texts": _squeeze(np.diff(text[mine], prepend=0), np.int16), "times": _squeeze(times[mine], kind)}
                    parts.append((s, row | arrays))
            for s, part in parts:
                for name, value in ({"shard": s, "salt": salt} | part).items():
                    out[name].append(value)
        return out

    return map_arrow(packed, split, f"shard int, salt int, {PACK}", {"shard": pa.int32(), "salt": pa.int32()} | PACK_COLUMNS, rows=4)


def _shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _sum_shard(pack_rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    order = np.argsort(model["gram"].to_numpy(np.int64))
    known, logs = model["gram"].to_numpy(np.int64)[order], model["log_p"].to_numpy()[order]
    found = []
    for row in pack_rows.to_dict("records"):
        grams, sizes, text, times = _read_pack(row)
        docs, prints = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["prints"], np.int64)
        each = np.repeat(logs[np.searchsorted(known, grams)], sizes) if len(grams) else np.empty(0)
        found.append(pd.DataFrame({"doc": docs, "print": prints, "log_p": np.bincount(text, each * times, len(docs)), "chars": np.bincount(text, times, len(docs)).astype(np.int64), "copies": int(row["shard"] == 0)}))
    return pd.concat(found) if found else pd.DataFrame({"doc": [], "print": [], "log_p": [], "chars": [], "copies": []})


def log_perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``doc, print, chars, log_ppl`` for each distinct (doc_id or 0, text); no characters: null perplexity."""
    packed = stored(packs(docs), "packs")
    counts = stored(trigram_counts(trusted_texts(docs.select("doc_id", "text"), trusted)), "trigrams")

    def explode(rows: dict) -> dict:
        return {"gram": np.unique(np.concatenate([np.empty(0, np.int64), *(np.cumsum(_unsqueeze(g, np.int64)) for g in rows["grams"])]))}

    grams = map_arrow(packed.select("grams"), explode, "gram long", {"gram": pa.int64()}, rows=64).distinct()
    logs = stored(gram_logs(grams, counts), "logs")
    shards = max(1, math.ceil(logs.count() / SHARD_GRAMS))
    salts = max(1, math.ceil(docs.count() / SALT_ROWS))
    shard_of = F.pmod(F.xxhash64("gram"), F.lit(shards)).cast("int")
    if shards > 1:
        owner = F.pandas_udf(lambda g: pd.Series(_shard_of(g.to_numpy(np.int64), shards).astype(np.int32)), "int")
        shard_of = owner("gram")
    model = logs.withColumn("shard", shard_of if shards > 1 else F.lit(0)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    sums = _split(packed, shards, salts).groupBy("shard", "salt").cogroup(model.groupBy("shard", "salt"))
    found = sums.applyInPandas(_sum_shard, "doc long, print long, log_p double, chars long, copies long")
    # Rows alike share a sum; each is in shard 0 once.
    found = found.groupBy("doc", "print").agg(F.sum("log_p").alias("log_p"), F.sum("chars").alias("chars"), F.sum("copies").alias("copies"))
    return found.select("doc", "print", F.expr("chars div copies").alias("chars"), F.round(-F.try_divide("log_p", "chars"), 4).alias("log_ppl"))


def quality(docs: DataFrame, labels: DataFrame, spread: float = SPREAD, slack: float = SLACK) -> DataFrame:
    """``doc_id, lang, chars, log_ppl, perplexity, limit, kept``, a row for each row of ``docs``.

    Trusted are the texts labelled of quality 1. Null and empty texts have no perplexity and are not kept.
    Without any trusted text there is no limit and every text with characters is kept. A null lang, or
    one with few trusted texts, takes the limit of all languages. Repeated rows each count and score
    alike. An empty table gives no rows; other columns are not read.
    """
    trusted = stored(labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct(), "trusted")
    scores = stored(log_perplexities(docs, trusted), "perplexities")
    rows = docs.select("doc_id", "lang", F.coalesce("doc_id", F.lit(0)).alias("doc"), F.xxhash64("text").alias("print"))
    rows = stored(rows.join(scores, ["doc", "print"]), "scored")
    known = rows.join(trusted, "doc_id", "left_semi").filter("log_ppl is not null")
    parts = known.groupBy("lang").agg(F.percentile("log_ppl", F.array(F.lit(0.5), F.lit(0.95))).alias("q"), F.count("*").alias("n"))
    every = known.agg(F.percentile("log_ppl", F.array(F.lit(0.5), F.lit(0.95)))).first()[0]
    common = every[0] + spread * (every[1] - every[0]) if every else float("inf")
    limits = parts.filter(F.col("n") >= LEAST_TEXTS).select("lang", (F.col("q")[0] + spread * (F.col("q")[1] - F.col("q")[0])).alias("limit"))
    limit = F.coalesce("limit", F.lit(common)) + F.coalesce(F.try_divide(F.lit(slack), F.sqrt("chars")), F.lit(0.0))
    out = rows.join(limits, "lang", "left").withColumn("limit", limit)
    return out.select("doc_id", "lang", "chars", "log_ppl", F.exp("log_ppl").alias("perplexity"), "limit", F.coalesce(F.col("log_ppl") <= F.col("limit"), F.lit(False)).alias("kept"), "print")


def keep_good(docs: DataFrame, labels: DataFrame, spread: float = SPREAD, slack: float = SLACK) -> DataFrame:
    """The rows of ``docs`` that are not rejected, columns as they are."""
    kept = stored(quality(docs, labels, spread, slack).filter("kept").select(F.col("doc_id").alias("_doc"), F.col("print").alias("_print"), F.col("lang").alias("_lang")).distinct(), "kept")
    same = docs["doc_id"].eqNullSafe(kept["_doc"]) & (F.xxhash64(docs["text"]) == kept["_print"]) & docs["lang"].eqNullSafe(kept["_lang"])
    return docs.join(kept, same, "left_semi")
