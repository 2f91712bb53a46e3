"""Benchmark leaks: items whose word shingles a document holds, found by size-partitioned MinHash.

Texts are lower-cased and cut into words of letters and digits; a shingle is five words in a
row (a text of one to four words has one shingle, itself). An item leaks into a document that holds
at least ``share`` of its distinct shingles.

Search: the item's sketch is its smallest shingle hashes (bottom-k MinHash). A document that holds
``ceil(share * n)`` of ``n`` shingles misses at most ``n - ceil(share * n)``, so one of the smallest
``n - ceil(share * n) + 1`` is in it: sketches of that length lose no leak, however long the document.
Items are partitioned by size (powers of two of ``n``); a partition is probed only by documents with
as many shingles as its smallest item needs. Candidates are verified with all shingles, as texts.

Items are taken in blocks of bounded size, each sent to all tasks in turn; documents are never
shuffled for the search, only their candidate pairs' counts are rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.common import map_arrow

WORD = re.compile(r"[^\W_]+")
WIDTH, SHARE = 5, 0.8
#: An item block holds so many items' words at most, or a single item.
BLOCK_WORDS = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(words: list[str], width: int = WIDTH) -> set[tuple[str, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


class Hasher:
    """Words to 64-bit numbers, remembered while they are few; shingle hashes by a rolling mix."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str], width: int) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w) >> 1
        h = np.fromiter(map(known.__getitem__, words), np.int64, len(words)).view(np.uint64)
        n = max(1, len(h) - width + 1) if len(h) else 0
        if n == 1:
            width = len(h)
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out = (out ^ h[k : k + n]) * MIX
            out ^= out >> np.uint64(29)
        return out


def sketch_length(n: int, share: float) -> int:
    return n - math.ceil(share * n - 1e-9) + 1


class Index:
    """Sketches of one block of items, by size partition."""

    def __init__(self, items: list[tuple[int, str]], width: int, share: float) -> None:
        self.width, self.share, self.parts, hasher = width, share, [], Hasher()
        classes: dict[tuple[bool, int], list] = {}
        for item_id, text in items:
            words = words_of(text)
            own = shingles(words, width)
            if own:
                short = len(words) if len(words) < width else 0
                classes.setdefault((short, len(own).bit_length()), []).append((item_id, words, own))
        for (short, _), rows in sorted(classes.items()):
            hashes, places = [], []
            for place, (_, words, own) in enumerate(rows):
                sketch = np.unique(hasher(words, width))[: sketch_length(len(own), share)]
                hashes.append(sketch)
                places.append(np.full(len(sketch), place))
            flat, at = np.concatenate(hashes), np.concatenate(places)
            order = np.argsort(flat, kind="stable")
            need = min(math.ceil(share * len(own) - 1e-9) for _, _, own in rows)
            self.parts.append((short, need, flat[order], at[order], rows))

    def find(self, words: list[str], hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """``(item_id, shingles held, shingles of the item)`` for each item that leaks into the words."""
        found, own, distinct = [], None, None
        short = len(words) if len(words) < self.width else 0
        for kind, need, flat, at, rows in self.parts:
            if kind != short or len(hashes) < need:
                continue
            spot = np.searchsorted(flat, hashes)
            spot[spot == len(flat)] = 0
            hit = np.unique(hashes[flat[spot] == hashes])
            if not len(hit):
                continue
            own = shingles(words, self.width) if own is None else own
            lo, hi = np.searchsorted(flat, hit), np.searchsorted(flat, hit, "right")
            for place in sorted({int(p) for a, b in zip(lo, hi, strict=True) for p in at[a:b]}):
                item_id, _, mine = rows[place]
                held = len(mine & own)
                if held >= self.share * len(mine) - 1e-9:
                    found.append((item_id, held, len(mine)))
        return found


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS):
    """The items in blocks of bounded size, fetched one partition at a time."""
    block, size = [], 0
    for row in items.select("item_id", "text").filter("text is not null").toLocalIterator():
        n = len(row["text"]) // 4 + 1
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += n
    if block:
        yield block


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, held, shingles``: one row per document row and item that leaks into it.

    Null and empty texts, of documents or items, have no shingle and never match. A text of fewer than
    ``width`` words matches only a text of just those words. Repeated rows each count. Either table
    empty: no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    found = spark.createDataFrame([], "doc_id long, item_id long, held int, shingles int")
    for block in item_blocks(items, block_words):
        index = spark.sparkContext.broadcast(Index(block, width, share))
        found = found.unionByName(_probe(docs, index))
    return found


def _probe(docs: DataFrame, index) -> DataFrame:
    hasher = Hasher()

    def probe(rows: dict) -> dict | None:
        one, out = index.value, {"doc_id": [], "item_id": [], "held": [], "shingles": []}
        for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
            words = words_of(text)
            for item_id, held, size in one.find(words, hasher(words, one.width)) if words else ():
                for name, value in zip(out, (doc_id, item_id, held, size), strict=True):
                    out[name].append(value)
        return out if out["doc_id"] else None

    columns = {"doc_id": pa.int64(), "item_id": pa.int64(), "held": pa.int32(), "shingles": pa.int32()}
    return map_arrow(docs.select("doc_id", "text"), probe, "doc_id long, item_id long, held int, shingles int", columns)


def without_leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, columns as they are."""
    spark, names = docs.sparkSession, docs.columns
    for block in item_blocks(items, block_words):
        index = spark.sparkContext.broadcast(Index(block, width, share))
        hasher = Hasher()

        @F.pandas_udf("boolean")
        def leaked(texts, index=index, hasher=hasher):
            one = index.value
            words = texts.map(words_of, na_action=None)
            return words.map(lambda w: bool(w) and bool(one.find(w, hasher(w, one.width))))

        docs = docs.filter(~leaked("text"))
    return docs.select(*names)
