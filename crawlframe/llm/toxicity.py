"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; unlabelled text is a mixture with a known share of toxic
ones, the class prior. With the logistic loss, the risk of a score f is

    prior * R_pos(f, toxic)  +  max(0, R_unl(f, clean) - prior * R_pos(f, clean)),

whose second part corrects the unlabelled risk for the toxic texts in it and is held at zero or more:
a step that finds it negative goes back along its gradient instead (the non-negative estimator).

The score is linear in hashed words and beginnings of words, by the logarithm of how many distinct
words of the text have them. Training texts are bounded samples, chosen by a
hash of doc_id; only
their telling features reach the driver, where numpy fits the weights. Every whole
text is then scored in its task.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.common import map_arrow, stored

WORD = re.compile(r"[^\W_]+")
#: Words are numbered modulo this.
SLOTS = 1 << 20
#: Beginnings of words are features too, marked by a final dash.
PREFIXES = range(3, 9)
#: Bounds on the training texts: at most so many positives and unlabelled ones.
POSITIVES, UNLABELLED = 4000, 8000
#: A feature counts if positives have it more often than unlabelled texts by so many standard errors.
OVER = 4.0
STEPS, RATE, DECAY = 300, 0.03, 3e-4


class Features:
    """Feature numbers of a text's distinct words and their beginnings, with the words that have each.

    Words seen are remembered; the memory is emptied when it is full. ``used`` keeps some numbers only.
    """

    def __init__(self, used: np.ndarray | None = None) -> None:
        self.known: dict[str, tuple[int, ...]] = {}
        self.used = used

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        known, words = self.known, set(WORD.findall((text or "").lower()))
        if len(known) > 300_000:
            known.clear()
        for w in words.difference(known):
            numbers = [xxhash.xxh64_intdigest(part) % SLOTS for part in (w, *(f"{w[:k]}-" for k in PREFIXES if k < len(w)))]
            known[w] = tuple(x for x in numbers if self.used is None or self.used[x])
        return np.unique(np.fromiter(chain.from_iterable(map(known.__getitem__, words)), np.int64), return_counts=True)


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def _spread(rows: list[tuple[np.ndarray, np.ndarray]], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, row and value of all rows, for features that have a place."""
    words = np.concatenate([x for x, _ in rows])
    kept = place[words] >= 0
    counts = np.concatenate([n for _, n in rows])[kept]
    return place[words[kept]], np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])[kept], np.log1p(counts)


def fit(positives: list, unlabelled: list, prior: float, used: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the ``used`` features and the bias, from rows of (features, counts)."""
    weights = np.zeros(SLOTS, np.float32)
    if not positives or not unlabelled or not 0 < prior < 1:
        return weights, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    n_p, n_u = len(positives), len(unlabelled)
    place = np.full(SLOTS, -1)
    place[used] = np.arange(len(used))
    (p_word, p_row, p_value), (u_word, u_row, u_value) = _spread(positives, place), _spread(unlabelled, place)
    w, m, v = np.zeros(len(used) + 1), 0.0, 0.0
    w[-1] = np.log(prior / (1 - prior))
    soft = lambda x: np.logaddexp(0, x)
    sigmoid = lambda x: 0.5 + 0.5 * np.tanh(x / 2)
    for step in range(1, STEPS + 1):
        f_p = np.bincount(p_row, w[p_word] * p_value, n_p) + w[-1]
        f_u = np.bincount(u_row, w[u_word] * u_value, n_u) + w[-1]
        clean = soft(f_u).mean() - prior * soft(f_p).mean()
        toxic_p, clean_p, clean_u = -prior * sigmoid(-f_p) / n_p, -prior * sigmoid(f_p) / n_p, sigmoid(f_u) / n_u
        # Where the clean part's estimate has gone below zero, the step goes back along its gradient.
        g_p, g_u = (toxic_p + clean_p, clean_u) if clean >= 0 else (-clean_p, -clean_u)
        words = np.bincount(p_word, g_p[p_row] * p_value, len(used)) + np.bincount(u_word, g_u[u_row] * u_value, len(used))
        grad = np.append(words + DECAY * w[:-1], g_p.sum() + g_u.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights[used] = w[:-1]
    return weights, float(w[-1])


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias from toxic labels outside the held-out fifth and from unlabelled texts.

    ``prior`` is the toxic share of all texts; by default that of the labels outside the fifth.
    """
    own = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = own.agg(F.avg("toxic")).first()[0] or 0.0
    deal = F.xxhash64("doc_id")
    toxic = own.filter("toxic = 1").orderBy(deal, "doc_id").limit(positives).select("doc_id", F.lit(True).alias("toxic"))
    other = docs.filter("doc_id is not null").select("doc_id").orderBy(deal, "doc_id").limit(unlabelled).distinct().select("doc_id", F.lit(False).alias("toxic"))
    # At most positives + unlabelled ids.
    chosen = stored(docs.select("doc_id", "text").join(F.broadcast(toxic.union(other)), "doc_id").select("text", "toxic"), "training")
    sizes = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return fit([], [], float(prior), np.empty(0, np.int64))

    def count(rows: dict) -> dict:
        features, sums = Features(), np.zeros((2, SLOTS), np.int32)
        for text, kind in zip(rows["text"], rows["toxic"], strict=True):
            sums[int(kind), features(text)[0]] += 1
        found = np.flatnonzero(sums.any(axis=0))
        return {"feature": found, "p": sums[1, found], "u": sums[0, found]}

    counts = map_arrow(chosen, count, "feature int, p int, u int", {"feature": pa.int32(), "p": pa.int32(), "u": pa.int32()})
    counts = counts.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    over = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt((F.col("u") + 1) / n_u / n_p)
    used = np.sort(counts.filter((over >= OVER) & (F.col("p") >= 2)).select("feature").toPandas()["feature"].to_numpy(np.int64))

    def numbers(rows: dict) -> dict:
        mask = np.zeros(SLOTS, bool)
        mask[used] = True
        features = Features(mask)
        found = [features(t) for t in rows["text"]]
        packed = {"words": [x.astype(np.int32).tobytes() for x, _ in found], "counts": [n.astype(np.int32).tobytes() for _, n in found]}
        return {"toxic": rows["toxic"]} | packed

    columns = {"toxic": pa.bool_(), "words": pa.binary(), "counts": pa.binary()}
    rows = map_arrow(chosen, numbers, "toxic boolean, words binary, counts binary", columns).collect()
    read = lambda x: np.frombuffer(bytes(x), np.int32).astype(np.int64)
    found = sorted((r["toxic"], bytes(r["words"]), bytes(r["counts"])) for r in rows)
    return fit(*([(read(w), read(n)) for toxic, w, n in found if toxic == kind] for kind in (True, False)), float(prior), used)


def toxicity(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row for each row of ``docs``.

    A null text counts as empty; an empty one has the score of the bias alone. A null doc_id is not held
    out. Repeated rows each count; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    memory: list[Features] = []

    def score(rows: dict) -> dict:
        weights, bias = shared.value
        if not memory:
            memory.append(Features(weights != 0))
        sums = np.full(len(rows["text"]), bias)
        for k, text in enumerate(rows["text"]):
            words, counts = memory[0](text)
            sums[k] += weights[words] @ np.log1p(counts)
        return {"doc_id": rows["doc_id"], "score": 0.5 + 0.5 * np.tanh(sums / 2)}

    scored = map_arrow(docs.select("doc_id", "text"), score, "doc_id long, score double", {"doc_id": pa.int64(), "score": pa.float64()})
    held = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
