"""Phrase collocations against SQL and a plain count."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from compare import connect, differences
from crawlframe.llm import collocations
from crawlframe.llm.catalog import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, n int, gram string, word string, chunk int, f int"


def frame(spark, rows):
    """Documents with extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(k, t, lang, 1, "g", "w", 2, 3) for k, (t, lang) in enumerate(rows)], SCHEMA)


def plain(rows, least=30, top=2000):
    counts, n = {}, Counter()
    for text, lang in rows:
        small = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", small):
            words = re.findall("[^ \t]+", piece)
            n["und" if lang is None else lang] += len(words)
            for size in range(1, 5):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in counts.items():
        frequent = {g: f for g, f in own.items() if len(g) > 1 and f >= least}
        held = Counter()
        for g, f in frequent.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    held[g[i : i + size]] = max(held[g[i : i + size]], f)
        found = []
        for g, a in frequent.items():
            if 100 * held[g] < 80 * a:
                score, _, left, right = min((2_000_000 * a // (own[g[:k]] + own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def run(spark, rows, **options):
    return sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), **options).collect())


def test_given_table_equals_sql(spark, sf):
    n, diff = differences(QUERIES["op12_collocations"](spark, sf), connect(sf), ORACLES["op12_collocations"])
    assert not diff and n > 0


@pytest.mark.parametrize("sizes", [{}, {"chunk": 2_000, "size": 300, "stride": 4}, {"chunk": 500, "size": 40, "stride": 1}])
def test_random_texts_in_chunks_and_ranges_of_any_size(spark, sizes):
    rng = random.Random(3)
    words = ["the", "The", "a", "of", "x", "é", "É", "ß", "日本", "it's", "a-b", "\x1f", "\xa0", "new", "york", "city", "k" * 40]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!", "?", ";", ":", " . "]
    rows = []
    for _ in range(700):
        text = "".join(rng.choice(words[: rng.choice((4, 17))]) + rng.choice(gaps) for _ in range(rng.randrange(40)))
        rows.append((rng.choice([text, text + " new york city", "of the new York city. " + text]), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    got = run(spark, rows, **sizes)
    assert got == plain(rows) and len(got) > 50


def test_ties_and_a_short_top(spark):
    rows = [(f"w{i} w{i + 1}", "en") for i in range(40)] * 30 + [("é z", "en"), ("z é", "en"), ("zz a", "en")] * 30
    assert run(spark, rows, top=25) == plain(rows, top=25)


def test_odd_rows(spark):
    rows = [(None, "en"), ("", "en"), (" \t ", None), ("...", "en"), ("a b " * 100_000, "fr"), ("a b c d e", "de")] + [("p q r", None)] * 30 + [("p q r", "und")] * 2
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == [] and run(spark, [("a b c", "en")]) == []


def test_a_pair_with_most_rows(spark):
    rows = [("hot pair " * 50, "en")] * 200 + [(f"hot pair u{i % 7} v{i % 3}", "en") for i in range(300)]
    assert run(spark, rows, chunk=3_000, size=20, stride=1) == plain(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, x, y = 9_000_000_000_000_001, 9_100_000_000_000_003, 9_200_000_000_000_001
    assert spark.range(1).select(collocations._score(F.lit(a), F.lit(x), F.lit(y))).first()[0] == 2_000_000 * a // (x + y)


def test_windows_stop_at_breaks():
    first, second = collocations.windows(np.array([1, 2, 3, 4, 5, 0, 6, 0, 7, 8]))
    got = [(a >> 32, a & 0xFFFFFFFF, b >> 32, b & 0xFFFFFFFF) for a, b in zip(first.tolist(), second.tolist(), strict=True)]
    assert got == [(1, 2, 3, 4), (2, 3, 4, 5), (3, 4, 5, 0), (4, 5, 0, 0), (7, 8, 0, 0)]
