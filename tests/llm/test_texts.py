"""Near-copies, line runs, leaks, perplexity and the pipeline against plain versions and edge cases."""

import random

import numpy as np
import pytest

import brute
from compare import connect, differences
from crawlframe.llm import decontaminate, linededup, quality, simhash
from crawlframe.llm.catalog import ORACLES, QUERIES
from crawlframe.llm.common import table

ODD = [(None, "a b c d"), (1, None), (2, ""), (3, " \n "), (4, "x"), (4, "x"), (5, "word " * 30_000), (6, "Tie one\nTie two"), (7, "Tie one\nTie two")]


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(d, t, "en", 1, 2, 3, 4) for d, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, fp int, print int, i int, n int")


def pairs(spark, sf, name="documents", key="doc_id"):
    return [(r[key], r["text"]) for r in table(spark, sf, name).select(key, "text").collect()]


def test_components_equal_brute_force(spark, sf):
    docs = pairs(spark, sf)
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.simhash_components(table(spark, sf, "documents")).collect()}
    found = brute.components([brute.fingerprint(t) for _, t in docs])
    first = {}
    for (d, _), c in zip(docs, found, strict=True):
        first[c] = min(first.get(c, d), d)
    assert got == {d: (brute.fingerprint(t), first[c]) for (d, t), c in zip(docs, found, strict=True)}


@pytest.mark.parametrize(("dense", "block"), [(2, 3), (10_000, 10_000)])
def test_links_at_every_distance(spark, dense, block):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = set(seeds)
    for s in seeds:
        for d in (1, 2, 3, 4, 5):
            for _ in range(12):
                x = s
                for b in rng.sample(range(64), d):
                    x ^= 1 << b
                prints.add(x)
    prints = sorted(prints)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    rows = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = [(r["a"], r["b"]) for r in simhash.links(rows, 3, dense, block).collect()]
    at = {x: i for i, x in enumerate(signed)}
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= 3
        parent[root(at[a])] = root(at[b])
    want = brute.components(prints)
    same = lambda labels: {frozenset(i for i, x in enumerate(labels) if x == c) for c in set(labels)}
    assert same([root(i) for i in range(len(prints))]) == same(want)


def test_near_copies_of_odd_rows(spark):
    docs = frame(spark, ODD)
    got = simhash.simhash_components(docs)
    assert got.count() == len(ODD)
    by_id = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[6] == by_id[7] == 6
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 4, 5, 6]
    empty = frame(spark, [])
    assert simhash.simhash_components(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_line_runs_equal_brute_force(spark, sf):
    docs = pairs(spark, sf)
    got = {r["doc_id"]: r["text"] for r in linededup.without_repeated_runs(table(spark, sf, "documents")).collect()}
    assert got == brute.without_runs(docs)
    assert any(got[d] != t for d, t in docs)


def test_line_runs_of_many_short_lines(spark):
    rng = random.Random(7)
    lines = [f"{rng.choice('abc')} {rng.choice('de')}" for _ in range(8)] + ["", "one", "long " * 12]
    docs = [(d, "\n".join(rng.choice(lines) for _ in range(rng.randrange(40)))) for d in range(60)]
    docs += [(100 + d, "\n".join(docs[d][1].split("\n")[d % 5 :])) for d in range(20)]
    got = {r["doc_id"]: r["text"] for r in linededup.without_repeated_runs(frame(spark, docs), 20).collect()}
    assert got == brute.without_runs(docs, 20)


def test_line_runs_of_odd_rows(spark):
    long = "\n".join(f"line {k} " + "w " * 30 for k in range(3))
    rows = [*ODD, (8, long), (8, long), (9, long + "\nmore"), (None, long)]
    got = linededup.without_repeated_runs(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in got:
        texts.setdefault(r["doc_id"], []).append(r["text"])
    # Without an id comes first; rows alike in id and text are one document.
    assert sorted(texts[None]) == sorted(["a b c d", long]) and texts[8] == ["", ""] and texts[9] == ["more"]
    assert texts[1] == [None] and texts[2] == [""]
    assert linededup.without_repeated_runs(frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    n, diff = differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name])
    assert not diff and n > 0


def test_leaks_equal_brute_force(spark, sf):
    docs, items = pairs(spark, sf), pairs(spark, sf, "benchmark", "item_id")
    for size in (1, 400, 10**6):
        got = decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"), block_words=size)
        assert sorted(map(tuple, got.collect())) == sorted(brute.leaks(docs, items))


def test_leaks_at_the_threshold(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(400)]
    items, docs = [], []
    for n in (1, 3, 4, 5, 6, 9, 14, 24, 60):
        items.append((n, " ".join(rng.choices(words, k=n))))
        for k in range(6):
            said = items[-1][1].split()
            for _ in range(k):
                said[rng.randrange(n)] = "changed"
            docs.append((10 * n + k, " ".join([*rng.choices(words, k=rng.choice([0, 3000])), *said, *rng.choices(words, k=rng.choice([0, 50]))])))
    schema = "item_id long, text string"
    got = decontaminate.leaks(frame(spark, docs), spark.createDataFrame([*items, (99, None), (98, "")], schema))
    assert sorted(map(tuple, got.collect())) == sorted(brute.leaks(docs, items))
    left = decontaminate.without_leaks(frame(spark, docs), spark.createDataFrame(items, schema))
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - {x[0] for x in brute.leaks(docs, items)}


def test_leaks_of_odd_rows(spark):
    items = spark.createDataFrame([(1, "tie one tie two"), (1, "tie one tie two"), (None, "x")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"] or -1) for r in decontaminate.leaks(frame(spark, ODD), items).collect())
    assert got == [(4, -1), (4, -1), (6, 1), (6, 1), (7, 1), (7, 1)]
    none = items.filter("item_id = 0")
    assert decontaminate.leaks(frame(spark, ODD), none).count() == 0 and decontaminate.without_leaks(frame(spark, ODD), none).count() == len(ODD)
    assert decontaminate.leaks(frame(spark, []), items).count() == 0 and decontaminate.without_leaks(frame(spark, []), items).count() == 0


def trusted_of(spark, sf):
    return {r["doc_id"] for r in table(spark, sf, "labels").filter("quality = 1").collect()}


@pytest.mark.parametrize("shard_grams", [250_000, 700])
def test_perplexity_equals_brute_force(spark, sf, shard_grams, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_GRAMS", shard_grams)
    monkeypatch.setattr(quality, "SALT_ROWS", 64 if shard_grams < 1000 else 32_768)
    monkeypatch.setattr(quality, "PACK_CHARS", 20_000 if shard_grams < 1000 else 1_000_000)
    docs, trusted = pairs(spark, sf), trusted_of(spark, sf)
    p = brute.kneser_ney([t for d, t in docs if d in trusted])
    got = {r["doc_id"]: r["log_ppl"] for r in quality.quality(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()}
    assert got.keys() == {d for d, _ in docs}
    for d, t in docs:
        assert got[d] == pytest.approx(brute.log_perplexity(t, p), abs=2e-4)


def test_probabilities_of_a_context_sum_to_one():
    p = brute.kneser_ney(["the cat sat on the mat", "the hat", "a cat"])
    chars = sorted(set("the cat sat on the mat hat a"))
    assert sum(p("th" + c) for c in [*chars, "?"]) == pytest.approx(1.0)


def test_quality_keeps_good_and_rejects_junk(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", x) for x in ("documents", "labels"))
    rows = quality.quality(docs, labels).join(labels, "doc_id").toPandas()
    assert rows[rows["quality"] == 1]["kept"].mean() > 0.99 and rows[rows["quality"] == 0]["kept"].mean() < 0.3


def test_quality_of_odd_rows(spark):
    docs, labels = frame(spark, ODD), spark.createDataFrame([(6, 1, 0), (6, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows}
    assert not by_id[1]["kept"] and by_id[1]["log_ppl"] is None and not by_id[2]["kept"] and by_id[6]["kept"]
    assert quality.keep_good(docs, labels).columns == docs.columns
    untrusted = quality.quality(docs, labels.filter("quality = 0")).collect()
    assert all(r["kept"] == bool(r["chars"]) for r in untrusted)
    assert quality.quality(frame(spark, []), labels).count() == 0


@pytest.mark.parametrize("shard_grams", [250_000, 10])
def test_repeated_rows_score_as_one(spark, shard_grams, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_GRAMS", shard_grams)
    monkeypatch.setattr(quality, "SALT_ROWS", 1_000)
    trusted = [(k, f"the cat number {k} sat on the mat and slept well") for k in range(1, 31)]
    labels = spark.createDataFrame([(k, 1, 0) for k, _ in trusted], "doc_id long, quality int, toxic int")
    near = "the mat sat well"
    scores = {}
    for times in (1, 1000):
        rows = quality.quality(frame(spark, trusted + [(90, near), (None, near)] * times), labels, slack=2.0).filter("doc_id is null or doc_id = 90").collect()
        assert len(rows) == 2 * times
        scores[times] = {(r["doc_id"], r["chars"], round(r["log_ppl"], 3), round(r["limit"], 3), r["kept"]) for r in rows}
    assert scores[1] == scores[1000] and {chars for _, chars, *_ in scores[1]} == {len(near)}


def test_text_print_is_the_sql_hash(spark):
    from pyspark.sql import functions as F

    texts = [None, "", "a", "héllo", "日本" * 40]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", F.xxhash64("t").alias("h")).collect()
    assert {r["k"]: r["h"] for r in got} == {k: quality.text_print(t) for k, t in enumerate(texts)}


def test_postings_with_many_characters():
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9FFF, 500))) for _ in range(40)] + ["", "\U0001f600ab"]
    gram, text, times = quality.postings(texts)
    want = {}
    for k, t in enumerate(texts):
        padded = [quality.BEGIN] * 2 + [ord(c) for c in t]
        for i in range(len(t)):
            a, b, c = padded[i : i + 3]
            want[(a << 42 | b << 21 | c, k)] = want.get((a << 42 | b << 21 | c, k), 0) + 1
    assert dict(zip(zip(gram.tolist(), text.tolist(), strict=True), times.tolist(), strict=True)) == want


def test_pipeline_equals_brute_force(spark, sf):
    import corpus_pipeline

    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table(spark, sf, "documents").collect()]
    kept = brute.kept_by_quality(rows, trusted_of(spark, sf), quality.SPREAD, quality.SLACK)
    docs = brute.without_runs([(d, t) for d, t, _ in rows if d in kept])
    docs = brute.keep_one(sorted(docs.items()))
    leaked = {x[0] for x in brute.leaks(docs, pairs(spark, sf, "benchmark", "item_id"))}
    want = {d: t for d, t in docs if d not in leaked}
    assert len(want) < len(rows)

    source = table(spark, sf, "documents")
    docs = source
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == source.columns
    assert {r["doc_id"]: r["decoded"] for r in corpus_pipeline.run(spark, sf).collect()} == want
