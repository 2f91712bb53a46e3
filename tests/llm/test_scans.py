"""Secrets, identifiers, licences, toxicity, pieces and vectors against plain versions and edge cases."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from crawlframe.llm import identifiers, licences, pieces, secrets, toxicity, vectors
from crawlframe.llm.automaton import Automaton
from crawlframe.llm.catalog import QUERIES
from crawlframe.llm.common import table


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], "doc_id long, text string, print int, spans string, score int")


def texts_of(spark, sf):
    return {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").select("doc_id", "text").collect()}


def said(spans, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


ODD = [(None, "x 1.2.3.4"), (1, None), (2, ""), (3, "token = abcdefghij"), (3, "token = abcdefghij"), (4, "\n" * 50_000), (5, "a1" * 40_000), (6, "7" * 30_000)]


# ---- secrets

ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


def test_secrets_equal_brute_force(spark, sf):
    texts = texts_of(spark, sf)
    rows = QUERIES["op10_secrets"](spark, sf).collect()
    assert {r["doc_id"] for r in rows} == texts.keys()
    for r in rows:
        want = said(base_secrets(texts[r["doc_id"]]), ["assign", "access", "hex"])
        assert r["spans"] == want and r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def test_secrets_in_random_texts():
    rng = random.Random(1)
    parts = ["password", "Token", "API_KEY", "apikey", "secret", "=", ":", " ", '"', "'", "abcdef12", "AKIA", "AB12", "deadbeef", "\n", "é", "x", "ghp_", ".", "-", "日本", ",", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(5000)]
    rules = secrets.compiled_rules()
    for text, spans in zip(texts, secrets.find_secrets(texts, rules), strict=True):
        assert [s for s in spans if s[1] < secrets.BASE] == base_secrets(text)
    extra = "key ghp_" + "a1B2" * 9 + " and\n-----BEGIN RSA PRIVATE KEY-----"
    assert [secrets.RULES[k][0] for _, k, _ in secrets.find_secrets([extra], rules)[0]] == ["github", "pem"]


def test_secrets_of_odd_rows(spark):
    rows = secrets.secrets(frame(spark, ODD)).collect()
    assert len(rows) == len(ODD) and secrets.secrets(frame(spark, [])).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["spans"] == "" == by_id[2]["spans"] and by_id[3]["spans"] == "assign:0:18"
    assert by_id[1]["base_sha256"] == hashlib.sha256(b"").hexdigest() and by_id[6]["n_hex"] == 1


@pytest.mark.parametrize("rule", [rb"ab+c?", rb"(?:a|b){2,3}", rb"[^a]b{3,}", rb"(?i:ab)*c", rb"a.c"])
def test_automaton_equals_the_regex(rule):
    own = Automaton([rule], anywhere=False)
    for n in range(6):
        for chars in itertools.product(b"abc\n", repeat=n):
            data = bytes(chars)
            ends = [e for e in range(1, n + 1) if re.fullmatch(rule, data[:e])]
            assert own.longest(data, 0, n) == max(ends, default=-1)


def test_automaton_scan_does_not_depend_on_lanes():
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer(b"ab,", np.uint8), 5000)
    both = Automaton([rb"ab", rb"b{3,}"])
    want = [sorted(zip(*(x.tolist() for x in both.scan(data, lanes)), strict=True)) for lanes in (1, 7, 4096)]
    assert want[0] == want[1] == want[2] and want[0]


# ---- identifiers


def luhn(digits):
    return sum(int(c) * (1 + k % 2) - 9 * (int(c) * (1 + k % 2) > 9) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_identifiers(text):
    text = text or ""
    digits = lambda x: re.sub("[^0-9]", "", x)
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return sorted(found + [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15])


def check_identifiers(rows, texts):
    for r in rows:
        want = said(base_identifiers(texts[r["doc_id"]]), identifiers.KINDS)
        assert ",".join(s for s in r["spans"].split(",") if not s.startswith("context")) == want
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()


def test_identifiers_equal_brute_force(spark, sf):
    texts = texts_of(spark, sf)
    rows = QUERIES["op5_identifiers"](spark, sf).collect()
    assert {r["doc_id"] for r in rows} == texts.keys()
    check_identifiers(rows, texts)


def test_identifiers_in_random_texts(spark):
    rng = random.Random(3)
    parts = ["a@b.co", "x.y", "@", ".", "1.2.3.4", "999.1.1.1", "4111111111111111", "4111 1111 1111 1111", "-", " ", "+1 (017) 555-7713", "+", "0", "12", "é", "日本", "\n", "00255.0.0.1", "_", "%", "(", ")", "𝒳"]
    texts = {i: "".join(rng.choice(parts) for _ in range(rng.randrange(25))) for i in range(2000)}
    rows = identifiers.identifiers(frame(spark, texts.items())).collect()
    assert len(rows) == len(texts)
    check_identifiers(rows, texts)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    known = [(i, f"please write visitor badge {i}0.2.3.4 thanks all") for i in range(20)]
    unseen = [(100 + i, f"please write visitor badge ZX{i}83{i}77 thanks all") for i in range(8)]
    other = [(200 + i, f"in the year {1900 + i} it rained") for i in range(30)]
    rows = {r["doc_id"]: r for r in identifiers.identifiers(frame(spark, known + unseen + other)).collect()}
    assert all(rows[100 + i]["n_context"] == 1 and rows[100 + i]["spans"] == f"context:27:{27 + len(f'ZX{i}83{i}77')}" for i in range(8))
    assert not any(rows[i]["n_context"] for i in range(20)) and not any(rows[200 + i]["n_context"] for i in range(30))


def test_identifiers_of_odd_rows(spark):
    rows = identifiers.identifiers(frame(spark, ODD)).collect()
    assert len(rows) == len(ODD) and identifiers.identifiers(frame(spark, [])).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[None]["spans"] == "ip:2:9" and by_id[1]["spans"] == "" == by_id[2]["spans"]


# ---- licences


def test_licences_equal_brute_force(spark, sf):
    want = []
    for doc_id, text in texts_of(spark, sf).items():
        lines, begin = text.split("\n"), 0
        blocks = [("line", k, k) for k, x in enumerate(lines) if x.strip()]
        for k in range(len(lines) + 1):
            if k == len(lines) or not lines[k].strip():
                blocks += [("paragraph", begin, k - 1)] if k - begin > 1 else []
                begin = k + 1
        for unit, first, last in blocks:
            own = licences.bigrams("\n".join(lines[first : last + 1]))
            dice = [(-2 * len(own & t) / (len(own) + len(t)), name) for name, t in ((n, licences.bigrams(x)) for n, x in licences.TEMPLATES)]
            if -min(dice)[0] >= 0.8:
                want.append((doc_id, unit, first, last, min(dice)[1], round(-min(dice)[0], 6)))
    got = [tuple(r) for r in QUERIES["op7_licences"](spark, sf).collect()]
    assert sorted(got) == sorted(want) and want


def test_licences_of_odd_rows(spark):
    notice = "x\n\nPermission is\nhereby GRANTED"
    rows = [*ODD, (7, notice), (7, notice), (8, "Released, under the (MIT) license!"), (9, "mit")]
    found = licences.licences(frame(spark, rows), [("MIT", "Released under the MIT License."), ("A", "permission is hereby granted"), ("B", "permission is hereby granted")])
    assert sorted(tuple(r) for r in found.collect()) == [(7, "paragraph", 2, 3, "A", 1.0)] * 2 + [(8, "line", 0, 0, "MIT", 1.0)]
    assert licences.licences(frame(spark, rows), []).count() == 0 and licences.licences(frame(spark, [])).count() == 0


def test_notices_laid_out_otherwise(spark):
    whole = dict(licences.all_templates()[-len(list(licences.Path(licences.__file__).parent.glob("licence_texts/*.txt"))) :])
    mit = "MIT License Copyright (c) 2020 Some Body " + " ".join(whole["MIT"].split())
    header = licences.TEMPLATES[1][1].replace(" http://www.apache.org/licenses/LICENSE-2.0 ", "\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n")
    rows = [(1, header), (2, mit), (3, "invented words " * 40 + "Released under the MIT License. " + "and other words " * 40), (4, whole["GPL-3.0"]), (5, "the words of the author of the text in the same " * 500)]
    found = {(r["doc_id"], r["unit"], r["licence"]) for r in licences.licences(frame(spark, rows)).collect()}
    assert {(1, "window", "Apache-2.0"), (3, "window", "MIT"), (4, "window", "GPL-3.0")} <= found
    assert any(doc_id == 2 and licence == "MIT" for doc_id, _, licence in found)
    assert not any(doc_id == 5 for doc_id, _, _ in found)


def test_windows_equal_brute_force():
    rng = random.Random(4)
    for least in (0.6, 0.8):
        for _ in range(60):
            template, words = " ".join(rng.choices("abcde", k=9)), rng.choices("abcdefg", k=40)
            theirs = licences.bigrams(template)
            dice = {}
            for a, z in itertools.combinations(range(40), 2):
                own = licences.bigrams(" ".join(words[a : z + 1]))
                dice[a, z] = 2 * len(own & theirs) / (len(own) + len(theirs))
            got = licences.Matcher([("T", template)], least).windows(words)
            best = max(dice.values())
            assert (best >= least - 1e-9) == bool(got)
            assert not got or got[0][0] == pytest.approx(best)
            assert all(d == pytest.approx(dice[a, z]) for d, _, a, z in got)
            # Nothing at or over the limit is left beside the windows that were given.
            taken = {k for _, _, a, z in got for k in range(a, z + 1)}
            assert all(d < least - 1e-9 or taken.intersection(range(a, z + 1)) for (a, z), d in dice.items())


# ---- toxicity


def auc(rows):
    good, bad = rows[rows["toxic"] == 0]["score"].to_numpy(), rows[rows["toxic"] == 1]["score"].to_numpy()
    return ((bad[:, None] > good).mean() + 0.5 * (bad[:, None] == good).mean()) if len(good) and len(bad) else math.nan


def test_toxicity_of_held_out_texts(spark):
    big = "/root/testdata/sf0.1"
    rows = QUERIES["op3_toxicity"](spark, big).join(table(spark, big, "labels"), "doc_id").toPandas()
    held = rows[rows["held_out"]]
    assert auc(held) > 0.92 and held[held["toxic"] == 0]["predicted"].mean() < 0.03
    assert ((rows["score"] >= 0.5).astype(int) == rows["predicted"]).all() and rows["score"].between(0, 1).all()


def test_held_out_labels_are_not_learned(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    (w1, b1), (w2, b2) = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert np.array_equal(w1, w2) and b1 == b2


def test_risk_estimate_is_not_negative():
    """With many features for few positives the clean part would go far below zero; scores stay bounded."""
    rng = np.random.default_rng(0)
    row = lambda: (np.unique(rng.integers(0, 300, 20)), np.ones(300, np.int64))
    make = lambda n: [(x, c[: len(x)]) for x, c in (row() for _ in range(n))]
    weights, bias = toxicity.fit(make(10), make(200), 0.3, np.arange(300))
    assert np.isfinite(weights).all() and np.abs(weights).max() < 20 and np.isfinite(bias)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 1), (3, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = frame(spark, ODD)
    rows = toxicity.toxicity(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    empty = toxicity.toxicity(docs, toxicity.train(docs, labels.filter("toxic = 5")))
    assert empty.count() == len(ODD) and toxicity.toxicity(frame(spark, []), toxicity.train(frame(spark, []), labels)).count() == 0


# ---- pieces

STRANGE = ["", None, " ", "  a  b ", "▁ x ▁▁", "日本語 \n\t é", "a" * 5000, "\x00\x01", " \n ", "ﷺ 𝒳 \U0001f600", "x" + " " * 40 + "y", "<0x41> <s> </s>"]


def test_decoding_gives_back_every_text(spark, sf):
    texts = texts_of(spark, sf)
    rows = pieces.sample_pieces(table(spark, sf, "documents")).collect()
    assert {r["doc_id"]: r["decoded"] for r in rows} == texts and all(len(r["ids"]) == r["n_pieces"] for r in rows)
    docs = frame(spark, list(enumerate(STRANGE)) + [(None, "no key"), (3, STRANGE[3])])
    rows = pieces.sample_pieces(docs).collect()
    assert len(rows) == len(STRANGE) + 2 and pieces.sample_pieces(frame(spark, [])).count() == 0
    for r in rows:
        assert r["decoded"] == ("no key" if r["doc_id"] is None else STRANGE[r["doc_id"]])
    assert len({tuple(r["ids"]) for r in rows if r["doc_id"] == 3}) == 1 and {r["n_pieces"] for r in rows if r["doc_id"] == 0} == {0}


def test_sampling_follows_the_row_key_alone(spark, sf):
    docs = table(spark, sf, "documents")
    first = {r["doc_id"]: r["ids"] for r in pieces.sample_pieces(docs).collect()}
    assert first == {r["doc_id"]: r["ids"] for r in pieces.sample_pieces(docs.repartition(7, "text")).collect()}
    assert first != {r["doc_id"]: r["ids"] for r in pieces.sample_pieces(docs, seed=1).collect()}


def test_samples_have_the_weights_of_the_lattice():
    vocab, word, n = pieces.vocabulary(pieces.MODEL), "▁nation", 40_000
    weights = {}

    def split(rest, ids, score):
        if not rest:
            weights[tuple(ids)] = math.exp(score)
            return
        for size in range(1, len(rest) + 1):
            if rest[:size] in at:
                split(rest[size:], [*ids, at[rest[:size]]], score + vocab.scores[at[rest[:size]]])

    at = {p: i for i, p in enumerate(vocab.pieces)}
    split(word, [], 0.0)
    drawn = pieces.encode(["nation"] * n, list(range(n)), vocab)
    total = sum(weights.values())
    for ids, weight in weights.items():
        if weight / total >= 0.002:
            share = sum(tuple(d) == ids for d in drawn) / n
            assert share == pytest.approx(weight / total, abs=4 * math.sqrt(weight / total / n))


# ---- vectors


@pytest.mark.parametrize("sf_name", ["sf0.001", "sf0.1"])
def test_recall(spark, sf_name):
    rows = table(spark, f"/root/testdata/{sf_name}", "embeddings")
    found = QUERIES["op2_neighbours"](spark, f"/root/testdata/{sf_name}")
    assert vectors.recall(found, rows, F.col("vec_id") % 20 == 0) >= 0.9
    assert found.groupBy("query_id").count().filter("count <> 20").count() == 0


def test_probes_find_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((3000, 16))
    coder = vectors.Coder(vectors.learn_rotations(np.column_stack([rows[:500], np.ones(500)]), 4), float(np.linalg.norm(rows, axis=1).max()))
    block, codes = vectors.Block(np.arange(3000), rows, coder), coder.substrings(rows, False)
    for query in coder.substrings(rows[:40], True):
        for radius in (0, 1, 2):
            distance = np.bitwise_count(codes ^ query).sum(axis=1)
            within = np.flatnonzero(distance <= len(query) * (radius + 1) - 1)
            assert set(within) <= set(block.candidates(query, vectors._masks(radius)))


def test_neighbours_of_odd_rows(spark):
    plain = [(k, [float(k % 3), 1.0], k) for k in range(1, 41)]
    odd = [(60, None, 1), (80, [], 1), (100, [0.0, 0.0], 1), (120, [None, 1.0], 1), (140, [float("nan"), 1.0], 1), (160, [float("inf"), 1.0], 1), (180, [1.0], 1), (None, [1.0, 1.0], 1), (20, [2.0, 1.0], 9)]
    rows = spark.createDataFrame(plain + odd, "vec_id long, embedding array<float>, rank int")
    found = vectors.search(rows, F.col("vec_id") % 20 == 0, k=5, row_block=16, query_block=1).collect()
    assert {r["query_id"] for r in found} == {20, 40}
    for q in (20, 40):
        mine = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        own = [float(q % 3), 1.0]
        want = sorted((-(v[0] * own[0] + v[1] * own[1]), k) for k, v, _ in plain if k != q)[:5]
        assert [(-r["score"], r["vec_id"]) for r in mine] == want and [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
    assert vectors.search(rows.filter("vec_id in (20, 21)"), F.col("vec_id") % 20 == 0, k=5).count() == 1
    assert vectors.search(rows.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("spread", [0.0, 0.3])
def test_recall_with_unequal_lengths_and_one_long_row(spark, spread):
    rng = np.random.default_rng(7)
    rows = rng.standard_normal((20_000, 64))
    rows *= np.exp(spread * rng.standard_normal((20_000, 1))) / np.linalg.norm(rows, axis=1, keepdims=True)
    rows[11] *= 2 * np.linalg.norm(rows, axis=1).max() / np.linalg.norm(rows[11])
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(20_000), "embedding": rows.tolist()}))
    found = vectors.search(frame, F.col("vec_id") % 200 == 0, k=20)
    assert vectors.recall(found, frame, F.col("vec_id") % 200 == 0) >= 0.9


def test_classes_of_length_spare_rows():
    rng = np.random.default_rng(8)
    rows = rng.standard_normal((20_000, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    rows[11] *= 50
    coder = vectors.fit_sample(rows[:4096])
    held = vectors.Classes(np.arange(20_000), rows, coder)
    hits = 0
    for k, own in enumerate(coder.substrings(rows[100:140], True), 100):
        scores = rows @ rows[k]
        scores[k] = -np.inf
        hits += len(set(np.argsort(-scores)[:20]) & set(held.nearest(k, rows[k], own, 20, vectors.RADIUS)[0]))
    assert hits / 800 >= 0.9 and held.looked <= 0.5 * 40 * 20_000
