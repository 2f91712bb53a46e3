"""Identifiers by contexts: the graph against a plain version, planted rows of every kind, ordinary texts."""

import random
import re

import pytest

from crawlframe.llm import identifiers
from crawlframe.llm.catalog import QUERIES
from crawlframe.llm.common import table
from test_scans import base_identifiers, frame, texts_of

KINDS = identifiers.KINDS


def shape(text):
    return re.sub("[0-9]+", "0", text).lower()


def looks(text):
    text = re.sub("[0-9]+", "0", text)
    return re.sub("[A-ZÀ-ÖØ-Þ]+", "A", re.sub("[a-zß-öø-ÿ]+", "a", text))


def plain(docs, least=3, accept=0.6):
    """Context spans by row number. Words are few and short, so no context is cut off."""
    seeds, words, taken = set(), {}, {}
    for n, (_, text) in enumerate(docs):
        words[n] = [(m.start(), m.end()) for m in re.finditer(r"[^ \t\n\x0b\f\r]+", text or "")]
        taken[n] = []
        for a, kind, b in base_identifiers(text):
            before = [shape(text[x:y]) for x, y in words[n] if y < a]
            if before and not text[before and max(y for _, y in words[n] if y < a) : a].strip():
                glued = any(x < a < y or x < a == y for x, y in words[n])
            else:
                glued = True
            follows = re.match(r"[!-/:-@\[-`{-~]*\s+(\S+)(?:\s|\Z)", text[b:])
            if not glued:
                keys = [f"2|{before[-2]} {before[-1]}"] if len(before) > 1 else []
                keys += [f"1|{before[-1]} {shape(follows[1])}"] if follows else []
                seeds |= {(KINDS[kind], k, text[a:b]) for k in keys}
            taken[n] += [k for k, (x, y) in enumerate(words[n]) if x < b and a < y]
    patterns = {(kind, key) for kind, key, _ in seeds if len({i for q, k, i in seeds if (q, k) == (kind, key)}) >= least}
    kinds_of = {}
    for kind, key in patterns:
        kinds_of.setdefault(key, []).append(kind)
    places = {}
    for n, (_, text) in enumerate(docs):
        own = [text[x:y] for x, y in words[n]]
        for i in range(len(own)):
            found = [(1, f"2|{shape(own[i - 1])} {shape(own[i])}")] if 0 < i < len(own) - 1 else []
            found += [(r, f"1|{shape(own[i])} {shape(own[i + r + 1])}") for r in range(1, identifiers.RUN + 1) if i + r + 1 < len(own)]
            for run, key in found:
                said = re.sub("[.,;:!?]+$", "", " ".join(own[i + 1 : i + 1 + run]))
                if said and not set(range(i + 1, i + 1 + run)) & set(taken[n]):
                    for kind in kinds_of.get(key, []):
                        places.setdefault((n, i + 1, kind, key), (run, said))
    pairs = {(k, key, i): (1, 1) for k, key, i in seeds if (k, key) in patterns}
    known = {(k, looks(i)) for k, _, i in seeds}
    for (_, _, kind, key), (_, said) in places.items():
        pairs.setdefault((kind, key, said), (0, int((kind, looks(said)) in known)))
    belief = {}
    for (kind, _, i), (seed, _) in pairs.items():
        belief[kind, i] = max(belief.get((kind, i), 0.0), float(seed))
    while True:
        score = {}
        for kind, key in {(k, q) for k, q, _ in pairs}:
            held = [belief[kind, i] for k, q, i in pairs if (k, q) == (kind, key)]
            s = sum(held) / (len(held) + 1)
            if sum(b > 0 for b in held) >= least and s >= accept:
                score[kind, key] = s
        new = dict.fromkeys(belief, 0.0)
        for (kind, key, i), (seed, like) in pairs.items():
            best = score.get((kind, key), 0) * 0.9 + like * 0.1 if (kind, key) in score else 0
            new[kind, i] = max(new[kind, i], 1.0 if seed else best if best >= accept else 0.0)
        if new == belief:
            break
        belief = new
    seeded = {(k, i) for (k, _, i), (s, _) in pairs.items() if s}
    out = {n: set() for n in range(len(docs))}
    for (n, at, kind, key), (run, said) in places.items():
        if (kind, key) in score and belief[kind, said] > 0 and (kind, said) not in seeded:
            text, a = docs[n][1], words[n][at][0]
            raw = text[a : words[n][at + run - 1][1]]
            out[n].add((a, a + len(re.sub("[.,;:!?]+$", "", raw))))
    return {n: sorted(s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans)) for n, spans in out.items()}


def contexts(rows):
    return {r["doc_id"]: [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("context")] for r in rows}


def planted():
    """Seeds and unseen identifiers of every kind in contexts of their own: handles, names, spaced numbers, addresses."""
    said = []
    for i in range(30):
        said += [f"please mail to user u{i}@x{i}.org about it", f"from the machine host 10.{i}.2.{i + 3} came traffic", f"customer can be reached phone +1 (555) 010-{1000 + i} after noon"]
        said += [f"paid with credit card {card(i)} last week"]
    unseen = {
        "please mail to user {} about it": ["jdoe_x", "maria", "k.lopez", "webmaster at example org"],
        "from the machine host {} came traffic": ["srv-07", "fe80::1", "gateway"],
        "customer can be reached phone {} after noon": ["(523) 555-1055", "555 10 55", "0049 30 1234"],
        "paid with credit card {} last week": ["XXXX-1234", "ending in 77"],
    }
    hidden = [(text.format(x), x) for text, values in unseen.items() for x in values]
    return said, hidden


def card(i):
    body = f"4{i:03d}55512340000"
    return next(body + str(c) for c in range(10) if luhn_ok(body + str(c)))


def luhn_ok(digits):
    return sum(int(c) * (1 + k % 2) - 9 * (int(c) * (1 + k % 2) > 9) for k, c in enumerate(reversed(digits))) % 10 == 0


def test_planted_identifiers_of_every_kind(spark):
    said, hidden = planted()
    clean = ["please write to the office about it", "the host of a show was late", "a phone rang in the afternoon", "nothing was paid last week"] * 5
    docs = [(i, t) for i, t in enumerate(said + [t for t, _ in hidden] + clean)]
    got = contexts(identifiers.identifiers(frame(spark, docs)).collect())
    for k, (text, value) in enumerate(hidden):
        start = text.index(value)
        assert got[len(said) + k] == [(start, start + len(value))], text
    assert not any(got[i] for i, _ in docs[: len(said)] + docs[len(said) + len(hidden) :])
    assert {i: s for i, s in got.items()} == plain(docs)


def test_belief_goes_on_to_further_patterns(spark):
    """Names found after one pair of words make another pair believed, which has seeds of its own but too few alone."""
    first = [(f"my login name a{i}@b.org today", None) for i in range(40)] + [(f"my login name nick{chr(97 + i)} today", None) for i in range(6)]
    second = [(f"known here as a{i}@b.org since", None) for i in range(6)] + [(f"known here as nick{chr(97 + i)} since", None) for i in range(6)] + [("known here as zorro since", None)]
    docs = [(i, t) for i, (t, _) in enumerate(first + second)]
    got = contexts(identifiers.identifiers(frame(spark, docs)).collect())
    assert got == plain(docs) and got[len(docs) - 1] == [(14, 19)]


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_equals_a_plain_version(spark, seed):
    rng = random.Random(seed)
    words = ["the", "of", "id", "Id", "call", "mail", "x9", "now,", "so.", "é"]
    values = ["a@b.co", "q@r.org", "z1@y.net", "1.2.3.4", "+1 (017) 555-7713", "9.8.7.6", "5.5.5.5", "jdoe", "B-77", "n n"]
    docs = []
    for i in range(150):
        parts = [rng.choice(values if rng.random() < 0.3 else words) for _ in range(rng.randint(3, 12))]
        docs.append((i, rng.choice(["", " "]) + rng.choice([" ", "  ", "\n"]).join(parts)))
    assert contexts(identifiers.identifiers(frame(spark, docs), accept=0.4).collect()) == plain(docs, accept=0.4)


def test_given_table_equals_a_plain_version(spark, sf):
    texts = texts_of(spark, sf)
    docs = sorted(texts.items())
    got = contexts(QUERIES["op5_identifiers"](spark, sf).collect())
    assert {n: got[d] for n, (d, _) in enumerate(docs)} == plain(docs)
    assert table(spark, sf, "documents").count() == len(got)
