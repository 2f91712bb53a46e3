"""Plain versions of the text operators, for small tables."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash


# ---- SimHash


def fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=3):
    """Component number of each fingerprint in a list."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    own = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(own[i + 1 :] ^ own[i]) <= distance):
            parent[root(i)] = root(i + 1 + int(j))
    return [root(i) for i in range(len(prints))]


def keep_one(docs):
    """``docs``: (doc_id, text) with distinct ids."""
    found = components([fingerprint(t) for _, t in docs])
    first = {}
    for (doc_id, _), c in zip(docs, found, strict=True):
        first[c] = min(first.get(c, doc_id), doc_id)
    return [(d, t) for (d, t), c in zip(docs, found, strict=True) if first[c] == d]


# ---- repeated line runs


def without_runs(docs, min_words=50):
    """Texts by id after removal; every run of consecutive lines is looked at."""
    lines = {d: [(k, x) for k, x in enumerate(t.split("\n")) if x.strip(" ")] for d, t in docs if t is not None}
    first, runs = {}, []
    for d in sorted(lines):
        own = lines[d]
        words = [len(x.strip(" ")) - len(x.strip(" ").replace(" ", "")) + 1 for _, x in own]
        for i in range(len(own)):
            total = 0
            for j in range(i, len(own)):
                total += words[j]
                if total >= min_words:
                    key = tuple(x for _, x in own[i : j + 1])
                    runs.append((d, i, j, key))
                    first.setdefault(key, (d, i))
    gone = defaultdict(set)
    for d, i, j, key in runs:
        if first[key] != (d, i):
            gone[d].update(lines[d][k][0] for k in range(i, j + 1))
    return {d: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, t in docs}


# ---- benchmark leaks


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingle_set(text, width=5):
    words = words_of(text)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def leaks(docs, items, share=0.8):
    own = [(i, shingle_set(t)) for i, t in items]
    found = []
    for d, text in docs:
        have = shingle_set(text)
        for i, want in own:
            if want and len(want & have) >= share * len(want) - 1e-9:
                found.append((d, i, len(want & have), len(want)))
    return found


# ---- perplexity


def kneser_ney(trusted):
    """Function from (two characters before, character) to probability; texts are lists of characters."""
    begin = "\ufdd0"
    c3 = Counter()
    for text in trusted:
        padded = begin * 2 + text
        c3.update(padded[i : i + 3] for i in range(len(text)))
    c2 = Counter(g[1:] for g in c3)
    c1 = Counter(g[1:] for g in c2)

    def discounts(counts):
        n = [sum(1 for v in counts.values() if v == k) for k in range(1, 5)]
        if not all(n):
            return [0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]

    def order(counts, lower):
        d, total, given = discounts(counts), Counter(), Counter()
        for gram, v in counts.items():
            total[gram[:-1]] += v
            given[gram[:-1]] += d[min(v, 3) - 1]

        def p(gram):
            context = gram[:-1]
            if not total[context]:
                return lower(gram[1:])
            v = counts.get(gram, 0)
            return (v - d[min(v, 3) - 1] if v else 0.0) / total[context] + given[context] / total[context] * lower(gram[1:])

        return p

    return order(c3, order(c2, order(c1, lambda gram: 1 / (len(c1) + 1))))


def log_perplexity(text, p):
    padded = "\ufdd0" * 2 + text
    return round(-sum(math.log(p(padded[i : i + 3])) for i in range(len(text))) / len(text), 4) if text else None


def kept_by_quality(rows, trusted, spread, slack, least=20):
    """``rows``: (doc_id, text, lang); ids of those kept."""
    p = kneser_ney([t for d, t, _ in rows if d in trusted])
    scores = {d: log_perplexity(t, p) for d, t, _ in rows}

    def limit(values):
        median, high = np.percentile(values, [50, 95])
        return median + spread * (high - median)

    by_lang = defaultdict(list)
    for d, _, lang in rows:
        if d in trusted and scores[d] is not None:
            by_lang[lang].append(scores[d])
    common = limit([v for vs in by_lang.values() for v in vs])
    limits = {lang: limit(vs) for lang, vs in by_lang.items() if len(vs) >= least}
    return {d for d, t, lang in rows if scores[d] is not None and scores[d] <= limits.get(lang, common) + slack / math.sqrt(len(t))}
