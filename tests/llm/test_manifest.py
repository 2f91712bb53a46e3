"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from crawlframe.llm import manifest
from crawlframe.llm.catalog import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, g string, h string, path int, spread int"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, add=0):
    values = (row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + add, row["text"])
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The root, and for each node the siblings on its way with whether it stands left."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            paths[i].append((nodes[a ^ 1] if a ^ 1 < len(nodes) else "", a % 2 == 0))
            at[i] = a // 2
        nodes = [H("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def plain(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    owns = [sorted((r for r in rows if r["lang"] == x), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for x in langs]
    trees = [climb([leaf(r) for r in own]) for own in owns]
    root, ups = climb([t[0] for t in trees]) if trees else ("", [])
    out = []
    for own, (sub, paths), up in zip(owns, trees, ups, strict=True):
        for r, path in zip(own, paths, strict=True):
            marked = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = leaf(r, 1 if marked else 0)
            for sibling, left in path + up:
                folded = H(folded + sibling if left else sibling + folded)
            out.append((r["doc_id"], leaf(r), sub, root, folded, H("".join(s for s, _ in path + up)), folded == root))
    return sorted(out, key=repr)


@pytest.fixture
def query(spark, tmp_path):
    def run(rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return sorted((tuple(r) for r in QUERIES["op11_manifest"](spark, str(tmp_path)).collect()), key=repr)

    return run


def row(doc_id, lang, text="t", n_chars=1, source="s"):
    return {"doc_id": doc_id, "text": text, "lang": lang, "source": source, "n_chars": n_chars, "pos": 9, "g": "x", "h": "y", "path": 3, "spread": 4}


def test_given_table_equals_sql(spark, sf):
    n, diff = differences(QUERIES["op11_manifest"](spark, sf), connect(sf), ORACLES["op11_manifest"])
    assert not diff and n > 0


def test_sizes_around_powers_and_blocks(query):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 255, "e": 256, "f": 257, "é": 513, None: 5, "": 4, "z" * 300: 7}
    rows = [row(i * 3, lang, f"{lang} {i} ü", i) for lang, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    assert query(rows) == plain(rows)


def test_three_rounds_of_one_group(query):
    rows = [row(i, "en") for i in range(66_000)]
    got = query(rows)
    assert len(got) == len(rows) and len({r[3] for r in got}) == 1
    assert got == plain(rows)


def test_nulls_repeats_and_odd_texts(query):
    rows = [row(None, None, None, None, None), row(None, "en"), row(5, "en", "", 0), row(5, "en", "", 0), row(5, "en", "other"), row(7, None, "x" * 100_000, 2**63 - 1)]
    rows += [row(i, None, None, None) for i in range(20)] + [row(1, "en", "same")] * 300
    got = query(rows)
    assert got == plain(rows)


def test_one_row_is_its_own_root(query):
    got = query([row(1, "en")])
    assert got == plain([row(1, "en")]) and got[0][1] == got[0][2] == got[0][3] and got[0][5] == H("")


def test_empty_table(query):
    assert query([]) == []


def test_only_changed_rows_with_a_count_fail(spark):
    docs = spark.createDataFrame([row(i, "en", n_chars=None if i % 2 else 1) for i in range(40)], SCHEMA)
    rows = manifest.manifest(docs, changed=F.lit(True))
    rows = rows.withColumn("ok", manifest.folded(F.col("altered"), F.col("path"), F.col("group_path")) == F.col("root"))
    assert {(r["doc_id"] % 2, r["ok"]) for r in rows.collect()} == {(0, False), (1, True)}
