"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.llm import collocations, decontaminate, extraction, identifiers, licences, linededup, manifest, pieces, quality, secrets, simhash, toxicity, vectors
from crawlframe.llm.common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.sample_pieces(table(spark, sf_dir, "documents"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.identifiers(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("print")


def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.without_repeated_runs(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = manifest.manifest(table(spark, sf_dir, "documents"), changed=marked)
    paths, said = (F.col("path"), F.col("group_path")), manifest.hex_text
    rows = rows.withColumn("folded", manifest.folded(F.col("altered"), *paths))
    digests = [said(F.col(c)).alias(n) for c, n in (("leaf", "leaf"), ("subroot", "subroot"), ("root", "root"), ("folded", "folded_root"))]
    return rows.select("doc_id", *digests, manifest.proof_digest(*paths).alias("proof_sha256"), (F.col("folded") == F.col("root")).alias("verified"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(pages))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_neighbours, op3_toxicity, op4_decontaminate, op5_identifiers,
        op6_simhash, op7_licences, op8_quality, op9_linededup, op10_secrets,
        op11_manifest, op12_collocations, op13_extraction,
    )
}

def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_WORDS = "regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')"
_BIGRAMS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"

ORACLES: dict[str, str] = {
    "op4_decontaminate": """
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents),
ds AS (SELECT DISTINCT row, doc_id, unnest(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) > 0),
b AS (SELECT row_number() OVER () AS brow, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
bs AS (SELECT DISTINCT brow, item_id, unnest(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b WHERE len(w) > 0),
n AS (SELECT brow, count(*) AS shingles FROM bs GROUP BY brow)
SELECT doc_id, item_id, CAST(count(*) AS INTEGER) AS held, CAST(any_value(shingles) AS INTEGER) AS shingles
FROM ds JOIN bs USING (s) JOIN n USING (brow) GROUP BY row, doc_id, brow, item_id HAVING count(*) >= 0.8 * any_value(shingles) - 1e-9""",
    "op7_licences": f"""
WITH t(licence, notice) AS (VALUES {", ".join(f"({_text(name)}, {_text(notice)})" for name, notice in licences.TEMPLATES)}),
n AS (SELECT t, licence, {_BIGRAMS} AS b FROM (SELECT row_number() OVER () AS t, licence, {_WORDS.format(text="notice")} AS w FROM t) q),
tb AS (SELECT t, unnest(b) AS b FROM n),
d AS (SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS raw FROM documents WHERE text IS NOT NULL),
x AS (SELECT r, doc_id, raw, unnest(range(1, len(raw) + 1)) AS k FROM d),
y AS (SELECT r, doc_id, k - 1 AS k, raw[k] AS line FROM x WHERE regexp_matches(raw[k], '\\S')),
g AS (SELECT *, k - row_number() OVER (PARTITION BY r ORDER BY k) AS block FROM y),
p AS (SELECT r, doc_id, min(k) AS a, max(k) AS z, string_agg(line, chr(10) ORDER BY k) AS said FROM g GROUP BY r, doc_id, block HAVING count(*) > 1),
u AS (SELECT row_number() OVER () AS u, * FROM (SELECT doc_id, 'line' AS unit, k AS a, k AS z, line AS said FROM y
  UNION ALL SELECT doc_id, 'paragraph', a, z, said FROM p) q),
ub AS (SELECT u, doc_id, unit, a, z, {_BIGRAMS} AS b FROM (SELECT *, {_WORDS.format(text="said")} AS w FROM u) q),
e AS (SELECT u, len(b) AS size, unnest(b) AS b FROM ub),
m AS (SELECT u, t, 2.0 * count(*) / (any_value(size) + any_value(len(n.b))) AS dice FROM e JOIN tb USING (b) JOIN n USING (t) GROUP BY u, t),
best AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY dice DESC, licence) AS k FROM m JOIN n USING (t) WHERE dice >= 0.8 - 1e-9)
SELECT doc_id, unit, CAST(a AS INTEGER) AS first_line, CAST(z AS INTEGER) AS last_line, licence, CAST(round(dice, 6) AS DOUBLE) AS dice
FROM best JOIN ub USING (u) WHERE k = 1""",
    "op9_linededup": """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS raw FROM documents),
n AS (SELECT *, list_filter(range(1, len(raw) + 1), lambda k: trim(raw[k], ' ') <> '') AS pos FROM d),
l AS (SELECT *, list_transform(pos, lambda k: length(trim(raw[k], ' ')) - length(replace(trim(raw[k], ' '), ' ', '')) + 1) AS w FROM n),
i AS (SELECT *, unnest(range(1, len(pos) + 1)) AS i FROM l),
s AS (SELECT *, unnest(range(1, least(50, len(pos) - i + 1) + 1)) AS m FROM i),
r AS (SELECT doc_id, i, m, w[i] AS a, w[i + m - 1] AS z, list_sum(w[i:i + m - 1]) AS total, list_transform(pos[i:i + m - 1], lambda k: raw[k]) AS lines FROM s),
runs AS (SELECT doc_id, i, m, lines FROM r WHERE total >= 50 AND (total - a < 50 OR total - z < 50)),
f AS (SELECT lines, min(struct_pack(d := doc_id, i := i)) AS first FROM runs GROUP BY lines),
c AS (SELECT runs.doc_id, unnest(range(runs.i, runs.i + runs.m)) AS k FROM runs JOIN f USING (lines) WHERE f.first <> struct_pack(d := runs.doc_id, i := runs.i)),
gone AS (SELECT doc_id, list(DISTINCT k) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(
    list_filter(range(1, len(raw) + 1), lambda k: NOT list_contains(list_transform(gone, lambda j: pos[j]), k)), lambda k: raw[k]), chr(10)) END AS text,
  CAST(coalesce(len(gone), 0) AS INTEGER) AS lines_removed
FROM n LEFT JOIN gone USING (doc_id)""",
    "op11_manifest": """
WITH RECURSIVE w AS (SELECT doc_id, lang, n_chars,
    list_transform([CAST(doc_id AS VARCHAR), source, lang], lambda v: coalesce(strlen(v) || ':' || v, '-')) AS f,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS c, coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS c1,
    coalesce(strlen(text) || ':' || text, '-') AS t,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)),
      lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)::UBIGINT[]), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)), 4294967295::UBIGINT) % 7 = 0 AS marked
  FROM documents),
l AS (SELECT *, sha256(concat(f[1], f[2], f[3], c, t)) AS leaf, sha256(concat(f[1], f[2], f[3], CASE WHEN marked THEN c1 ELSE c END, t)) AS altered FROM w),
r AS (SELECT doc_id, f[3] AS g, lang, leaf, altered, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
nodes AS (SELECT g, lang, 0 AS lvl, pos, n, leaf AS h FROM r
  UNION ALL SELECT g, any_value(lang), any_value(lvl) + 1, pos // 2, any_value(n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY g, pos // 2),
subs AS (SELECT g, h, lvl, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS lvl, pos, n, h FROM subs
  UNION ALL SELECT any_value(lvl) + 1, pos // 2, any_value(n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY pos // 2),
every AS (SELECT g, lvl, pos, n, h FROM nodes WHERE n > 1 UNION ALL SELECT s.g, s.lvl + t.lvl, t.pos, t.n, t.h FROM subs s JOIN tops t ON t.n > 1),
up AS (SELECT row_number() OVER () AS k, r.doc_id, r.leaf, r.g, 0 AS lvl, r.pos, s.lvl AS height, s.pos AS own, r.altered AS acc, '' AS path FROM r JOIN subs s USING (g)
  UNION ALL SELECT u.k, u.doc_id, u.leaf, u.g, u.lvl + 1, CASE WHEN u.lvl + 1 = u.height THEN u.own ELSE u.pos // 2 END, u.height, u.own,
    sha256(CASE WHEN u.pos % 2 = 0 THEN u.acc || coalesce(b.h, '') ELSE b.h || u.acc END), u.path || coalesce(b.h, '')
  FROM (SELECT k, doc_id, leaf, g, lvl, CASE WHEN lvl = height THEN own ELSE pos END AS pos, height, own, acc, path FROM up) u JOIN (SELECT DISTINCT g, lvl FROM every) e ON e.g = u.g AND e.lvl = u.lvl
    LEFT JOIN every b ON b.g = u.g AND b.lvl = u.lvl AND b.pos = xor(u.pos, 1)),
done AS (SELECT any_value(doc_id) AS doc_id, any_value(leaf) AS leaf, any_value(g) AS g, arg_max(acc, lvl) AS folded_root, arg_max(path, lvl) AS path FROM up GROUP BY k)
SELECT d.doc_id, d.leaf, s.h AS subroot, t.h AS root, sha256(d.path) AS proof_sha256, d.folded_root, d.folded_root = t.h AS verified
FROM done d JOIN subs s ON s.g = d.g JOIN tops t ON t.n = 1""",
    "op12_collocations": """
WITH p AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n-\\r]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM i),
f AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS gram, k, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, gram, k, f, string_split(gram, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
x AS (SELECT *, unnest(range(1, k)) AS m FROM c),
s AS (SELECT x.lang, x.gram, x.k, x.f AS a, l.f AS l, r.f AS r, x.m, (2000000::HUGEINT * x.f) // (l.f + r.f) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.gram = array_to_string(x.w[:x.m], ' ') JOIN f r ON r.lang = x.lang AND r.gram = array_to_string(x.w[x.m + 1:], ' ')),
b AS (SELECT lang, gram, k, a, arg_min(struct_pack(l := l, r := r, score := score), score * 8 + m) AS b FROM s GROUP BY ALL),
e AS (SELECT b.lang, b.gram FROM b JOIN b o ON o.lang = b.lang AND o.k > b.k AND contains(' ' || o.gram || ' ', ' ' || b.gram || ' ') AND 100 * o.a >= 80 * b.a),
z AS (SELECT lang, gram AS phrase, a, b.l AS l, b.r AS r, b.score::BIGINT AS score FROM b ANTI JOIN e USING (lang, gram))
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM z JOIN t USING (lang)) q WHERE rank <= 2000""",
}
