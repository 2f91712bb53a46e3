"""Repeated line runs, found by prefix doubling over the documents' line sequences.

Every line that is not blank is a position; its suffix is the rest of its document. Suffixes that
share their first 2^k lines stand together in the suffix array, as an interval of longest common
prefix 2^k or more, and get one name: at k = 0 from the line, then from the names of their two halves.
A position whose name nobody shares stands alone from there on and takes no part in further rounds.
Intervals are kept as groups by name; their order among each other does not matter for removal.

A run counts if it has at least ``min_words`` words. Whether a run occurs earlier is asked for the
shortest runs that begin, and that end, at each position: a run of any length with an earlier copy is
the union of such shortest runs with earlier copies, so maximal runs come out whole. A run of m lines
belongs to the interval of two overlapping names of 2^k lines, 2^k <= m. Lines have a word at least, so
a shortest run has ``min_words`` lines at most and the rounds are few. In each interval the first run
stays (smallest doc_id, then print of the text, then place) and the lines of the others are removed.

Names are 128-bit digests. Only DataFrame functions are used; grouping combines before the shuffle,
and groups meet their rows in joins, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.functions.bind import bind
from crawlframe.llm.common import free_names, stored

MIN_WORDS = 50
#: A document is its id and the print of its text: rows alike in both are one document.
DOC = ["doc", "print"]


def _digest(*parts: Column | str) -> tuple[Column, Column]:
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def line_positions(docs: DataFrame) -> DataFrame:
    """``doc, print, i, words, a, b``: the lines that are not blank, numbered, with their first name."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x) != "")
    rows = docs.filter("text is not null").select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("print"), F.posexplode(lines).alias("i", "line"))
    a, b = _digest("line")
    tidy = F.btrim("line")
    words = F.length(tidy) - F.length(F.replace(tidy, F.lit(" "), F.lit(""))) + 1
    # Rows alike in id and text give equal rows here; one of each is enough.
    return rows.select(*DOC, "i", words.alias("words"), a.alias("a"), b.alias("b"))


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose name another position has too."""
    names = rows.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b")
    return rows.join(names, ["a", "b"], "left_semi")


def _shortest(near: Column, at: Column, step: int, min_words: int) -> Column:
    """Lines of the shortest run with enough words among rows that follow each other from ``at``; null if there is none."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("m"), at.alias("i"))

    def take(acc: Column, x: Column) -> Column:
        fits = (acc["words"] < min_words) & (x["i"] == acc["i"])
        more = F.struct((acc["words"] + x["words"]).alias("words"), (acc["m"] + 1).alias("m"), (acc["i"] + step).alias("i"))
        return F.when(fits, more).otherwise(acc)

    return F.aggregate(near, start, take, lambda acc: F.when(acc["words"] >= min_words, acc["m"]))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, print, i, m``: runs of ``m`` lines from line ``i`` that occur earlier too."""
    first = _shared(line_positions(docs).distinct() if _repeats(docs) else line_positions(docs))
    by_doc = Window.partitionBy(*DOC).orderBy("i")
    row = F.struct("i", "words")
    rows = first.withColumn("ahead", F.collect_list(row).over(by_doc.rangeBetween(0, min_words - 1)))
    rows = rows.withColumn("behind", F.reverse(F.collect_list(row).over(by_doc.rangeBetween(1 - min_words, 0))))
    begins = _shortest(F.col("ahead"), F.col("i"), 1, min_words)
    rows = rows.select(*DOC, "i", "a", "b", begins.alias("begins"), _shortest(F.col("behind"), F.col("i"), -1, min_words).alias("ends"))
    # Lengths of the runs to ask for at their first lines: the shortest from there, and those shortest to their ends.
    rows = rows.withColumn("ahead", F.collect_list(F.struct("i", "ends")).over(by_doc.rangeBetween(0, min_words - 1)))
    to_ends = F.transform(F.filter("ahead", lambda x: x["ends"] == x["i"] - F.col("i") + 1), lambda x: x["ends"])
    lengths = F.array_distinct(F.concat(F.array_compact(F.array("begins")), to_ends))
    rows, level, runs = stored(rows.select(*DOC, "i", "a", "b", lengths.alias("lengths")), "lines"), 0, None
    while True:
        width = 1 << level
        name = F.struct("i", "a", "b")
        near = rows.withColumn("ahead", F.collect_list(name).over(by_doc.rangeBetween(0, width - 1)))
        near = near.withColumn("next", F.first(name).over(by_doc.rangeBetween(width, width)))
        asked = near.withColumn("m", F.explode(F.filter("lengths", lambda m: (m >= width) & (m < 2 * width))))
        asked = asked.withColumn("right", F.get(F.filter("ahead", lambda x: x["i"] == F.col("i") + F.col("m") - width), F.lit(0)))
        x, y = _digest("m", "a", "b", "right.a", "right.b")
        found = stored(asked.filter("right is not null").select(*DOC, "i", "m", x.alias("x"), y.alias("y")), f"runs{level}")
        runs = found if runs is None else runs.union(found)
        level += 1
        if 2 * width > min_words:
            break
        a, b = _digest("a", "b", "next.a", "next.b")
        rows = stored(_shared(near.filter("next is not null").select(*DOC, "i", a.alias("a"), b.alias("b"), "lengths")), f"names{level}")
        if rows.isEmpty():
            break
    place = F.struct("doc", "print", "i")
    firsts = runs.groupBy("x", "y").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").select("x", "y", "first")
    return runs.join(firsts, ["x", "y"]).filter(place != F.col("first")).select(*DOC, "i", "m")


def _repeats(docs: DataFrame) -> bool:
    """Whether some rows are alike in id and text."""
    return not docs.groupBy("doc_id", F.xxhash64("text")).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def _rest(parts: Column, numbers: Column, removed: str) -> Column:
    """The lines that are not in the column ``removed``, joined."""
    gone = bind(F.filter(numbers, lambda k: F.btrim(F.get(parts, k)) != ""), lambda written: F.transform(removed, lambda k: F.get(written, k)))
    return F.array_join(F.transform(F.array_except(numbers, gone), lambda k: F.get(parts, k)), "\n")


def without_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the lines of later copies removed from text, and ``lines_removed``.

    Blank lines are never part of a run and stay. Rows alike in doc_id and text are one document and get
    one result. A null doc_id comes before all others. Null texts stay null, empty ones empty; a text
    whose lines all go becomes empty. An empty table gives no rows. Further columns pass through; a
    column named ``lines_removed`` is replaced.
    """
    doc, mark, removed = free_names(docs, "_doc", "_print", "_gone")
    lines = F.explode(F.sequence("i", F.col("i") + F.col("m") - 1)).alias("i")
    gone = repeated_runs(docs, min_words).select(*DOC, lines).groupBy(*DOC).agg(F.collect_set("i").alias(removed))
    gone = gone.select(F.col("doc").alias(doc), F.col("print").alias(mark), removed)
    rows = docs.join(gone, docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(mark)), "left")
    # Bound once: inside the lambdas the text would be cut anew for every line.
    rest = bind(F.split(docs["text"], "\n", -1), lambda parts: bind(F.sequence(F.lit(0), F.size(parts) - 1), lambda numbers: _rest(parts, numbers, removed)))
    text = F.when(F.col(removed).isNull(), docs["text"]).otherwise(rest)
    count = F.coalesce(F.size(removed), F.lit(0))
    names = [c for c in docs.columns if c != "lines_removed"]
    return rows.select(*[text.alias(c) if c == "text" else docs[c] for c in names], F.greatest(count, F.lit(0)).alias("lines_removed"))
