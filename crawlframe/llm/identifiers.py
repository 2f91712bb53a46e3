"""Personal identifiers: fixed kinds by pattern, unseen ones by bootstrapped contexts.

The fixed kinds (email, ip, card, phone) are found by regular expressions. They are the seeds. The words
around a seed make lexical patterns of its kind, ``(kind, two words before)`` and ``(kind, word before, word
after)``, digits in them written as one 0. Patterns with enough distinct seeds are looked for in all texts,
and what stands in them is proposed as an identifier, whatever it looks like: the one word after the two, or
the shortest run of up to ``RUN`` words between the other two. Patterns and what stands in them form a graph:

* a pattern scores the share of its distinct instances that are believed, weighed down for few instances:
  ``sum(belief) / (instances + 1)``, and is believed from ``accept`` on;
* an instance that is no seed is believed as much as its best believed pattern, less a tenth unless its
  shape is one that seeds of the kind have; below ``accept`` it is not believed at all.

Rounds carry belief from seeds over patterns to instances and on to other patterns, until no further pattern
or instance is believed. Believed instances are reported where they stand in a believed pattern, as spans of
kind ``context``; one inside a longer one is dropped. A pattern of words that stand in front of everything
has many instances and few seeds, and is never believed.

The search for patterns goes over the words of all texts, but for patterns that a part of the texts shows to
have too many instances for ever being believed (see ``_active``; no result depends on that part). A filter
of ``BITS`` bits, filled with the keys of the patterns, keeps most places out of the join; keys decide there.
Only DataFrame functions are used.

Spans are in code points, end exclusive. Places come from the lengths of the parts between matches, so
every text is read by the engine's own expressions alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.bind import bind
from crawlframe.llm.common import stored

# Kinds in order, with what a text must hold to be searched, and the rule. Repeats are
# possessive and starts inside a run are skipped where this cannot change a match, so long runs cost
# no more than their length. A card has 12 digits at least; no shorter run hides a longer one.
KINDS = ["email", "ip", "card", "phone"]
NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]", "phone": "\\+[0-9]"}
RULES = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++)(?:\\.[0-9]++)(?:\\.[0-9]++)",
    "card": "[0-9](?:[\\x20-]?[0-9]){11,}+",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: Characters in front of and behind a seed in which its words are looked for; a word that reaches over them is none.
REACH = 200
#: Longest run of words that a pattern proposes, and bits of the filter of pattern keys.
RUN, BITS = 4, 1 << 18
#: One text of so many gives the lower bounds of what stands in a pattern.
BOUND = 32
#: Least distinct believed instances of a believed pattern, belief from which on something is believed.
LEAST_SEEDS, ACCEPT = 3, 0.6


def _spans(text: Column, rule: str) -> Column:
    """Array of ``start, end, said`` of a rule's matches in order."""
    gaps, said = F.split(text, rule, -1), F.regexp_extract_all(text, F.lit(rule), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,said:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["said"])
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(F.struct(begin.alias("start"), end.alias("end"), pair["said"].alias("said")))).alias("found"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(said)), said, lambda g, m: F.struct(g.alias("gap"), m.alias("said")))
    return F.aggregate(pairs, start, step, lambda acc: acc["found"])


def _digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit holds: from the right, every second digit doubled, less 9 if over 9."""
    places = F.split(F.reverse(digits), "")
    numbers = F.transform(places, lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _holds(kind: str, said: Column) -> Column:
    if kind == "ip":
        # Leading zeros aside, a part over 255 has four digits, or three from 256 on.
        return F.forall(F.split(said, "\\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) < 4) & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = F.length(_digits(said))
        return (n >= 12) & (n <= 19) & _luhn(_digits(said))
    if kind == "phone":
        n = F.length(_digits(said))
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def _of_kind(text: Column, number: int, kind: str) -> Column:
    found = F.filter(_spans(text, RULES[kind]), lambda s: _holds(kind, s["said"]))
    shaped = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["said"].alias("said")))
    has = text.contains(NEEDS[kind]) if kind == "email" else text.rlike(NEEDS[kind])
    return F.when(has, shaped).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,said:string>>"))


def base_spans(text: Column) -> Column:
    """Array of ``start, kind (number), end, said`` of the fixed kinds, by start, then kind."""
    return F.array_sort(F.concat(*[_of_kind(text, number, kind) for number, kind in enumerate(KINDS)]))


def _shape(words: Column) -> Column:
    return F.lower(F.regexp_replace(words, "[0-9]+", "0"))


def _looks(instance: Column) -> Column:
    """What an instance looks like: runs of digits, small letters and capitals as one sign each."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(instance, "[0-9]+", "0"), "\\p{Ll}+", "a"), "\\p{Lu}+", "A")


def _keys(before2: Column, before1: Column, after: Column) -> Column:
    """Keys of the patterns that the words make, a null for a word that is not there."""
    return F.array(F.concat(F.lit("2|"), before2, F.lit(" "), before1), F.concat(F.lit("1|"), before1, F.lit(" "), after))


def _seed_patterns(found: DataFrame) -> DataFrame:
    """``kind, key, instance``: seeds in their patterns, once each."""
    seeds = found.select(F.explode("seen").alias("s")).select("s.*")
    before, after = F.col("before"), F.col("after")
    one = F.nullif(F.regexp_extract(before, "\\s(\\S+)\\s+$", 1), F.lit(""))
    two = F.nullif(F.regexp_extract(before, "\\s(\\S+)\\s+\\S+\\s+$", 1), F.lit(""))
    next_ = F.nullif(F.regexp_extract(after, "^\\p{Punct}*\\s+(\\S+)\\s", 1), F.lit(""))
    keys = F.array_compact(_keys(_shape(two), _shape(one), _shape(next_)))
    return seeds.select("kind", F.explode(keys).alias("key"), F.col("said").alias("instance")).distinct()


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS)).cast("int")


def _key_filter(patterns: DataFrame) -> Column:
    """The filter as one literal array of numbers of 32 bits; its size does not follow the patterns."""
    anchors = F.concat(F.lit("0|"), F.when(F.col("key").startswith("1"), F.substring_index(F.substr("key", F.lit(3)), " ", 1)).otherwise(F.substring_index("key", " ", -1)))
    bits = patterns.select(F.explode(F.array("key", anchors)).alias("key")).select(_bit(F.col("key")).alias("b"))
    word = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b") % 32)).alias("w")
    words = {r["at"]: r["w"] for r in bits.groupBy(F.floor(F.col("b") / 32).cast("int").alias("at")).agg(word).collect()}
    return F.split(F.lit(",".join(str(words.get(k, 0)) for k in range(BITS // 32))), ",").cast("array<long>")


def _places(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``doc_id, print, at, run, key, instance``: places (in words) where a run of words may stand in a pattern, no seed in it."""
    held = _key_filter(patterns)

    def passes(key: Column) -> Column:
        return bind(_bit(key), lambda b: F.get(held, F.floor(b / 32).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b % 32)) != 0)

    # Blanks stay where they are in the shape of a text, so its words are the words' shapes.
    words, shapes = F.regexp_extract_all("text", F.lit("\\S+"), F.lit(0)), F.regexp_extract_all(_shape(F.col("text")), F.lit("\\S+"), F.lit(0))
    taken = F.transform(base_spans(F.col("text")), lambda t: _taken(F.col("text"), t))
    rows = docs.filter("text is not null").select("doc_id", F.xxhash64("text").alias("print"), taken.alias("taken"), words.alias("words"), shapes.alias("shapes"))
    kind = "array<struct<at:int,run:int,key:string>>"

    def at_word(i: Column) -> Column:
        """Runs after word ``i``: one word after it and the one before, and up to ``RUN`` up to a word that makes a pattern with it."""
        one = F.get("shapes", i)
        two = F.concat(F.lit("2|"), F.get("shapes", i - 1), F.lit(" "), one)
        spans = [F.when((i + 1 < F.size("shapes")) & F.coalesce(passes(two), F.lit(False)), F.struct((i + 1).alias("at"), F.lit(1).alias("run"), two.alias("key")))]
        for run in range(1, RUN + 1):
            after = F.get("shapes", i + run + 1)
            key = F.concat(F.lit("1|"), one, F.lit(" "), after)
            # Of the runs up to a word the shortest one is meant.
            nearer = [F.get("shapes", i + r + 1) == after for r in range(1, run)]
            first = ~reduce(Column.__or__, nearer) if nearer else F.lit(True)
            spans.append(F.when(F.coalesce(passes(key) & first, F.lit(False)), F.struct((i + 1).alias("at"), F.lit(run).alias("run"), key.alias("key"))))
        # One look tells for most words that no pattern has them in front.
        return F.when(passes(F.concat(F.lit("0|"), one)), F.array_compact(F.array(*spans)).cast(kind)).otherwise(F.array().cast(kind))

    near = F.flatten(F.transform(F.sequence(F.lit(0), F.size("shapes") - 1), at_word))
    rows = rows.filter(F.size("shapes") > 1).withColumn("p", F.explode(near)).select("doc_id", "print", "taken", "words", "p.*")
    free = ~F.exists("taken", lambda t: (t["first"] < F.col("at") + F.col("run")) & (F.col("at") <= t["last"]))
    said = F.regexp_replace(F.array_join(F.slice("words", F.col("at") + 1, F.col("run")), " "), "[.,;:!?]+$", "")
    return rows.filter(free).select("doc_id", "print", "at", "run", "key", said.alias("instance")).filter("instance <> ''")


def _taken(text: Column, s: Column) -> Column:
    """First and last word that a span touches."""

    def words_in(part: Column) -> Column:
        return F.size(F.regexp_extract_all(part, F.lit("\\S+"), F.lit(0)))

    inside = F.substring(text, s["start"], F.lit(1)).rlike("\\S") & (s["start"] > 0)
    first = words_in(F.substring(text, F.lit(1), s["start"])) - F.when(inside, 1).otherwise(0)
    return F.struct(first.alias("first"), (words_in(F.substring(text, F.lit(1), s["end"])) - 1).alias("last"))


def _believed(pairs: DataFrame, least_seeds: int, accept: float) -> tuple[DataFrame, DataFrame] | None:
    """Believed patterns ``(kind, key)`` and instances ``(kind, instance)`` of the graph ``kind, key, instance, seed, like``; None if there are none.

    Seeds and instances of a pattern are counted once; a round adds what believed instances bring, which are few.
    """
    counts = stored(pairs.groupBy("kind", "key").agg(F.count("*").alias("n"), F.sum("seed").alias("seeds")), "counts")
    others, believed, settled, turn = pairs.filter("seed = 0"), None, None, 0
    while True:
        turn += 1
        scored = counts.withColumns({"more": F.lit(0.0), "known": F.col("seeds")})
        if believed is not None:
            gains = others.join(believed, ["kind", "instance"]).groupBy("kind", "key").agg(F.sum("belief").alias("gain"), F.count("*").alias("found"))
            scored = counts.join(gains, ["kind", "key"], "left").withColumns({"more": F.coalesce("gain", F.lit(0.0)), "known": F.col("seeds") + F.coalesce("found", F.lit(0))})
        score = (F.col("seeds") + F.col("more")) / (F.col("n") + 1)
        patterns = scored.filter((F.col("known") >= least_seeds) & (score >= accept)).select("kind", "key", score.alias("score"))
        patterns = stored(patterns, f"patterns{turn}")
        if patterns.isEmpty():
            return None
        best = F.max(F.col("score") * 0.9 + F.col("like") * 0.1).alias("belief")
        believed = stored(others.join(patterns, ["kind", "key"]).groupBy("kind", "instance").agg(best).filter(F.col("belief") >= accept), f"beliefs{turn}")
        now = (patterns.count(), believed.count())
        # Belief only grows from round to round, so the counts stand still when nothing changes any more.
        if now == settled:
            return patterns.select("kind", "key"), believed.select("kind", "instance")
        settled = now


def identifiers(docs: DataFrame, least_seeds: int = LEAST_SEEDS, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_context, base_sha256, spans``, a row for each row of ``docs``.

    Null and empty texts have no spans. Rows alike in doc_id and text are found alike and keep a row each.
    An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.col("doc_id"), F.xxhash64("text").alias("print"), text.alias("text"), base_spans(text).alias("base"))

    def before(s: Column) -> Column:
        begin = F.greatest(s["start"] - REACH, F.lit(0))
        # The blank in front says that the text's first word is whole.
        return F.concat(F.when(begin == 0, F.lit(" ")).otherwise(F.lit("")), F.substring("text", begin + 1, s["start"] - begin))

    def after(s: Column) -> Column:
        return F.concat(F.substring("text", s["end"] + 1, F.lit(REACH)), F.when(F.length("text") <= s["end"] + REACH, F.lit(" ")).otherwise(F.lit("")))

    seen = F.transform("base", lambda s: F.struct(F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("kind"), s["said"].alias("said"), before(s).alias("before"), after(s).alias("after")))
    # Written once: spans and contexts are small beside the texts.
    found = stored(read.select("doc_id", "print", "base", seen.alias("seen")), "spans")

    seeds = stored(_seed_patterns(found), "seeds")
    patterns = stored(seeds.groupBy("kind", "key").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= least_seeds), "candidates")
    extra = None if patterns.isEmpty() else _contexts(docs, seeds, patterns, least_seeds, accept)
    if extra is None:
        rows = found.withColumn("extra", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    else:
        rows = found.join(extra, found["doc_id"].eqNullSafe(extra["_id"]) & (found["print"] == extra["_print"]), "left")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    every = F.array_sort(F.concat(base, F.coalesce("extra", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    names = F.array(*[F.lit(k) for k in (*KINDS, "context")])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def counted(k: int, name: str) -> Column:
        return F.size(F.filter(every, lambda s: s["kind"] == k)).cast("long").alias(f"n_{name}")

    counts = [counted(k, name) for k, name in enumerate((*KINDS, "context"))]
    return rows.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(every).alias("spans"))


def _active(docs: DataFrame, patterns: DataFrame, accept: float) -> Callable[[int], DataFrame]:
    """``(kind, key)`` of the patterns that can be believed at all if so many instances that are no seeds are.

    What stands in a pattern in one text of ``BOUND`` alone is a lower bound of its instances. A pattern with too many for
    its seeds and all believed instances together will not be believed however many more there are, so the
    whole texts need not be looked through for it: most pairs of common words go here.
    """
    some = docs.filter(F.pmod(F.xxhash64("text"), F.lit(BOUND)) == 0)
    seen = _places(some, patterns).join(patterns, "key").select("kind", "key", "instance").distinct().groupBy("kind", "key").agg(F.count("*").alias("least"))
    bounded = stored(patterns.join(seen, ["kind", "key"], "left").withColumn("least", F.coalesce("least", F.lit(0))), "bounded")

    def active(believed: int) -> DataFrame:
        return bounded.filter((F.col("seeds") + believed) / (F.col("seeds") + F.col("least") + 1) >= accept).select("kind", "key", "seeds")

    return active


def _graph(docs: DataFrame, seeds: DataFrame, patterns: DataFrame) -> DataFrame:
    """``kind, key, instance, seed, like``: patterns and what stands in them, each pair once."""
    # The graph needs what stands in a pattern, not where: rows combine in the task that reads the texts.
    proposed = _places(docs, patterns).join(patterns.select("kind", "key"), "key").select("kind", "key", "instance").distinct()
    likes = seeds.select("kind", _looks(F.col("instance")).alias("looks")).distinct().withColumn("like", F.lit(1))
    others = proposed.withColumn("looks", _looks(F.col("instance"))).join(likes, ["kind", "looks"], "left")
    others = others.select("kind", "key", "instance", F.lit(0).alias("seed"), F.coalesce("like", F.lit(0)).alias("like"))
    own = seeds.join(patterns, ["kind", "key"], "left_semi").select("kind", "key", "instance", F.lit(1).alias("seed"), F.lit(1).alias("like"))
    return stored(own.unionByName(others), "pairs")


def _contexts(docs: DataFrame, seeds: DataFrame, patterns: DataFrame, least_seeds: int, accept: float) -> DataFrame | None:
    """``_id, _print, extra``: the spans that believed patterns and instances add to a document; None if nothing is believed."""
    active = _active(docs, patterns, accept)
    chosen, size, believed_so_far = active(0), None, 0
    while True:
        chosen = stored(chosen, "active")
        now = chosen.count()
        if now == size:
            break
        graph = _believed(_graph(docs, seeds, chosen), least_seeds, accept) if now else None
        if graph is None:
            return None
        # Further patterns come into reach when many instances are believed.
        size, believed_so_far = now, graph[1].count()
        chosen = active(believed_so_far)
    believed, accepted = graph
    # Believed patterns are few; the texts are looked through for them once more, now with places.
    places = _places(docs, believed.select("key").distinct()).join(believed, "key").join(accepted, ["kind", "instance"], "left_semi")
    hits = places.groupBy("doc_id", "print").agg(F.collect_set(F.struct("at", "run", "instance")).alias("hits")).select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "hits")
    hits = stored(hits, "hits")
    # Rows alike in id and text are one document here.
    once = docs.filter("text is not null").select("doc_id", F.xxhash64("text").alias("print"), "text")
    hit = once.join(hits, once["doc_id"].eqNullSafe(hits["_id"]) & (once["print"] == hits["_print"])).dropDuplicates(["_id", "_print"])
    words, gaps = F.regexp_extract_all("text", F.lit("\\S+"), F.lit(0)), F.split("text", "\\S+", -1)
    hit = hit.select("_id", "_print", "hits", words.alias("words"), gaps.alias("gaps"))

    def chars(parts: str, start: Column, n: Column) -> Column:
        return F.length(F.array_join(F.slice(parts, start, n), ""))

    def span(h: Column) -> Column:
        start = chars("words", F.lit(1), h["at"]) + chars("gaps", F.lit(1), h["at"] + 1)
        # Its length in the text: blanks inside it are as they stand there, the full stop behind it is not part of it.
        inner = chars("words", h["at"] + 1, h["run"]) + chars("gaps", h["at"] + 2, h["run"] - 1)
        cut = chars("words", h["at"] + 1, h["run"]) + h["run"] - 1 - F.length(h["instance"])
        return F.struct(start.alias("start"), F.lit(len(KINDS)).alias("kind"), (start + inner - cut).alias("end"))

    spans = F.array_distinct(F.transform("hits", span))
    whole = bind(spans, lambda all_: F.filter(all_, lambda s: ~F.exists(all_, lambda o: (o["start"] <= s["start"]) & (o["end"] >= s["end"]) & (o != s))))
    return hit.select("_id", "_print", whole.alias("extra"))
