"""Robots texts and sitemaps.

A robots text is one cell of the site table, so its lines are grouped inside the row and no
shuffle is needed. Each meaningful line becomes one marked line (``u`` agent, ``a`` allow,
``d`` disallow, ``c`` delay, ``r`` rate, ``-`` a really empty line); a group is then a run of
agent lines followed by a run of rule lines, which one regular expression finds. Values stay
percent-encoded in the marked text, so they hold no line feed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.bind import bind
from crawlframe.functions.tables import KEY, SLOT, VALUE, probe, slot_of
from crawlframe.functions.urls import canonicalize_url, percent_decode
from crawlframe.schema import DEFAULT_LIMIT_S

_LINE_ENDS = r"\r\n|[\n\x0B\f\r\x1c\x1d\x1e\x85  ]"
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
# Possessive runs: matched without recursion, however many lines a group has.
_GROUP = r"((?:u[^\n]*\n)++(?:[adcr][^\n]*\n)++)"

# Fixed value: a sitemap line in a robots text and the characters of its URL.
SITEMAP_PATTERN = r"Sitemap:\s+([A-Za-z0-9\-\.\_\~\:\/\?\#\[\]\@\!\$\&\(\)\*\+\,\;\=\%]+)"
# Fixed value: a location in a sitemap.
LOCATION_PATTERN = "<loc>([^<>]+)</loc>"


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def _marked_line(line: Column) -> Column:
    code = _strip(F.substring_index(line, "#", 1))
    colon = F.instr(code, ":")
    key = F.lower(_strip(F.substring_index(code, ":", 1)))
    value = _strip(F.substr(code, colon + 1))
    mark = (
        F.when(key == "user-agent", F.lit("u"))
        .when(key == "allow", F.lit("a"))
        .when(key == "disallow", F.lit("d"))
        .when(key == "crawl-delay", F.lit("c"))
        .when(key == "request-rate", F.lit("r"))
    )
    return F.when(line == "", F.lit("-")).when(colon > 0, F.concat(mark, value))


def _values(group: Column, marks: str) -> Column:
    """Lines of a group with one of the marks, mark included, in order."""
    return F.filter(F.split(group, "\n"), lambda t: (t != "") & F.substring(t, 1, 1).isin(list(marks)))


def _agents(group: Column) -> Column:
    return F.transform(_values(group, "u"), lambda t: percent_decode(F.substr(t, F.lit(2))))


def _names(group: Column, agent: str) -> Column:
    return F.exists(_agents(group), lambda name: name == agent)


def _groups(robots: Column) -> Column:
    """All groups of a robots text, as marked lines."""
    # A text may end in a line end, after which no further (empty) line is meant.
    body = F.regexp_replace(F.coalesce(robots, F.lit("")), f"(?:{_LINE_ENDS})\\z", "")
    lines = F.filter(F.transform(F.split(body, _LINE_ENDS), _marked_line), lambda t: t.isNotNull())
    return F.regexp_extract_all(F.concat(F.array_join(lines, "\n"), F.lit("\n")), F.lit(_GROUP), 1)


def robots_groups(robots: Column) -> Column:
    """The groups of a robots text that count: all that do not name ``*``, then the first that does."""
    return bind(
        _groups(robots),
        lambda groups: F.concat(
            F.filter(groups, lambda g: ~_names(g, "*")), F.slice(F.filter(groups, lambda g: _names(g, "*")), 1, 1)
        ),
    )


def star_group(robots: Column) -> Column:
    """The group that applies to any agent; NULL if there is none.

    A group with an empty agent name applies to all agents and comes before the one naming
    ``*``.
    """
    ranked = F.transform(
        F.filter(_groups(robots), lambda g: _names(g, "*") | _names(g, "")),
        lambda g, i: F.struct(_names(g, "*").alias("later"), i.alias("place"), g.alias("group")),
    )
    return F.array_min(ranked)["group"]


def _rule_path(raw: Column) -> Column:
    """Rule path, percent-decoded; an absolute URL keeps only what follows its host's slash."""
    value = percent_decode(raw)
    return normal_target(value, keep_host=True)


def normal_target(decoded: Column, keep_host: bool = False) -> Column:
    """Path, query and fragment of a decoded URL; an empty query, fragment or parameter goes."""
    text = F.ltrim(F.translate(decoded, "\t\r\n", ""))
    if not keep_host:
        text = F.regexp_replace(text, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", "")
    text = F.regexp_replace(text, r"^([^?#]*/)?([^/;?#]*);(?=[?#]|\z)", "$1$2")
    return F.regexp_replace(F.regexp_replace(text, r"#\z", ""), r"^([^?#]*)\?(?=#|\z)", "$1")


def robots_rules(robots: Column) -> Column:
    """Rules for any agent in file order: array of (allow, path). ``Disallow:`` alone allows all."""
    lines = F.coalesce(_values(star_group(robots), "ad"), F.array().cast("array<string>"))

    def rule(line: Column) -> Column:
        path = _rule_path(F.substr(line, F.lit(2)))
        raw_empty = F.length(line) == 1
        return F.struct((line.startswith("a") | raw_empty).alias("allow"), path.alias("path"))

    return F.transform(lines, rule)


def request_target(url: Column) -> Column:
    """What a URL's rules are matched against: its decoded path and query, ``/`` if empty."""
    return F.regexp_replace(normal_target(percent_decode(url)), "^\\z", "/")


def rules_allow(rules: Column, url: Column) -> Column:
    """Decision of the first rule whose path is a prefix of the URL's; allowed if there is none."""
    # Bound once: inside the lambda the URL would be taken apart for every rule.
    first = bind(request_target(url), lambda target: F.get(F.filter(rules, lambda r: target.startswith(r["path"])), F.lit(0)))
    return F.coalesce(first["allow"], F.lit(True))


def _delay_texts(group: Column) -> Column:
    """Well-formed crawl delays of a group, in order."""
    texts = F.transform(_values(group, "c"), lambda t: _strip(percent_decode(F.substr(t, F.lit(2)))))
    return F.filter(texts, lambda t: t.rlike(r"^[0-9]+\z"))


def _rate_texts(group: Column) -> Column:
    """Well-formed request rates of a group, in order, as arrays of two numbers."""
    texts = F.transform(_values(group, "r"), lambda t: percent_decode(F.substr(t, F.lit(2))))
    return F.transform(
        F.filter(texts, lambda t: t.rlike(r"^\s*[0-9]+\s*/\s*[0-9]+\s*\z")), lambda t: F.transform(F.split(t, "/"), _strip)
    )


def _delay(group: Column) -> Column:
    return F.try_element_at(_delay_texts(group), F.lit(-1)).try_cast("long")


def _rate(group: Column) -> Column:
    return F.transform(F.try_element_at(_rate_texts(group), F.lit(-1)), lambda t: t.try_cast("long"))


def robots_limits(robots: Column) -> Column:
    """Struct of the limits for any agent: request rate (requests, seconds), crawl delay, limit in seconds.

    The limit is the request rate's, else the crawl delay, else the default; only whole numbers
    count.
    """

    def limits(found: Column) -> Column:
        requests, seconds = F.get(found["rate"], F.lit(0)), F.get(found["rate"], F.lit(1))
        per_request = F.try_divide(seconds.cast("double"), requests.cast("double"))
        return F.struct(
            requests.alias("requests"), seconds.alias("seconds"), found["delay"].alias("crawl_delay"),
            F.coalesce(per_request, found["delay"].cast("double"), F.lit(DEFAULT_LIMIT_S)).alias("limit_s"),
        )

    return bind(star_group(robots), lambda g: bind(F.struct(_rate(g).alias("rate"), _delay(g).alias("delay")), limits))


def robots_sitemaps(robots: Column) -> Column:
    """Sitemap URLs named in a robots text, in order."""
    return F.regexp_extract_all(robots, F.lit(SITEMAP_PATTERN), 1)


def sitemap_locations(sitemap: Column) -> Column:
    """Canonical URLs of a sitemap's locations, in order."""
    return F.transform(F.regexp_extract_all(sitemap, F.lit(LOCATION_PATTERN), 1), lambda u: canonicalize_url(u))


def robots_normalized(robots: Column) -> Column:
    """Stored form of a robots text: the groups that count, printed back without comments."""

    def agent_line(t: Column) -> Column:
        return F.concat(F.lit("User-agent: "), percent_decode(percent_decode(F.substr(t, F.lit(2)))))

    def rule_line(t: Column) -> Column:
        allows = t.startswith("a") | (F.length(t) == 1)
        return F.concat(F.when(allows, F.lit("Allow: ")).otherwise(F.lit("Disallow: ")), _rule_path(F.substr(t, F.lit(2))))

    def block(group: Column) -> Column:
        delay = F.transform(
            F.slice(F.reverse(_delay_texts(group)), 1, 1), lambda t: F.concat(F.lit("Crawl-delay: "), _number(t))
        )
        rate = F.transform(
            F.slice(F.reverse(_rate_texts(group)), 1, 1),
            lambda t: F.concat(F.lit("Request-rate: "), F.array_join(F.transform(t, _number), "/")),
        )
        lines = F.concat(F.transform(_values(group, "u"), agent_line), delay, rate, F.transform(_values(group, "ad"), rule_line))
        return F.array_join(lines, "\n")

    return F.array_join(F.transform(robots_groups(robots), block), "\n\n")


def _number(digits: Column) -> Column:
    """Digits without leading zeros."""
    return F.regexp_replace(digits, "^0+(?=[0-9])", "")


def rules_index(rules: Column) -> Column:
    """Rules as a look-up table: struct of ``sizes``, the lengths of their paths, and ``slots``, path to first rule number and decision.

    Made once for a host. A slot separator for every slot is sorted in among the rules, so the slots come out
    of one sort and one split, however many rules there are.
    """

    def table(given: Column) -> Column:
        size = F.greatest(F.lit(16), F.size(given) * 2)
        # Paths may hold any character; their hexadecimal text holds none that parts a table. The last of a
        # path counts when it is looked up, which is to be the first rule with it.
        entries = F.transform(given, lambda r, i: bind(F.hex(r["path"]), lambda path: F.struct(
            slot_of(path, size).alias("slot"), F.lit(0).alias("end"), path.alias("path"), (-i).alias("later"),
            F.concat(F.lit(KEY), path, F.lit(VALUE), i.cast("string"), F.when(r["allow"], F.lit("+")).otherwise(F.lit("-"))).alias("text"),
        )))
        ends = F.transform(F.sequence(F.lit(0), size - 2), lambda s: F.struct(
            s.alias("slot"), F.lit(1).alias("end"), F.lit("").alias("path"), F.lit(0).alias("later"), F.lit(SLOT).alias("text")))
        joined = F.array_join(F.transform(F.array_sort(F.concat(entries, ends)), lambda e: e["text"]), "")
        sizes = F.array_sort(F.array_distinct(F.transform(given, lambda r: F.length(r["path"]))))
        return F.struct(sizes.alias("sizes"), F.split(joined, SLOT, -1).alias("slots"), size.alias("size"))

    return F.when(rules.isNotNull(), bind(rules, table))


def index_allows(index: Column, url: Column) -> Column:
    """Decision of the first rule whose path is a prefix of the URL's, as :func:`rules_allow` gives it, by looking up the URL's own prefixes."""

    def decide(target: Column) -> Column:
        lengths = F.filter(index["sizes"], lambda n: n <= F.length(target))
        found = F.transform(lengths, lambda n: probe(index["slots"], index["size"], F.hex(F.substr(target, F.lit(1), n))))
        numbered = F.transform(F.array_compact(found), lambda v: F.struct(F.substr(v, F.lit(1), F.length(v) - 1).cast("int").alias("at"), v.endswith("+").alias("allow")))
        return F.coalesce(F.array_min(numbered)["allow"], F.lit(True))

    return bind(request_target(url), decide)
