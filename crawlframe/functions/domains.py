"""Registered domain of a host by longest public suffix."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import cache
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.bind import bind
from crawlframe.functions.tables import literal_table

#: The list of publicsuffix.org as Debian ships it, used when the caller gives no other.
PUBLIC_SUFFIXES = Path(__file__).parent / "public_suffix_list.dat"


def read_public_suffixes(text: str, private: bool = False) -> tuple[str, ...]:
    """Rules of a public-suffix text, wildcards ``*.x`` and exceptions ``!y.x`` included.

    A rule is a line up to its first white space; empty lines and comments (``//``) are none. Names outside
    ASCII are given in their own script and as hosts write them (``xn--``). Rules between the marks of
    private domains are left out unless ``private``.
    """
    out, skipped = [], False
    for line in text.splitlines():
        if line.startswith("//"):
            if "===BEGIN PRIVATE DOMAINS===" in line or "===END PRIVATE DOMAINS===" in line:
                skipped = "BEGIN" in line and not private
            continue
        rule = line.split(maxsplit=1)[0].lower() if line.strip() else ""
        if rule and not skipped:
            out.append(rule)
            if not rule.isascii():
                mark = re.match(r"(?:!|\*\.)?", rule)[0]
                out.append(mark + rule[len(mark):].encode("idna").decode("ascii"))
    return tuple(dict.fromkeys(out))


@cache
def public_suffixes() -> tuple[str, ...]:
    return read_public_suffixes(PUBLIC_SUFFIXES.read_text("utf-8"))


def _rule_marks(suffixes: Sequence[str]) -> Callable[[Column], Column]:
    """The rules that name a text: ``p`` for the plain one, ``w`` for ``*.text``, ``e`` for ``!text``, else ``-``, in this order."""
    marks: dict[str, list[str]] = {}
    for rule in suffixes:
        kind = 1 if rule.startswith("*.") else 2 if rule.startswith("!") else 0
        marks.setdefault(rule[(0, 2, 1)[kind]:], ["-", "-", "-"])[kind] = "pwe"[kind]
    named = literal_table({text: "".join(kinds) for text, kinds in marks.items()})
    return lambda text: F.coalesce(named(text), F.lit("---"))


def host_name(url: Column) -> Column:
    """Host of a URL or of bare text, in lower case, without user, port and trailing dot."""
    authority = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?([^/?#]*)", 1)
    after_user = F.substring_index(authority, "@", -1)
    return F.lower(F.regexp_replace(F.substring_index(after_user, ":", 1), r"\.+\z", ""))


def registered_domain(host: Column, suffixes: Sequence[str] | None = None) -> Column:
    """Struct (subdomain, domain, suffix) of a host.

    A host under no listed suffix gets an empty suffix and its last label as domain; an IPv4
    address is its own domain. Without ``suffixes`` the rules are those of the public-suffix list.
    """
    suffixes = public_suffixes() if suffixes is None else suffixes
    # Bound once: inside the lambdas below host and labels would be derived anew for every label.
    return bind(host, lambda h: bind(F.split(h, r"\."), lambda labels: _registered(h, labels, suffixes)))


def _registered(host: Column, labels: Column, suffixes: Sequence[str]) -> Column:
    n = F.size(labels)
    marks = _rule_marks(suffixes)

    def tail(i: Column) -> Column:
        return F.array_join(F.slice(labels, i, n), ".")

    # The rules of every suffix of the host, one probe each.
    named = F.transform(F.sequence(F.lit(1), n), lambda i: marks(tail(i)))
    return bind(named, lambda kinds: _parts(host, labels, n, kinds, tail))


def _parts(host: Column, labels: Column, n: Column, kinds: Column, tail: Callable[[Column], Column]) -> Column:
    def has(at: Column, mark: str) -> Column:
        return F.coalesce(F.get(kinds, at).contains(mark), F.lit(False))

    def listed(kind: Column, at: Column) -> Column:
        return kind.startswith("p") | (has(at + 1, "w") & ~kind.endswith("e"))

    # Position of the first suffix label, for every suffix of the host that a rule names, from 0.
    places = F.sequence(F.lit(0), n - 1)
    hits = F.filter(places, lambda at: listed(F.get(kinds, at), at))
    # An exception rule beats any longer match: the suffix starts right after it.
    broken = F.filter(places, lambda at: (at > 0) & has(at - 1, "e"))
    hits = F.when(F.size(broken) > 0, broken).otherwise(hits)
    is_ip = host.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z")
    start = F.when(is_ip, F.lit(0)).otherwise(F.coalesce(F.array_min(hits) + 1, n + 1))

    def parts(at: Column) -> Column:
        return F.struct(
            F.array_join(F.slice(labels, F.lit(1), F.greatest(at - 2, F.lit(0))), ".").alias("subdomain"),
            F.when(at == 0, host).otherwise(F.coalesce(F.get(labels, at - 2), F.lit(""))).alias("domain"),
            F.when((at > 0) & (at <= n), tail(F.greatest(at, F.lit(1)))).otherwise(F.lit("")).alias("suffix"),
        )

    return bind(start, parts)
