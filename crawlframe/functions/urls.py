"""URL splitting, canonicalisation, link resolution and host keys.

Canonical form: host in lower case, fragment dropped, query pairs sorted and re-encoded, path
escapes normalised, ``https`` folded to ``http`` and ``http://`` put in front of anything else.
Non-ASCII host names are kept as they are (no IDNA encoding).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.idna import ascii_host

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"

# Characters that stand for themselves, as regular-expression classes.
_UNRESERVED = r"A-Za-z0-9_.~\-"
_PATH_SAFE = _UNRESERVED + r":/?\[\]@!$&'()*+,;=|"

# Escapes that a canonical path keeps: of bytes above ASCII and of characters that are not safe.
_KEPT_ESCAPE = "%(?:[89A-F][0-9A-F]|[01][0-9A-F]|2[0235F]|3[CEF]|5[CE]|60|7[BDF])"
# The quantifiers on groups are possessive: matched without recursion, however long the text. The
# end is \z, since $ would leave out a last line end.
_SETTLED_PATH = f"[{_PATH_SAFE}]*+(?:{_KEPT_ESCAPE}[{_PATH_SAFE}]*+)*+"
_SETTLED_QUERY = f"[{_UNRESERVED}]++=[{_UNRESERVED}]*+(?:&[{_UNRESERVED}]++=[{_UNRESERVED}]*+)*+"
# An http(s) URL that needs no more than its scheme folded and its query pairs sorted.
_SETTLED_URL = rf"^https?://[a-z0-9.\-]+(?::[0-9]+)?/{_SETTLED_PATH.replace('/?', '/')}(?:\?{_SETTLED_QUERY})?\z"


def _after(text: Column, mark: str) -> Column:
    """Text after the first ``mark``; empty if there is none."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substr(text, at + F.lit(len(mark)))).otherwise(F.lit(""))


def _cleaned(url: Column) -> Column:
    return F.ltrim(F.translate(url, "\t\r\n", ""))


def _byte(digits: Column) -> Column:
    """The byte written as two hex digits, as a Latin-1 character."""
    return F.decode(F.unhex(digits), "ISO-8859-1")


def _map_pieces(encoded: Column, rewrite) -> Column:
    """Rewrite the pieces of a text behind its percent signs; the one before the first stays."""
    done = F.transform(F.split(encoded, "%"), lambda p, i: F.when(i == 0, p).otherwise(rewrite(p)))
    return F.array_join(done, "")


def _settle_escapes(encoded: Column, plain: str, unescaped: str, space: str) -> Column:
    """Final form of a text that was percent-encoded as a whole.

    An escape of the text before that step shows as ``%25XX``. Characters of the class ``plain``
    are restored, escapes of the class ``unescaped`` decoded (a space as ``space``), the others
    kept in upper case.
    """

    def rewrite(piece: Column) -> Column:
        was_escape = piece.rlike("^25[0-9A-Fa-f]{2}")
        digits = F.upper(F.when(was_escape, F.substring(piece, 3, 2)).otherwise(F.substring(piece, 1, 2)))
        rest = F.when(was_escape, F.substr(piece, F.lit(5))).otherwise(F.substr(piece, F.lit(3)))
        literal = F.when(was_escape, _byte(digits).rlike(f"^[{unescaped}]\\z")).otherwise(_byte(digits).rlike(f"^[{plain}]\\z"))
        kept = F.when(digits == "20", F.lit(space)).otherwise(F.concat(F.lit("%"), digits))
        return F.concat(F.when(literal, _byte(digits)).otherwise(kept), rest)

    return _map_pieces(encoded, rewrite)


def percent_decode(text: Column) -> Column:
    """UTF-8 percent-decoding that leaves malformed escapes and ``+`` alone."""
    safe = F.replace(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(F.instr(text, "%") == 0, text).otherwise(F.url_decode(safe))


def _base(url: Column) -> Column:
    """URL without query and fragment."""
    return F.substring_index(F.substring_index(_cleaned(url), "#", 1), "?", 1)


def scheme_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(_cleaned(url), f"^({_SCHEME}):", 1))


def netloc_of(url: Column) -> Column:
    return F.regexp_extract(_base(url), f"^(?:{_SCHEME}:)?//([^/]*)", 1)


def path_of(url: Column) -> Column:
    return F.regexp_replace(_base(url), f"^(?:{_SCHEME}:)?(?://[^/]*)?", "")


def query_of(url: Column) -> Column:
    return _after(F.substring_index(_cleaned(url), "#", 1), "?")


def fragment_of(url: Column) -> Column:
    return _after(_cleaned(url), "#")


def url_parts(url: Column) -> Column:
    """Struct of scheme, netloc, path, query and fragment, each empty if absent."""
    return F.struct(
        scheme_of(url).alias("scheme"),
        netloc_of(url).alias("netloc"),
        path_of(url).alias("path"),
        query_of(url).alias("query"),
        fragment_of(url).alias("fragment"),
    )


def _canonical_host(netloc: Column, url: Column) -> Column:
    """Lower-case the host after the last ``@``, drop trailing colons, and encode labels outside ASCII."""
    with_user = F.concat(
        F.regexp_extract(netloc, r"(?s)^(.*@)", 1), ascii_host(F.rtrim(F.lower(F.substring_index(netloc, "@", -1)), F.lit(":")))
    )
    lower = F.rtrim(F.lower(netloc), F.lit(":"))
    host = F.when(netloc.rlike(r"[^\x00-\x7F]"), ascii_host(lower)).otherwise(lower)
    return F.when(F.instr(url, "@") == 0, host).otherwise(with_user)


def canonical_path(path: Column) -> Column:
    """Escapes in upper-case hex, safe characters plain, everything else escaped.

    ``%2F``, ``%3F``, ``%23`` and ``%25`` stay escaped, so that the result is stable when
    canonicalised again.
    """
    encoded = F.replace(F.url_encode(path), F.lit("+"), F.lit("%20"))
    normal = _settle_escapes(encoded, _PATH_SAFE, _PATH_SAFE.replace("/?", ""), "%20")
    return F.when(path.rlike(f"^{_SETTLED_PATH}\\z"), path).otherwise(normal)


def _form_text(text: Column) -> Column:
    """Form encoding of a query name or value that may already carry escapes."""
    encoded = F.replace(F.url_encode(F.replace(text, F.lit("+"), F.lit(" "))), F.lit("*"), F.lit("%2A"))
    normal = _settle_escapes(encoded, _UNRESERVED, _UNRESERVED, "+")
    return F.when(text.rlike(f"^[{_UNRESERVED}+]*\\z"), text).otherwise(normal)


def _byte_order(form: Column) -> Column:
    """Decoded bytes of a form-encoded text as Latin-1, which sorts in byte order."""
    spaced = F.replace(form, F.lit("+"), F.lit(" "))
    decoded = _map_pieces(spaced, lambda p: F.concat(_byte(F.substring(p, 1, 2)), F.substr(p, F.lit(3))))
    return F.when(F.instr(form, "%") == 0, spaced).otherwise(decoded)


def _sorted_pairs(settled: Column) -> Column:
    """Sort the pairs of a query of unreserved characters by (name, value)."""
    pairs = F.transform(F.split(settled, "&"), lambda p: F.struct(F.substring_index(p, "=", 1).alias("name"), p.alias("text")))
    return F.when(F.instr(settled, "&") == 0, settled).otherwise(
        F.array_join(F.transform(F.array_sort(pairs), lambda s: s["text"]), "&")
    )


def canonical_query(query: Column) -> Column:
    """Pairs sorted by (name, value) of their decoded bytes; a missing value becomes empty."""
    pieces = F.filter(F.split(query, "&"), lambda p: p != "")
    named = F.transform(
        pieces,
        lambda p: F.struct(
            _form_text(F.substring_index(p, "=", 1)).alias("name"), _form_text(_after(p, "=")).alias("value")
        ),
    )
    keyed = F.transform(
        named,
        lambda s: F.struct(
            _byte_order(s["name"]).alias("k"),
            _byte_order(s["value"]).alias("v"),
            F.concat(s["name"], F.lit("="), s["value"]).alias("text"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["text"]), "&")


def _canonical_tail(path: Column, query: Column) -> Column:
    """Canonical path and query; the question mark goes if no pair is left."""
    full_path = F.when(path == "", F.lit("/")).otherwise(canonical_path(path))
    pairs = F.when(query == "", query).otherwise(
        F.regexp_replace(F.concat(F.lit("?"), canonical_query(query)), r"^\?\z", "")
    )
    return F.concat(full_path, pairs)


def _canonical_origin(url: Column) -> Column:
    """``http://``, then any scheme but http(s), then the host."""
    other = F.regexp_extract(F.lower(_base(url)), f"^(?!https?:)({_SCHEME.lower()}:(?://)?)", 1)
    return F.concat(F.lit("http://"), other, _canonical_host(netloc_of(url), url))


def canonicalize_url(url: Column, base: Column | None = None) -> Column:
    """Canonical URL; with ``base`` a URL without a host is first put on the base's host.

    Relative links resolve against the host root, not the page's directory, and a
    scheme-relative ``//host/x`` becomes ``http://host/x``.
    """
    origin, path = _canonical_origin(url), path_of(url)
    if base is not None:
        hostless = netloc_of(url) == ""
        origin = F.when(hostless, url_domain(base)).otherwise(origin)
        path = F.when(hostless, F.regexp_replace(_base(url), "^(?!/)", "/")).otherwise(path)
    plain = F.substring_index(url, "#", 1)
    rest = F.substr(plain, F.when(url.startswith("https"), F.lit(9)).otherwise(F.lit(8)))
    at = F.instr(rest, "?")
    paired = F.concat(F.substring_index(rest, "?", 1), F.lit("?"), _sorted_pairs(F.substr(rest, at + 1)))
    settled = F.concat(F.lit("http://"), F.when(at == 0, rest).otherwise(paired))
    return F.when(plain.rlike(_SETTLED_URL), settled).otherwise(F.concat(origin, _canonical_tail(path, query_of(url))))


def resolve_link(href: Column, page_url: Column) -> Column:
    """Absolute canonical URL of a link found on ``page_url``."""
    return canonicalize_url(href, page_url)


def url_domain(url: Column) -> Column:
    """Host key ``http://host[:port]``, ``www.`` kept, no trailing slash."""
    netloc = F.regexp_extract(_cleaned(url), r"^(?:[Hh][Tt][Tt][Pp][Ss]?:)?(?://)?([^/?#]*)", 1)
    plain = url.rlike(r"^https?://[a-z0-9.\-]+(?::[0-9]+)?/")
    host = F.substr(F.substring_index(url, "/", 3), F.when(url.startswith("https"), F.lit(9)).otherwise(F.lit(8)))
    return F.concat(F.lit("http://"), F.when(plain, host).otherwise(_canonical_host(netloc, url)))


def url_basename(url: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(url, "/", -1)
