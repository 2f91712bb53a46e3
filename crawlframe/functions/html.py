"""Links and images of a page, by regular expression.

An approximation of a tree parser, made in one pass over the text: comments, scripts, styles, titles
and text areas are consumed and give nothing, tags and attributes are matched without regard to case,
attributes are walked over one by one, values may be quoted with either quote or bare, and the first
such attribute of a tag counts.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.bind import bind
from crawlframe.functions.tables import literal_table

_SKIPPED = "|".join([r"!--.*?(?:-->|\z)", *[rf"{tag}\b.*?(?:</{tag}|\z)" for tag in ("script", "style", "textarea", "title")]])
#: Named references, most with their semicolon, from the standard library's table.
_NAMED = literal_table(html5)
# Characters 128 to 159, and what numbers of this range mean, where Windows-1252 has them.
_KNOWN = {n: bytes([n]).decode("cp1252", "ignore") for n in range(128, 160)}
_C1, _WINDOWS = ("".join(t) for t in zip(*[(chr(n), c) for n, c in _KNOWN.items() if c], strict=True))
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""


def _attribute_pattern(tags: str, attribute: str) -> str:
    # Other attributes are walked over one by one, each with its value, and never given back.
    other = rf"""[\s/]++(?!{attribute}\s*+=)[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
    return rf"(?is)<(?:{_SKIPPED}|(?:{tags})(?:{other})*+[\s/]++{attribute}\s*+=\s*+{_VALUE})"


LINK_PATTERN = _attribute_pattern("a", "href")
IMAGE_PATTERN = _attribute_pattern("img|image", "src")


def _code_point(number: Column) -> Column:
    """The character of a numeric reference; what is none is U+FFFD, and 128 to 159 mean the characters of Windows-1252."""
    bad = number.isNull() | (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    held = F.lpad(F.hex(F.when(bad, F.lit(0xFFFD)).otherwise(number)), 8, "0")
    return F.translate(F.decode(F.unhex(held), "UTF-32"), _C1, _WINDOWS)


def _reference(rest: Column) -> Column:
    """What stands for an ampersand and the text up to the next one."""
    decimal = F.regexp_extract(rest, "^#0*+([0-9]++)", 1)
    hexadecimal = F.regexp_extract(rest, "^#[xX]0*+([0-9A-Fa-f]++)", 1)
    # Zero is the number whose digits all went with the leading ones.
    number = (
        F.when(rest.rlike("^#0++(?![0-9])|^#[xX]0++(?![0-9A-Fa-f])"), F.lit(0))
        .when(F.length(decimal).between(1, 7), decimal.try_cast("int"))
        .when(F.length(hexadecimal).between(1, 6), F.conv(F.when(F.length(hexadecimal) <= 6, hexadecimal), 16, 10).try_cast("int"))
    )
    after_number = F.regexp_replace(rest, "^#(?:[xX][0-9A-Fa-f]++|[0-9]++);?", "")
    name = F.regexp_extract(rest, "^([A-Za-z][A-Za-z0-9]*+;?+)", 1)
    # Old names count without a semicolon, but not in front of an equals sign, where they are a query's.
    value = F.when(~rest.rlike("^[A-Za-z0-9]++="), _NAMED(name))
    return (
        F.when(rest.rlike("^#(?:[0-9]|[xX][0-9A-Fa-f])"), F.concat(_code_point(number), after_number))
        .otherwise(bind(value, lambda v: F.when(v.isNull(), F.concat(F.lit("&"), rest)).otherwise(F.concat(v, F.substr(rest, F.length(name) + 1)))))
    )


def decode_entities(text: Column) -> Column:
    """Decode the character references of an attribute value, in one pass: numbers, and the names of HTML.

    A name without a semicolon counts if HTML has it so and no letter, digit or equals sign follows.
    """
    decoded = bind(
        F.split(text, "&", -1),
        lambda parts: F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), _reference), "")),
    )
    return F.when(F.instr(text, "&") == 0, text).otherwise(decoded)


def _unquoted(raw: Column) -> Column:
    quoted = raw.startswith('"') | raw.startswith("'")
    inner = F.substr(raw, F.lit(2), F.length(raw) - 2)
    return decode_entities(F.when(quoted, inner).otherwise(raw))


def _attribute_values(html: Column, pattern: str) -> Column:
    found = F.filter(F.regexp_extract_all(html, F.lit(pattern), 1), lambda v: v != "")
    return F.transform(found, _unquoted)


def extract_links(html: Column) -> Column:
    """``href`` of every anchor in page order; an empty attribute gives an empty text."""
    return _attribute_values(html, LINK_PATTERN)


def extract_images(html: Column) -> Column:
    """``src`` of every image in page order."""
    return _attribute_values(html, IMAGE_PATTERN)
