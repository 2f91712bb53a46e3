"""Host names outside ASCII as ``xn--`` labels: Bootstring encoding (RFC 3492) as expressions.

Names are expected in lower case and composed, as browsers send them; of the mapping of IDNA 2003 the full
stops and the letters that become others (``ß``, final sigma) are applied. Only labels outside ASCII are
touched, and a host with a label that gets longer than 63 stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.bind import bind

_DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"
_OUTSIDE = r"[^\x00-\x7F]"


def _div(a: Column, b: Column | int) -> Column:
    return F.floor(a / b).cast("long")


def _code(char: Column) -> Column:
    return F.conv(F.hex(F.encode(char, "UTF-32")), 16, 10).cast("long")


def _digits(delta: Column, bias: Column) -> Column:
    """A number of variable length, in base 36 with thresholds that follow the bias."""
    start = F.struct(delta.alias("q"), F.lit("").alias("out"), F.lit(False).alias("done"))

    def digit(acc: Column, k: Column) -> Column:
        t = F.greatest(F.lit(1), F.least(F.lit(26), k * 36 - bias))
        last = acc["q"] < t
        value = F.when(last, acc["q"]).otherwise(t + (acc["q"] - t) % (36 - t))
        more = F.struct(
            F.when(last, acc["q"]).otherwise(_div(acc["q"] - t, 36 - t)).alias("q"),
            F.concat(acc["out"], F.substr(F.lit(_DIGITS), (value + 1).cast("int"), F.lit(1))).alias("out"), last.alias("done"),
        )
        return F.when(acc["done"], acc).otherwise(more)

    return F.aggregate(F.sequence(F.lit(1), F.lit(12)), start, digit, lambda acc: acc["out"])


def _adapted(delta: Column, size: Column, first: Column) -> Column:
    damped = F.when(first, _div(delta, 700)).otherwise(_div(delta, 2))

    def settle(d: Column) -> Column:
        start = F.struct((d + _div(d, size)).alias("d"), F.lit(0).cast("long").alias("k"))
        step = lambda acc, _: F.when(acc["d"] > 455, F.struct(_div(acc["d"], 35).alias("d"), (acc["k"] + 36).alias("k"))).otherwise(acc)
        return F.aggregate(F.sequence(F.lit(1), F.lit(8)), start, step, lambda acc: acc["k"] + _div(acc["d"] * 36, acc["d"] + 38))

    return bind(damped, settle)


def _encoded(codes: Column) -> Column:
    """``xn--`` label of an array of code points."""
    basic = F.filter(codes, lambda c: c < 128)
    others = F.array_sort(F.filter(F.transform(codes, lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda x: x["c"] >= 128))
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.lit(128).cast("long").alias("n"), zero.alias("i"), F.size(basic).cast("long").alias("h"), F.lit(72).cast("long").alias("bias"),
        F.lit(True).alias("first"), F.lit("").alias("out"),
    )

    def insert(acc: Column, x: Column) -> Column:
        # Its place among the characters written before it: the smaller ones, and equal ones in front of it.
        place = F.size(F.filter(codes, lambda c, i: (i < x["i"]) & (c <= x["c"]))).cast("long")
        delta = (x["c"] - acc["n"]) * (acc["h"] + 1) + place - acc["i"]
        return bind(delta, lambda d: F.struct(
            x["c"].alias("n"), (place + 1).alias("i"), (acc["h"] + 1).alias("h"), _adapted(d, acc["h"] + 1, acc["first"]).alias("bias"),
            F.lit(False).alias("first"), F.concat(acc["out"], _digits(d, acc["bias"])).alias("out"),
        ))

    text = F.array_join(F.transform(basic, lambda c: F.char(c)), "")
    return F.concat(F.lit("xn--"), text, F.when(F.size(basic) > 0, F.lit("-")).otherwise(F.lit("")), F.aggregate(others, start, insert, lambda acc: acc["out"]))


def ascii_host(host: Column) -> Column:
    """A lower-case host with its labels outside ASCII encoded."""

    def label(text: Column) -> Column:
        codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), _code)
        return F.when(text.rlike(_OUTSIDE), bind(codes, _encoded)).otherwise(text)

    mapped = F.replace(F.translate(host, "。．｡ς", "...σ"), F.lit("ß"), F.lit("ss"))
    labels = F.transform(F.split(mapped, r"\."), label)
    whole = bind(labels, lambda found: F.when(F.exists(found, lambda x: x.startswith("xn--") & (F.length(x) > 63)), host).otherwise(F.array_join(found, ".")))
    return F.when(host.rlike(_OUTSIDE), whole).otherwise(host)
