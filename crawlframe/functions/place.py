"""Two order columns as one number.

The minimum of a fixed-size number per group is kept in a hash table while rows arrive; a struct
would have to be sorted by group first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above any 64-bit number, so that the lower column never runs into the higher one.
_RANGE = Decimal(10) ** 19


def place(high: Column, low: Column) -> Column:
    """Number that orders by (high, low), both whole numbers, ``low`` not negative."""
    return (high.cast("decimal(19,0)") * F.lit(_RANGE) + low.cast("decimal(19,0)")).cast("decimal(38,0)")


def place_low(number: Column) -> Column:
    return F.pmod(number, F.lit(_RANGE)).cast("long")


def place_high(number: Column) -> Column:
    return F.floor((number - F.pmod(number, F.lit(_RANGE))) / F.lit(_RANGE)).cast("long")
