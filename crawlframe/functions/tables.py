"""Look-up tables inside expressions: a probe looks at one slot, whatever the size of the table.

Maps and arrays are searched from their beginning. Here keys are dealt into slots by their CRC-32, each slot
a short text of ``key`` and ``value`` between control characters.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlframe.functions.bind import bind

# Between slots, in front of a key, and between key and value.
SLOT, KEY, VALUE = "\x1d", "\x1e", "\x1f"


def slot_of(key: Column, size: Column | int) -> Column:
    return (F.crc32(key.cast("binary")) % size).cast("int")


def probe(slots: Column, size: Column | int, key: Column) -> Column:
    """Value of the key in an array of slots, the last one if it has several; NULL if it has none."""

    def found(text: Column) -> Column:
        slot, mark = F.get(slots, slot_of(text, size)), F.concat(F.lit(KEY), text, F.lit(VALUE))
        value = F.substring_index(F.call_function("substring_index", slot, mark, F.lit(-1)), KEY, 1)
        return F.when(slot.contains(mark), value)

    return bind(key, found)


def literal_table(values: Mapping[str, str]) -> Callable[[Column], Column]:
    """A function of a key column, NULL for keys that are not in ``values``. Values must not hold the control characters above.

    Keys stand in the table as hexadecimal text, so they may hold any character. The table is one literal, split when the plan's constants are folded. A literal for each entry would have
    to be built and sent to the plan one by one.
    """
    size = 1 << max(1, len(values)).bit_length()
    slots = [""] * size
    for key, value in values.items():
        key = key.encode().hex().upper()
        slots[zlib.crc32(key.encode()) % size] += f"{KEY}{key}{VALUE}{value}"
    joined = SLOT.join(slots)
    return lambda key: probe(F.split(F.lit(joined), SLOT, -1), size, F.hex(key))
