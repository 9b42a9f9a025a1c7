"""Sets of integers as bits of 64-bit words: 64 neighbours are one row, and a set operation is one on bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words in which texts of different lengths meet.
_BORDERS = sorted({sign * 10**k >> 6 for k in range(1, 19) for sign in (1, -1)})


def word() -> Column:
    """The word of the integer ``v``."""
    return F.shiftright("v", 6)


def bits() -> Column:
    """Aggregate: the integers ``v`` of a word as bits."""
    return F.bit_or(F.expr("shiftleft(1L, CAST(v & 63 AS INT))"))


def apart() -> Column:
    """The integer ``v`` where its text may differ in length or marks from that of the first integer of its word, else NULL."""
    v = F.col("v")
    dated = v.between(10**7, 10**8 - 1) & (v % 10000).between(101, 1231)
    return F.when(word().isin(_BORDERS) | dated | v.between(10**13, 10**14 - 1), v)
