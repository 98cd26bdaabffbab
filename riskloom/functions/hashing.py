"""Seeded pseudo-random numbers that depend only on a row's key.

A retried task gives the same draw, and any engine with MD5 gives the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: eight hex digits hold 32 bits.
_TWO_32 = 4294967296.0


def digest(seed: int | str, *parts: Column) -> Column:
    """32 hex digits from the seed and the key parts."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def word(hex_digest: Column, index: int = 0) -> Column:
    """The ``index``-th 32-bit word of a digest as a long."""
    return F.conv(F.substring(hex_digest, 1 + 8 * index, 8), 16, 10).cast("long")


def unit(hex_digest: Column, index: int = 0) -> Column:
    """The ``index``-th word of a digest as a double in [0, 1)."""
    return word(hex_digest, index) / F.lit(_TWO_32)
