"""Dotted network addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: largest double below 2^63, so that absurd parts saturate instead of failing.
_LONG_LIMIT = 9.223372036854774e18


def _octet(parts: Column, index: int) -> Column:
    value = F.get(parts, F.lit(index))
    # Java reads '12d' and '12f' as numbers; those are text here.
    number = F.when(~value.rlike(r"(?i)[df]\s*$"), value).try_cast("double").try_cast("long")
    return F.coalesce(number, F.lit(0).cast("long")).cast("double")


def ip_to_int(address: Column, encoding: str = "dotted") -> Column:
    """``a.b.c.d`` as ``a*2^24 + b*2^16 + c*2^8 + d``.

    Missing and unreadable parts count as 0, further parts are ignored, parts are not
    range-checked and null stays null. ``encoding='numeric'`` reads an address that is
    already a number and keeps its integer part.
    """
    text = address.cast("string")
    if encoding == "numeric":
        return F.when(text.isNotNull(), F.coalesce(text.try_cast("double").try_cast("long"), F.lit(0).cast("long")))
    if encoding != "dotted":
        raise ValueError(f"unknown address encoding {encoding!r}")
    parts = F.split(text, r"\.")
    total = (
        _octet(parts, 0) * F.lit(float(1 << 24))
        + _octet(parts, 1) * F.lit(float(1 << 16))
        + _octet(parts, 2) * F.lit(float(1 << 8))
        + _octet(parts, 3)
    )
    bounded = F.greatest(F.least(total, F.lit(_LONG_LIMIT)), F.lit(-_LONG_LIMIT))
    return F.when(text.isNotNull(), bounded.cast("long"))
