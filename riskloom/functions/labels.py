"""Scores, labels and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_at(score: Column, threshold: float = 0.5) -> Column:
    return (score >= F.lit(float(threshold))).cast("int")


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole; null when the whole is 0."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """part / whole, with 0/0 counted as 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
