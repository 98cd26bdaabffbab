"""Calendar parts and time gaps, in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def calendar_parts(when: Column, prefix: str = "Transaction") -> dict[str, Column]:
    """Hour, day of week (Monday is 0), month and year; null gives 0."""
    parts = {"Hour": F.hour(when), "DayOfWeek": F.weekday(when), "Month": F.month(when), "Year": F.year(when)}
    return {prefix + name: F.coalesce(part, F.lit(0)).cast("int") for name, part in parts.items()}


def gap_days(start: Column, end: Column) -> Column:
    """Fractional days from start to end, null when either is null."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(DAY_MICROS))


def non_negative(value: Column) -> Column:
    """Negative or null becomes 0.0."""
    return F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def month_start(when: Column) -> Column:
    return F.date_trunc("month", when)
