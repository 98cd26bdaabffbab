"""Lenient conversions: what cannot be read becomes null or a stated default, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: time given to rows whose timestamp cannot be read.
EPOCH = "1970-01-01 00:00:00"

# Java reads '12d' and '12f' as numbers; those are text here.
_JAVA_NUMBER_SUFFIX = r"(?i)[0-9.][df]\s*$"


def number_or_null(column: Column, data_type: T.DataType) -> Column:
    """Double value of a column; unreadable text and NaN become null."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(None).cast("double")
    if isinstance(data_type, T.StringType):
        value = F.when(~column.rlike(_JAVA_NUMBER_SUFFIX), column).try_cast("double")
    else:
        value = column.cast("double")
    return F.when(~F.isnan(value), value)


def number_or_zero(column: Column, data_type: T.DataType) -> Column:
    return F.coalesce(number_or_null(column, data_type), F.lit(0.0))


# Layouts tried in turn, after ISO text. Month before day where both could be meant.
TIME_FORMATS = (
    "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy",
    "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm", "yyyy/M/d",
    "d-MMM-yyyy H:mm:ss", "d-MMM-yyyy H:mm", "d-MMM-yyyy", "d MMM yyyy H:mm:ss", "d MMM yyyy", "MMM d, yyyy",
    "d.M.yyyy H:mm:ss", "d.M.yyyy H:mm", "d.M.yyyy", "yyyyMMdd HHmmss", "yyyyMMdd",
)


def timestamp_or_null(column: Column, data_type: T.DataType, formats: Sequence[str] = TIME_FORMATS) -> Column:
    """Timestamp of a column; text is read as ISO first, then by the first of ``formats`` that fits."""
    if isinstance(data_type, T.TimestampType):
        return column
    if not isinstance(data_type, T.StringType):
        return column.try_cast("timestamp")
    text = F.trim(column)
    # Eight digits alone would be read as a year by the cast.
    plain = F.when(~text.rlike(r"^\d{5,}"), text).try_cast("timestamp")
    return F.coalesce(plain, *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def timestamp_or_epoch(column: Column, data_type: T.DataType) -> Column:
    return F.coalesce(timestamp_or_null(column, data_type), F.lit(EPOCH).cast("timestamp"))


def epoch_seconds(column: Column) -> Column:
    """Whole seconds since 1970 as a double, rounded down; null becomes 0."""
    whole = F.floor(F.unix_micros(column.cast("timestamp")) / F.lit(1_000_000))
    return F.coalesce(whole.cast("double"), F.lit(0.0))


def clean_zero(column: Column) -> Column:
    """Turn -0.0 into 0.0 so equal results also look equal."""
    return column + F.lit(0.0)
