"""Features computed from one row alone."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import calendar, coerce

log = logging.getLogger(__name__)

# Names of the derived columns.
REFUND = "IsRefund"
CALENDAR_FEATURES = ("TransactionHour", "TransactionDayOfWeek", "TransactionMonth", "TransactionYear")
SINCE_SIGNUP = "time_since_signup"


def add_refund_flag(df: DataFrame, amount_col: str = "Amount") -> DataFrame:
    """``IsRefund`` marks negative amounts, then the amount loses its sign."""
    if amount_col not in df.columns:
        log.warning("no amount column %s; nothing is a refund", amount_col)
        return df.withColumn(REFUND, F.lit(0))
    amount = coerce.number_or_zero(F.col(amount_col), df.schema[amount_col].dataType)
    return df.withColumns({REFUND: (amount < 0).cast("int"), amount_col: F.abs(amount)})


def add_calendar_features(
    df: DataFrame, time_col: str = "TransactionStartTime", signup_col: str = "signup_time"
) -> DataFrame:
    """Calendar parts of the transaction and days since signup (never negative)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    have_time, have_signup = time_col in types, signup_col in types
    if not have_time:
        log.warning("no time column %s; calendar features are 0", time_col)
        df = df.withColumns({name: F.lit(0) for name in CALENDAR_FEATURES})
    else:
        df = df.withColumn(time_col, coerce.timestamp_or_null(F.col(time_col), types[time_col]).cast("timestamp"))
        df = df.withColumns(calendar.calendar_parts(F.col(time_col)))
    if not (have_time and have_signup):
        log.warning("no signup or transaction time; %s is 0", SINCE_SIGNUP)
        return df.withColumn(SINCE_SIGNUP, F.lit(0.0))
    df = df.withColumn(signup_col, coerce.timestamp_or_null(F.col(signup_col), types[signup_col]).cast("timestamp"))
    gap = calendar.gap_days(F.col(signup_col), F.col(time_col))
    return df.withColumn(SINCE_SIGNUP, calendar.non_negative(gap))


def add_signup_gap_median_filled(
    df: DataFrame, time_col: str, signup_col: str, out: str = SINCE_SIGNUP
) -> DataFrame:
    """Days since signup where an unknown gap takes the median gap and a negative one becomes 0."""
    from riskloom.operators.quantiles import exact_quantiles

    types = {f.name: f.dataType for f in df.schema.fields}
    gap = calendar.gap_days(
        coerce.timestamp_or_null(F.col(signup_col), types[signup_col]).cast("timestamp"),
        coerce.timestamp_or_null(F.col(time_col), types[time_col]).cast("timestamp"),
    )
    median = exact_quantiles(df.select(gap.alias(out)), [out], [0.5])[out][0.5]
    return df.withColumn(out, calendar.non_negative(F.coalesce(gap, F.lit(median).cast("double"))))
