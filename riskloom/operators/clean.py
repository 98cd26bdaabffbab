"""Cleaning and column housekeeping: duplicates, types, nulls, names, labels and ids."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import coerce
from riskloom.operators import modes, quantiles

# Names used after renaming, and the text put in place of missing text.
CANONICAL_NAMES = {
    "user_id": "CustomerId",
    "purchase_value": "Amount",
    "purchase_time": "TransactionStartTime",
}
MISSING_TEXT = "missing_value"

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def numeric_columns(df: DataFrame, wanted: Sequence[str] | None = None) -> list[str]:
    """Numeric columns in frame order, or those of ``wanted`` that exist and are numeric."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return numeric if wanted is None else [name for name in wanted if name in numeric]


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of rows equal in every column; nulls equal each other.

    Equal rows are merged on the map side first, so many copies of one row shuffle as few.
    """
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: rows before, rows after, rows removed, columns, and whether any null is left."""
    grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    has_null = F.greatest(*[F.col(c).isNull().cast("int") for c in df.columns], F.lit(0))
    return grouped.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).cast("long").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).cast("long").alias("rows_removed"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.coalesce(F.max(has_null), F.lit(0)).cast("int").alias("any_null"),
    )


def correct_types(df: DataFrame, time_columns: Iterable[str] = (), number_columns: Iterable[str] = ()) -> DataFrame:
    """Times to timestamp (unreadable: 1970-01-01) and numbers to double (unreadable: 0.0)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {
        name: coerce.timestamp_or_epoch(F.col(name), types[name]) for name in time_columns if name in types
    }
    changed |= {name: coerce.number_or_zero(F.col(name), types[name]) for name in number_columns if name in types}
    return df.withColumns(changed) if changed else df


def ensure_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Every numeric, boolean and text column to double with failures 0.0; times to unix seconds."""
    kept = set(exclude)
    changed = {}
    for field in df.schema.fields:
        if field.name in kept:
            continue
        if isinstance(field.dataType, _TIME_TYPES):
            changed[field.name] = coerce.epoch_seconds(F.col(field.name))
        elif isinstance(field.dataType, (T.NumericType, T.StringType, T.BooleanType)):
            changed[field.name] = coerce.number_or_zero(F.col(field.name), field.dataType)
    return df.withColumns(changed) if changed else df


def fill_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null or NaN numbers become 0.0 and null text becomes ``missing_value``."""
    return df.fillna(0.0, subset=columns).fillna(MISSING_TEXT, subset=columns)


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls in feature columns become 0."""
    return df.fillna(0.0, subset=list(columns))


def fill_for_scoring(
    df: DataFrame, columns: Sequence[str] | None = None, numbers_from_text: Sequence[str] = ()
) -> DataFrame:
    """Last safeguard before scoring.

    Columns in ``numbers_from_text`` become numbers, failures 0.0. Then null numbers take
    the column median and null text the most frequent value, or ``missing``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if numbers_from_text:
        df = df.withColumns({c: coerce.number_or_zero(F.col(c), types[c]) for c in numbers_from_text})
    names = list(columns) if columns is not None else df.columns
    numbers = [c for c in numeric_columns(df, names) if c not in numbers_from_text]
    texts = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
    medians = quantiles.exact_quantiles(df, numbers, [0.5]) if numbers else {}
    frequent = modes.most_frequent(df, texts) if texts else {}
    filled = {}
    for name in numbers:
        value = F.col(name).cast("double")
        middle = medians[name][0.5]
        filled[name] = F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0 if middle is None else middle))
    for name in texts:
        most = frequent.get(name)
        filled[name] = F.coalesce(F.col(name), F.lit("missing" if most is None else most))
    return df.withColumns(filled) if filled else df


def rename_known(df: DataFrame, names: Mapping[str, str] = CANONICAL_NAMES) -> DataFrame:
    """Rename by mapping; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def label_to_int(df: DataFrame, label: str) -> DataFrame:
    """Integer label, kept in the same row as the features."""
    return df.withColumn(label, F.col(label).cast("int"))


def add_missing_columns(df: DataFrame, defaults: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add absent columns as ``name: (default value, type)``; present ones are left alone."""
    absent = {c: F.lit(value).cast(kind) for c, (value, kind) in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


# What a scoring frame may lack and what stands in for it.
SCORING_DEFAULTS = {
    "signup_time": (None, "timestamp"),
    "ip_address": (None, "string"),
    "country": ("Unknown", "string"),
}


def training_ids(df: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Training rows carry the user as their transaction id."""
    return df.withColumn("TransactionId", F.col(user_col)) if user_col in df.columns else df


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """Number the rows 0, 1, 2, … in input order.

    One pass counts the rows of each input partition; those few counts become offsets for
    the numbering inside the partitions. Meant for frames read straight from files, whose
    row order is stable.
    """
    within = F.monotonically_increasing_id()
    shift = F.shiftright(within, 33).cast("long")
    counts = df.select(shift.alias("part")).groupBy("part").count()
    # One row per input partition, so one task is enough for the running total.
    running = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("part").alias("__part"), F.coalesce(running, F.lit(0)).alias("__offset"))
    marked = df.withColumns({"__part": shift, "__within": within.bitwiseAND((1 << 33) - 1)})
    return (
        marked.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__within"))
        .select(*df.columns, name)
    )


def scoring_ids(df: DataFrame, dataset: str, row_key: str | None = None, user_col: str = "user_id") -> DataFrame:
    """Customer and transaction ids for rows to be scored.

    ``row_key`` names a column that numbers the rows. Without one, rows are numbered by
    their place in the input, which takes an extra pass to count the rows per partition.
    """
    if dataset not in ("ecommerce", "card"):
        raise ValueError(f"unknown dataset {dataset!r}")
    by_user = dataset == "ecommerce" and user_col in df.columns
    wanted = [c for c in ("TransactionId", "CustomerId") if dataset == "ecommerce" or c not in df.columns]
    if not wanted:
        return df
    numbered, number = df, row_key
    if number is None:
        number = "__row_number"
        numbered = number_rows(df, number)
    place = F.col(number).cast("string")

    def made(prefix: str) -> Column:
        return F.concat(F.lit(prefix), place)

    if by_user:
        user = F.coalesce(F.col(user_col).cast("string"), F.lit("nan"))
        ids = {
            "CustomerId": user,
            "TransactionId": F.concat_ws("_", user, place),
        }
    elif dataset == "ecommerce":
        ids = {"CustomerId": made("CUST_"), "TransactionId": made("TXN_")}
    else:
        ids = {"CustomerId": made("CC_CUST_"), "TransactionId": made("CC_TXN_")}
    out = numbered.withColumns({name: ids[name] for name in wanted})
    return out if row_key is not None else out.drop(number)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null (or NaN) in any of the columns are left out."""
    return df.na.drop(subset=list(columns))


def outside(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows strictly below ``low`` or strictly above ``high``."""
    value = F.col(column)
    return df.where((value < F.lit(low)) | (value > F.lit(high)))
