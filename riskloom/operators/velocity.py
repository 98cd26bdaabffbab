"""How often and for how much an id was active in the days before each transaction.

For a row at time t and a window of w days the frame is [t - w, t): rows exactly w earlier
count, the row itself and rows at the same instant do not.

Time is cut into chunks and each frame is split into

* the head: rows of the same chunk before t,
* whole chunks before it, from the chunk w earlier on, from one total per id and chunk,
* less what lies in the chunk w earlier before t - w.

Rows are first merged per (id, instant), so many rows at one instant count as one. A copy of
each, moved w later, brings the chunk w earlier into the chunk of t; head and what is taken off are then plain running
sums over (id, chunk), in one order. One very active id is thereby spread over as many tasks as it has
chunks, and the work is linear in the rows. This is the way at every size: no answer depends on
how busy an id is.

All id columns are worked on at once, as narrow (id, instant, amount) rows. Their measures come back
to the wide rows in a single join, on the ids and the instant together. Amounts are summed as whole units,
so a total does not depend on the order of the rows.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import coerce
from riskloom.functions.calendar import DAY_MICROS

log = logging.getLogger(__name__)

# Windows in days, and the names of the three measures.
WINDOW_DAYS = (1, 7, 30)
MEASURES = ("transactions", "total_amount", "avg_amount")


def feature_names(id_col: str, windows: Sequence[int] = WINDOW_DAYS) -> list[str]:
    return [f"{id_col}_{measure}_last_{w}d" for w in windows for measure in MEASURES]


# Decimals kept of amounts unless told otherwise.
MONEY_SCALE = 6


def _measures(id_col: str, w: int, count: Column, total: Column, money_scale: int) -> dict[str, Column]:
    total = total.cast("double") / F.lit(float(10**money_scale))
    average = F.when(count > 0, total / count).otherwise(F.lit(0.0))
    return dict(zip(feature_names(id_col, [w]), (count.cast("long"), total, average)))


def _by_frames(df: DataFrame, id_col: str, windows: Sequence[int], money_scale: int) -> DataFrame:
    """Range frames over ``__when`` and ``__amount``; rows without an id are spread by their time."""
    known = F.col(id_col).isNotNull() & F.col("__when").isNotNull()
    spread = F.when(~known, F.pmod(F.xxhash64("__when", "__amount"), F.lit(4_096)))
    measures = {}
    for w in windows:
        frame = Window.partitionBy(id_col, spread).orderBy("__when").rangeBetween(-w * DAY_MICROS, -1)
        count = F.when(known, F.count(F.lit(1)).over(frame)).otherwise(F.lit(0))
        total = F.coalesce(F.when(known, F.sum("__amount").over(frame)), F.lit(0))
        measures |= _measures(id_col, w, count, total, money_scale)
    return df.withColumns(measures)


def chunk_micros(chunk_minutes: int) -> int:
    chunk = chunk_minutes * 60_000_000
    if DAY_MICROS % chunk:
        raise ValueError("chunk_minutes must divide a day")
    return chunk


def chunk_of(position: Column, chunk: int) -> Column:
    return F.floor(position / F.lit(chunk)).cast("long")


def merged_instants(activity: DataFrame) -> DataFrame:
    """Counts and sums per id and instant; map-side merging keeps repeated instants cheap."""
    return activity.groupBy("__id", "__at").agg(F.count(F.lit(1)).alias("n"), F.sum("__amount").alias("s"))


def chunk_totals(merged: DataFrame, chunk: int) -> DataFrame:
    """One total per id and chunk: bounded by the time covered, not by the rows."""
    return merged.groupBy("__id", chunk_of(F.col("__at"), chunk).alias("chunk")).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def frames(merged: DataFrame, totals: DataFrame, windows: Sequence[int], money_scale: int, chunk: int) -> DataFrame:
    """(id, instant) with the measures of every window.

    ``merged`` has the instants, ``totals`` the chunks. Only instants whose own chunk, and whose chunks a window earlier, are
    complete in ``merged`` get right measures.
    """
    per_day = DAY_MICROS // chunk
    # Copy 0 is the row itself, copy w the row moved w days later.
    copies = F.array(
        *[
            F.struct(F.lit(w).alias("moved"), (F.col("__at") + F.lit(w * DAY_MICROS)).alias("place"))
            for w in (0, *windows)
        ]
    )
    placed = merged.select("__id", "n", "s", F.inline(copies)).withColumn("chunk", chunk_of(F.col("place"), chunk))
    # Ids of a column begin alike, so sorting by them compares whole texts; a number tells most pairs apart at once.
    number = F.xxhash64("__id", "chunk")
    placed = placed.withColumn("__number", number)
    group = ("__number", "__id", "chunk")
    earlier = Window.partitionBy(*group).orderBy("place").rangeBetween(Window.unboundedPreceding, -1)

    def only(moved: int, column: str):
        return F.when(F.col("moved") == moved, F.col(column))

    edges = placed.withColumns({f"before_{m}_{moved}": F.sum(only(moved, m)).over(earlier) for moved in (0, *windows) for m in ("n", "s")})
    edges = edges.where("moved = 0")

    by_chunk = Window.partitionBy("__id").orderBy("chunk")

    def whole(measure: str, w: int) -> Column:
        # Whole numbers: the difference of two running sums is exact and takes one step per chunk.
        upto = F.sum(measure).over(by_chunk.rangeBetween(Window.unboundedPreceding, -1))
        gone = F.sum(measure).over(by_chunk.rangeBetween(Window.unboundedPreceding, -w * per_day - 1))
        return F.coalesce(upto, F.lit(0)) - F.coalesce(gone, F.lit(0))

    middle = totals.select(
        "__id", "chunk", number.alias("__number"), *[whole(m, w).alias(f"whole_{m}_{w}") for w in windows for m in ("n", "s")]
    )
    # The three joins here are merged: sizes are estimated from the files of the input, of which the ids are a small part, and
    # a table with a row per id and instant would be taken for a small one and broadcast.
    joined = edges.join(middle.hint("merge"), list(group))

    def frame(measure: str, w: int):
        head, skipped = (F.coalesce(F.col(f"before_{measure}_{moved}"), F.lit(0)) for moved in (0, w))
        return head + F.col(f"whole_{measure}_{w}") - skipped

    columns = []
    for w in windows:
        measures = _measures("", w, frame("n", w), frame("s", w), money_scale)
        columns += [value.alias(name) for name, value in measures.items()]
    return joined.select("__id", F.col("place").alias("__at"), *columns)


def add_velocity(
    df: DataFrame,
    id_cols: Sequence[str],
    time_col: str = "TransactionStartTime",
    amount_col: str = "Amount",
    windows: Sequence[int] = WINDOW_DAYS,
    money_scale: int | None = None,
    chunk_minutes: int = 60,
    history: DataFrame | None = None,
    frame_rows: int = 0,
) -> DataFrame:
    """Add count, total and mean of earlier amounts per id column and window.

    Rows with a null id or time get zeros. Without the time column nothing is added; without the
    amount column amounts are 0.0; id columns that are absent are left out, and when all of them
    are absent their features are 0. Amounts are summed as whole units of ``money_scale`` decimals
    (``MONEY_SCALE`` by default), which makes totals independent of the order of the rows. ``history``
    holds earlier transactions that count but do not come out. ``frame_rows`` above 0 is the
    caller's word that no id has more rows than a task can sort: plain range frames are used then,
    with the same results. Nothing is ever chosen by looking at the data.
    """
    money_scale = MONEY_SCALE if money_scale is None else money_scale
    if time_col not in df.columns:
        log.error("no time column %s; velocity features are not added", time_col)
        return df
    if amount_col not in df.columns:
        log.error("no amount column %s; amounts count as 0", amount_col)
        df = df.withColumn(amount_col, F.lit(0.0))
    types = {f.name: f.dataType for f in df.schema.fields}
    df = df.withColumns(
        {
            time_col: coerce.timestamp_or_null(F.col(time_col), types[time_col]).cast("timestamp"),
            amount_col: coerce.number_or_zero(F.col(amount_col), types[amount_col]),
        }
    )
    present = [c for c in id_cols if c in df.columns]
    if not present:
        log.warning("none of the id columns %s exists; velocity features are 0", list(id_cols))
        zeros = [F.lit(0).cast("long"), F.lit(0.0), F.lit(0.0)] * len(windows)
        names = [n for c in id_cols for n in feature_names(c, windows)]
        return df.withColumns(dict(zip(names, zeros * len(id_cols))))

    def timed(frame: DataFrame) -> DataFrame:
        return with_instants(frame, time_col, amount_col, money_scale)

    if frame_rows > 0 and history is None:
        out = timed(df)
        for id_col in present:
            out = _by_frames(out, id_col, windows, money_scale)
        return out.drop("__when", "__amount")

    rows = activity_of(timed(df), present, types)
    if history is not None:
        rows = rows.unionByName(activity_of(timed(history), present, types))
    chunk = chunk_micros(chunk_minutes)
    merged = merged_instants(rows)
    features = frames(merged, chunk_totals(merged, chunk), windows, money_scale, chunk)
    return looked_up(timed(df), df.columns, features, present, types, windows)


def with_instants(frame: DataFrame, time_col: str, amount_col: str, money_scale: int) -> DataFrame:
    """``__when`` in microseconds and ``__amount`` in whole units."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    when = coerce.timestamp_or_null(F.col(time_col), kinds[time_col]).cast("timestamp")
    amount = coerce.number_or_zero(F.col(amount_col), kinds[amount_col])
    amount = F.round(amount * F.lit(float(10**money_scale))).cast("long")
    return frame.withColumns({"__when": F.unix_micros(when), "__amount": amount})


def id_key(column: str, types: Mapping[str, object]) -> Column:
    """An id as text after its column's name; null for a null."""
    return F.concat(F.lit(f"{column}:"), F.col(column).cast(types[column]).cast("string"))


def activity_of(timed: DataFrame, id_cols: Sequence[str], types: Mapping[str, object]) -> DataFrame:
    """Narrow rows (id, instant, amount), one per id column that is known."""
    pairs = F.array(*[F.struct(id_key(c, types).alias("__id")) for c in id_cols])
    narrow = timed.where("__when is not null").select(F.col("__when").alias("__at"), "__amount", F.inline(pairs))
    return narrow.where("__id is not null")


def looked_up(
    out: DataFrame, columns: Sequence[str], features: DataFrame, present: Sequence[str], types: Mapping[str, object], windows: Sequence[int]
) -> DataFrame:
    """The rows (with ``__when``) and the measures of their ids at their instant; zeros where there are none."""
    names = [n for c in present for n in feature_names(c, windows)]
    if len(present) == 1:
        renamed = dict(zip(feature_names("", windows), names))
        features = features.withColumnsRenamed({**renamed, "__at": "__when", "__id": "__key_0"})
        out = out.withColumn("__key_0", id_key(present[0], types)).join(features.hint("merge"), ["__when", "__key_0"], "left")
        return with_zeros(out, columns, names)
    # Rows with the same ids and instant share their measures: each combination is looked up once.
    keys = [f"__key_{i}" for i in range(len(present))]
    out = out.withColumns({k: F.coalesce(id_key(c, types), F.lit("")) for k, c in zip(keys, present)})
    combined = out.where("__when is not null").select("__when", *keys).distinct()
    pairs = F.array(*[F.struct(F.lit(i).alias("__place"), F.col(k).alias("__id")) for i, k in enumerate(keys)])
    looked = combined.select("__when", *keys, F.col("__when").alias("__at"), F.inline(pairs)).join(features.hint("merge"), ["__at", "__id"])
    wide = looked.groupBy("__when", *keys).agg(
        *[
            F.max(F.when(F.col("__place") == i, F.col(f))).alias(n)
            for i, c in enumerate(present)
            for f, n in zip(feature_names("", windows), feature_names(c, windows))
        ]
    )
    return with_zeros(out.join(wide.hint("merge"), ["__when", *keys], "left"), columns, names)


def with_zeros(out: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    zero = {n: (F.lit(0).cast("long") if "_transactions_last_" in n else F.lit(0.0)) for n in names}
    return out.select(*[F.col("`" + c.replace("`", "``") + "`") for c in columns], *[F.coalesce(F.col(n), zero[n]).alias(n) for n in names])
