"""Category counts over several columns in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import written_once


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long table (feature, value, n) of non-null values, as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .where("value is not null")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value of each column, the smallest one on ties; None for an all-null column.

    Counting is an ordinary group-by, so a column with many values never sits in one buffer.
    """
    best = category_counts(df, columns).groupBy("feature").agg(
        F.min(F.struct((-F.col("n")).alias("rank"), "value")).getField("value").alias("value")
    )
    found = {row["feature"]: row["value"] for row in best.collect()}
    return {c: found.get(c) for c in columns}


def category_lists(
    df: DataFrame, columns: Sequence[str], max_categories: int | None = None
) -> tuple[dict[str, list[str]], dict[str, str | None]]:
    """Sorted distinct values and the most frequent value of each column.

    Every value becomes a column of its own, so the lists are as long as the result is wide. A
    caller may set ``max_categories`` to be told of a wider column instead.
    """
    counts = category_counts(df, columns)
    if max_categories is not None:
        counts = written_once(counts, "categories")
        wide = {r["feature"]: r["count"] for r in counts.groupBy("feature").count().collect() if r["count"] > max_categories}
        if wide:
            raise ValueError(f"too many categories for one column each: {wide}; raise max_categories if intended")
    found: dict[str, list[str]] = {c: [] for c in columns}
    best: dict[str, tuple[int, str]] = {}
    for row in counts.select("feature", "value", "n").collect():
        found[row["feature"]].append(row["value"])
        rank = (-row["n"], row["value"])
        best[row["feature"]] = min(best.get(row["feature"], rank), rank)
    most = {c: rank[1] for c, rank in best.items()}
    return {c: sorted(v) for c, v in found.items()}, {c: most.get(c) for c in columns}
