"""Seeded, exact-size samples and splits that depend on row keys only.

Rows are ordered by an MD5 hash of seed and key. To take exactly k of a large group nothing is
sorted as a whole: counts per leading hash digits tell which bucket holds the k-th row, buckets
before it are taken whole and only that one bucket is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.hashing import digest

# Hash digits that name a bucket: 65,536 buckets per group.
BUCKET_DIGITS = 4


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows for a small ``n`` (each task keeps only its first n)."""
    order = digest(seed, *[F.col(k) for k in keys])
    return df.withColumn("__order", order).orderBy("__order", *keys).limit(n).drop("__order")


def first_per_class(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """The row with the smallest key of each class."""
    first = F.min_by(F.struct(*df.columns), F.struct(*keys)).alias("row")
    return df.groupBy(F.col(label).alias("__label")).agg(first).select("row.*")


def hash_thresholds(
    df: DataFrame, group: str, wanted: Mapping[object, int], keys: Sequence[str], seed: int | str
) -> dict[object, str | None]:
    """The largest hash among the first ``wanted[g]`` rows of each group g, None for no rows.

    Two passes over group and keys; one hash per group reaches the driver.
    """
    hashed = df.select(group, digest(seed, *[F.col(k) for k in keys]).alias("hash"))
    hashed = hashed.withColumn("bucket", F.substring("hash", 1, BUCKET_DIGITS))
    asked = {g: k for g, k in wanted.items() if k > 0}
    if not asked:
        return dict.fromkeys(wanted)
    target = F.lit(None).cast("long")
    for g, k in asked.items():
        target = F.when(F.col(group).eqNullSafe(F.lit(g)), F.lit(k)).otherwise(target)
    sizes = hashed.groupBy(group, "bucket").agg(F.count(F.lit(1)).alias("size"))
    # At most 65,536 rows per group.
    upto = F.sum("size").over(Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    sizes = sizes.withColumns({"upto": upto, "target": target})
    cuts = sizes.where("upto >= target and upto - size < target").collect()
    if len(cuts) < len(asked):
        raise ValueError(f"a group has fewer rows than wanted: {asked}")
    in_cut = F.lit(False)
    part = F.lit(None).cast("long")
    for row in cuts:
        here = F.col(group).eqNullSafe(F.lit(row[group])) & (F.col("bucket") == F.lit(row["bucket"]))
        in_cut = in_cut | here
        part = F.when(here, F.lit(row["target"] - row["upto"] + row["size"])).otherwise(part)
    # One bucket per group: 1/65,536 of its rows.
    place = F.row_number().over(Window.partitionBy(group, "bucket").orderBy("hash"))
    last = hashed.where(in_cut).withColumn("place", place).where(F.col("place") == part)
    found = {row[group]: row["hash"] for row in last.collect()}
    return {g: found.get(g) for g in wanted}


def is_chosen(df: DataFrame, group: str, wanted: Mapping[object, int], keys: Sequence[str], seed: int | str) -> Column:
    """A flag that is true for exactly ``wanted[g]`` rows of each group g, by a comparison per row; it can be taken of any frame with
    the group and the keys."""
    thresholds = hash_thresholds(df, group, wanted, keys, seed)
    limit = F.lit(None).cast("string")
    for g, threshold in thresholds.items():
        limit = F.when(F.col(group).eqNullSafe(F.lit(g)), F.lit(threshold)).otherwise(limit)
    order = digest(seed, *[F.col(k) for k in keys])
    return F.coalesce(order <= limit, F.lit(False))


def mark_chosen(
    df: DataFrame, group: str, wanted: Mapping[object, int], keys: Sequence[str], seed: int | str, out: str = "chosen"
) -> DataFrame:
    """Add a flag that is true for exactly ``wanted[g]`` rows of each group g, by a comparison per row.

    Keys must identify a row. Groups that are not named get none.
    """
    return df.withColumn(out, is_chosen(df, group, wanted, keys, seed))


def class_counts(df: DataFrame, label: str) -> dict[object, int]:
    """Rows per class; classes are few, so the counts fit the driver."""
    return {r[label]: r["count"] for r in df.groupBy(label).count().orderBy(label).collect()}


def stratified_counts(counts: Mapping[object, int], test_share: float) -> dict[object, int]:
    """Test rows per class: the total is rounded up and shared out by largest remainder."""
    total = sum(counts.values())
    test = -int(-(total * test_share) // 1)
    exact = {c: test * n / total for c, n in counts.items()}
    taken = {c: int(x) for c, x in exact.items()}
    by_remainder = sorted(counts, key=lambda c: (taken[c] - exact[c], str(c)))
    for c in by_remainder[: test - sum(taken.values())]:
        taken[c] += 1
    return taken


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: an exact share of each class, the same for every run with the seed."""
    wanted = stratified_counts(class_counts(df, label), test_share)
    return mark_chosen(df, label, wanted, keys, seed, out="is_test")
