"""Helpers the corpus operators share: row keys, hot-group splitting, components, files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import configure, written_once

#: Rows are handed to Python code in slices of this many, so a task holds few texts at a time.
SLICE = 256
#: Codec of the copies of whole rows, which lie on disk as long as the result is needed.
TEXTS = "zstd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` with a ``row`` number, written once: the numbers stay the same when tasks are run again."""
    return written_once(df.withColumn("row", F.monotonically_increasing_id()), name, codec)


def over_slices(
    batches: Iterable[pa.RecordBatch], work: Callable[[pa.RecordBatch], pa.RecordBatch | None]
) -> Iterator[pa.RecordBatch]:
    """Apply ``work`` to slices of the batches."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            out = work(batch.slice(start, SLICE))
            if out is not None and out.num_rows:
                yield out


def smallest_of_group(rows: DataFrame, keys: list[str], order: list[str], spread: int) -> DataFrame:
    """``rows`` (which have ``row``) with ``best`` and ``size``: the first row of each group of equal
    keys in the given order, nulls last, and the group's row count.

    A group may hold any share of the rows: it is reduced per (key, one of ``spread`` buckets)
    first, and looked up again by the same pair, so no task ever holds a whole group.
    """
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("row"), F.lit(spread)))
    first = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))])
    leaf = rows.groupBy("_bucket", *keys).agg(F.min(first).alias("_best"), F.count("*").alias("_size"))
    root = leaf.groupBy(*keys).agg(F.min("_best").alias("best"), F.sum("_size").alias("size"))
    chosen = leaf.select("_bucket", *keys).join(root, keys)
    return rows.join(chosen, ["_bucket", *keys]).drop("_bucket")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (u, v; any order, repeats and loops allowed): (node, root)
    for every node that has an edge to another, ``root`` the smallest node reachable. The roots
    themselves have no row of their own: who needs all members adds them.

    Large and small stars alternate until the edges stop changing. Each round is written to the
    shared folder, so plans stay short and a lost executor costs one round at most. Only a count
    and a checksum reach the driver.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = written_once(edges.distinct(), name)
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written_once(small.union(low.select("u", F.col("m").alias("v"))).distinct(), name)
