"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Every row goes to one of 4^k runs. A run holds one entry per distinct text: its SHA-256 digest, two
check values (length in bytes and an independent 64-bit hash), the smallest identifier seen, and
the count. In round i the runs whose numbers differ only in the i-th base-4 digit exchange their
entries and merge: equal digests *with equal check values* become one entry that keeps the
smallest identifier. The minimum is over a struct, so Spark aggregates by sorting: each merge is a
merge of sorted runs. After k rounds one run of distinct digests is left, spread over the cluster by digest.

The survivors travel back along the first level: a text's copies are looked up by (run, digest), so
a text that makes up a third of the corpus is spread over all runs and never meets in one task.

Defined results: a null text counts as empty; empty texts are copies of each other; a null
identifier is larger than all others; of rows with equal identifier and equal text one stays (the
one read first); an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import TEXTS, numbered, quoted, shuffle_partitions

#: Runs that are merged into one in each round.
FAN = 4
BLANKS = r"[\x20\x09-\x0D]+"
KEYS = ["digest", "check", "n_bytes"]


def normal_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def with_digests(df: DataFrame, id_col: str, text_col: str, keep_columns: bool = False) -> DataFrame:
    text = normal_text(quoted(text_col))
    kept = [F.struct("*").alias("columns")] if keep_columns else []
    return numbered(
        df.select(
            *kept,
            quoted(id_col).alias("id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.xxhash64(text).alias("check"),
            F.octet_length(text).alias("n_bytes"),
        ),
        "digests",
        TEXTS if keep_columns else None,
    )


def run_count(rows: DataFrame) -> int:
    """A power of ``FAN`` not below the number of shuffle partitions."""
    runs = FAN
    while runs < shuffle_partitions(rows.sparkSession):
        runs *= FAN
    return runs


def merged_runs(rows: DataFrame) -> DataFrame:
    """``rows`` (row, id, digest, check, n_bytes) with ``best`` (struct of the row that stays) and ``size``."""
    runs = run_count(rows)
    rows = rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)))
    entry = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    leaf = rows.groupBy("run", *KEYS).agg(F.min(entry).alias("best"), F.count("*").alias("size"))
    level = leaf
    while runs > 1:
        runs //= FAN
        level = level.groupBy(F.expr(f"run div {FAN}").alias("run"), *KEYS).agg(
            F.min("best").alias("best"), F.sum("size").alias("size")
        )
    down = leaf.select("run", *KEYS).join(level.drop("run"), KEYS)
    return rows.join(down, ["run", *KEYS])


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256."""
    rows = merged_runs(with_digests(df, id_col, text_col))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    rows = with_digests(df, id_col, text_col, keep_columns=True)
    staying = merged_runs(rows.drop("columns")).where("row = best.row").select("row")
    return rows.join(staying, "row", "left_semi").select("columns.*")
