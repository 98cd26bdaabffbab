"""Nearest neighbours and oversampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import register
from riskloom.catalog.evaluation import CARD_KEYS
from riskloom.fixtures import view, with_views
from riskloom.operators import forest, neighbours, resample

FEATURES = ["V1", "V2", "V3", "V4", "V5", "Amount"]
CARD_KEY = f"concat_ws('-', {', '.join(CARD_KEYS)})"


def card_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "card").withColumn("row_key", F.expr(CARD_KEY))


_PAIRS = f"""few AS (SELECT {CARD_KEY} AS row_key, {', '.join(FEATURES)} FROM card WHERE Class = 1),
pairs AS (SELECT a.row_key, b.row_key AS neighbour, {' + '.join(f'(a.{c} - b.{c}) * (a.{c} - b.{c})' for c in FEATURES)} AS d2
  FROM few a JOIN few b ON a.row_key <> b.row_key),
near AS (SELECT row_key, neighbour, CAST(row_number() OVER (PARTITION BY row_key ORDER BY d2, neighbour) AS INTEGER) AS rank, d2
  FROM pairs QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY d2, neighbour) <= 5)"""


@register(
    "nearest_in_class",
    with_views(["card"], f"WITH {_PAIRS} SELECT row_key, neighbour, rank, round(sqrt(d2), 9) AS distance FROM near"),
)
def nearest_in_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = card_with_key(spark, sf_dir).where("Class = 1")
    near = neighbours.nearest_neighbours(few, "row_key", FEATURES, 5)
    return near.withColumn("distance", F.round("distance", 9))


@register(
    "near_in_class",
    with_views(
        ["card"],
        f"""WITH few AS (SELECT {CARD_KEY} AS row_key FROM card WHERE Class = 1)
SELECT row_key, CAST(least(5, (SELECT count(*) FROM few) - 1) AS INTEGER) AS listed, true AS distances_right, true AS ordered FROM few""",
    ),
)
def near_in_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest's lists: every row gets its neighbours, in order and with their true distances. Which of the nearest it finds is
    a measured recall (tests), not an exact result."""
    few = card_with_key(spark, sf_dir).where("Class = 1").select("row_key", F.array(*FEATURES).alias("v"))
    near = forest.near_neighbours(card_with_key(spark, sf_dir).where("Class = 1"), "row_key", FEATURES, 5)
    there = few.select(F.col("row_key").alias("neighbour"), F.col("v").alias("there"))
    gaps = F.zip_with("v", "there", lambda a, b: (a - b) * (a - b))
    true = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x))
    checked = near.join(few, "row_key").join(there, "neighbour").withColumn("right", F.abs(true - F.col("distance")) < 1e-9)
    lists = checked.groupBy("row_key").agg(
        F.count("*").cast("int").alias("listed"), F.every("right").alias("distances_right"),
        F.array_sort(F.collect_list(F.struct("rank", "distance"))).alias("lists"),
    )
    rising = F.col("lists.distance") == F.array_sort("lists.distance")
    return lists.select("row_key", "listed", "distances_right", rising.alias("ordered"))


def sql_word(digest: str, index: int) -> str:
    return f"CAST(concat('0x', substr({digest}, {1 + 8 * index}, 8)) AS BIGINT)"


_DRAW = "md5(concat_ws('|', '42', b.row_key, CAST(copy AS VARCHAR)))"

_SYNTHETIC = f"""{_PAIRS},
need AS (SELECT (SELECT count(*) FROM card WHERE Class = 0) - count(*) AS need, count(*) AS m FROM few),
base AS (SELECT few.*, need // m + CASE WHEN row_number() OVER (ORDER BY md5(concat('42-extra|', row_key))) <= need % m
  THEN 1 ELSE 0 END AS copies FROM few, need),
drawn AS (SELECT b.row_key, CAST(copy AS INTEGER) AS copy, {', '.join(f'b.{c}' for c in FEATURES)},
  {sql_word(_DRAW, 0)} % 5 + 1 AS pick, {sql_word(_DRAW, 1)} / 4294967296.0E0 AS u
  FROM base b, range(1, (SELECT max(copies) + 1 FROM base)) g(copy) WHERE copy <= b.copies),
made AS (SELECT d.row_key, d.copy, CAST(1 AS INTEGER) AS Class,
  {', '.join(f'round(d.{c} + d.u * (o.{c} - d.{c}), 6) + 0.0E0 AS {c}' for c in FEATURES)}
  FROM drawn d JOIN near n ON n.row_key = d.row_key AND n.rank = d.pick JOIN few o ON o.row_key = n.neighbour)"""


@register("smote_points", with_views(["card"], f"WITH {_SYNTHETIC} SELECT * FROM made"))
def smote_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All synthetic rows, between exact neighbours."""
    made = resample.synthetic_rows(card_with_key(spark, sf_dir), "Class", "row_key", FEATURES, search="exact")
    return made.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in FEATURES})


@register(
    "smote_counts",
    with_views(
        ["card"],
        """WITH n AS (SELECT Class, count(*) AS n FROM card GROUP BY Class)
SELECT Class, n, n / (SELECT sum(n) FROM n) AS share, 'before' AS stage FROM n
UNION ALL SELECT Class, (SELECT max(n) FROM n), 0.5E0, 'after' FROM n""",
    ),
)
def smote_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.imbalance_report(card_with_key(spark, sf_dir), "Class", "row_key", FEATURES)
