"""Metrics, curves, runs, samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import register
from riskloom.catalog.preparation import rounded
from riskloom.fixtures import view, with_views
from riskloom.functions.labels import label_at
from riskloom.operators import metrics, sampling
from riskloom.sources import runs

_COUNTS = """c AS (SELECT count(*) FILTER (y = 1 AND p >= 0.5E0) AS tp, count(*) FILTER (y = 0 AND p >= 0.5E0) AS fp,
  count(*) FILTER (y = 1 AND p < 0.5E0) AS fn, count(*) FILTER (y = 0 AND p < 0.5E0) AS tn FROM scored)"""

_AUC = """ranked AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0E0 AS r FROM scored),
auc AS (SELECT (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0E0)
  / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) AS roc_auc FROM ranked)"""


@register("threshold_label", with_views(["scored"], "SELECT event_id, CAST(p >= 0.5E0 AS INTEGER) AS predicted FROM scored"))
def threshold_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "scored").select("event_id", label_at(F.col("p")).alias("predicted"))


@register(
    "metrics_binary",
    with_views(
        ["scored"],
        f"""WITH {_COUNTS}, {_AUC} SELECT round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(tp / (tp + fp), 9) AS precision,
  round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round(roc_auc, 9) AS roc_auc FROM c, auc""",
    ),
)
def metrics_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.binary_metrics(view(spark, sf_dir, "scored"), "y", "p")
    return out.select(*[F.round(c, 9).alias(c) for c in metrics.BINARY_METRICS])


@register(
    "metrics_regression",
    with_views(
        ["scored"],
        """SELECT round(sqrt(avg(pow(y - p, 2))), 9) AS rmse,
  round(1 - sum(pow(y - p, 2)) / sum(pow(y - (SELECT avg(y) FROM scored), 2)), 9) AS r2 FROM scored""",
    ),
)
def metrics_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.regression_metrics(view(spark, sf_dir, "scored"), "y", "p")
    return out.select(F.round("rmse", 9).alias("rmse"), F.round("r2", 9).alias("r2"))


@register(
    "confusion",
    with_views(
        ["scored"],
        f"""WITH {_COUNTS} SELECT CAST(0 AS INTEGER) AS actual, CAST(0 AS INTEGER) AS predicted, tn AS n FROM c
UNION ALL SELECT 0, 1, fp FROM c UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""",
    ),
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(view(spark, sf_dir, "scored"), "y", "p")


_CURVE = """g AS (SELECT p AS threshold, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY p),
t AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  (SELECT sum(pos) FROM g) AS np, (SELECT sum(neg) FROM g) AS nn FROM g WINDOW w AS (ORDER BY threshold DESC))"""


@register(
    "roc_curve",
    with_views(
        ["scored"],
        f"""WITH {_CURVE} SELECT threshold, CAST(fp AS DOUBLE) / nn AS fpr, CAST(tp AS DOUBLE) / np AS tpr FROM t
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0E0, 0.0E0""",
    ),
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_curve(view(spark, sf_dir, "scored"), "y", "p")


@register(
    "pr_curve",
    with_views(
        ["scored"],
        f"""WITH {_CURVE} SELECT threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / np AS recall FROM t
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0E0, 0.0E0""",
    ),
)
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.pr_curve(view(spark, sf_dir, "scored"), "y", "p")


@register(
    "average_precision",
    with_views(
        ["scored"],
        f"WITH {_CURVE} SELECT round(sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / any_value(np), 9) AS average_precision FROM t",
    ),
)
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.average_precision(view(spark, sf_dir, "scored"), "y", "p")
    return out.select(F.round("average_precision", 9).alias("average_precision"))


# --- runs ----------------------------------------------------------------------------------


@register(
    "best_model",
    with_views(
        ["runs"],
        """SELECT dataset, model, run_order, roc_auc FROM runs WHERE NOT isnan(roc_auc)
QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY roc_auc DESC, run_order) = 1""",
    ),
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.best_runs(view(spark, sf_dir, "runs"))


@register(
    "latest_model",
    with_views(
        ["runs"],
        """SELECT dataset, model, version, run_order FROM runs WHERE starts_with(dataset, 'p')
ORDER BY created_at DESC, version DESC, dataset DESC LIMIT 1""",
    ),
)
def latest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest run over a name prefix."""
    found = runs.latest_run(view(spark, sf_dir, "runs"), "dataset", "p")
    return found.select("dataset", "model", "version", "run_order")


@register(
    "model_version",
    with_views(
        ["runs"],
        """SELECT dataset, model, version, run_order FROM runs WHERE starts_with(model, 'model_3') AND version = 2
ORDER BY created_at DESC, version DESC, model DESC LIMIT 1""",
    ),
)
def model_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exact version."""
    found = runs.latest_run(view(spark, sf_dir, "runs"), "model", "model_3", version=2)
    return found.select("dataset", "model", "version", "run_order")


@register(
    "compare_models",
    with_views(
        ["runs"],
        """SELECT dataset, model, f1, CASE WHEN isnan(roc_auc) THEN NULL ELSE roc_auc END AS roc_auc FROM runs
QUALIFY row_number() OVER (PARTITION BY dataset, model ORDER BY created_at DESC, run_order DESC) = 1""",
    ),
)
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model by metric table of the newest runs; an undefined area shows as missing."""
    table = runs.compare_runs(view(spark, sf_dir, "runs"), ["f1", "roc_auc"])
    return table.withColumn("roc_auc", F.when(~F.isnan("roc_auc"), F.col("roc_auc")))


# --- samples and splits --------------------------------------------------------------------

CARD_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
CARD_HASH = f"md5(concat_ws('|', '42', {', '.join(f'CAST({k} AS VARCHAR)' for k in CARD_KEYS)}))"


@register(
    "first_per_class",
    with_views(["scored"], "SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY y ORDER BY event_id) = 1"),
)
def first_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.first_per_class(view(spark, sf_dir, "scored"), "y", ["event_id"])


@register(
    "seeded_sample",
    with_views(["card"], f"SELECT * FROM card ORDER BY {CARD_HASH} LIMIT 500"),
)
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.seeded_sample(view(spark, sf_dir, "card"), CARD_KEYS, 500)


def split_ctes(rows: str, label: str, digest: str) -> str:
    """CTEs ending in ``split``: ``rows`` with ``is_test``, by the rule of the exact stratified split."""
    return f"""sizes AS (SELECT {label}, count(*) AS n FROM {rows} GROUP BY {label}),
total AS (SELECT sum(n) AS n, CAST(ceil(sum(n) * 0.2E0) AS BIGINT) AS test FROM sizes),
shares AS (SELECT {label}, floor(test * sizes.n / total.n) AS base, test * sizes.n / total.n AS exact, test FROM sizes, total),
wanted AS (SELECT {label}, base + CASE WHEN row_number() OVER (ORDER BY base - exact, {label}) <= test - sum(base) OVER ()
  THEN 1 ELSE 0 END AS k FROM shares),
placed AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {digest}) AS place FROM {rows}),
split AS (SELECT placed.*, place <= k AS is_test FROM placed JOIN wanted USING ({label}))"""


@register(
    "stratified_split",
    with_views(
        ["card"],
        f"WITH {split_ctes('card', 'Class', CARD_HASH)} SELECT {', '.join(CARD_KEYS)}, Class, is_test FROM split",
    ),
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = sampling.stratified_split(view(spark, sf_dir, "card"), "Class", CARD_KEYS)
    return split.select(*CARD_KEYS, "Class", "is_test")
