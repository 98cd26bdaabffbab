"""Exploratory analysis queries."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import register
from riskloom.catalog.preparation import DIGITS, rounded
from riskloom.fixtures import VIEWS, view, with_views
from riskloom.operators import clean, explore

TXN_TYPES = {
    "txn_id": "bigint", "user_id": "bigint", "purchase_time": "timestamp", "signup_time": "timestamp",
    "purchase_value": "double", "device_id": "string", "source": "string", "browser": "string", "sex": "string",
    "age": "string", "ip_address": "string", "class": "int",
}
CARD = ["V1", "V2", "V3", "V4", "V5", "Amount", "Time"]


# Decimals up to which means are exact, so that both engines agree to the last digit.
MEAN_SCALE = 6


def sql_mean(column: str, scale: int = MEAN_SCALE) -> str:
    units = f"sum(CAST(round({column} * 1E{scale}) AS HUGEINT))"
    return f"CAST({units} AS DOUBLE) / 1E{scale} / count({column})"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_PROFILE = union(
    [
        f"SELECT '{c}' AS feature, '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS missing, "
        f"100.0E0 * (count(*) - count({c})) / count(*) AS missing_percent FROM txn"
        for c, t in TXN_TYPES.items()
    ]
)


@register("profile_columns", with_views(["txn"], _PROFILE))
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.profile_columns(view(spark, sf_dir, "txn"))


@register(
    "missing_report",
    with_views(["txn"], f"SELECT feature, missing, missing_percent FROM ({_PROFILE}) WHERE missing > 0"),
)
def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.missing_report(view(spark, sf_dir, "txn"))


@register(
    "missing_mask",
    with_views(["txn_dirty"], "SELECT " + ", ".join(f"{c} IS NULL AS {c}" for c in
               ["txn_id", "purchase_time", "purchase_value", "age", "source", "browser"]) + " FROM txn_dirty"),
)
def missing_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.missing_mask(view(spark, sf_dir, "txn_dirty"))


@register(
    "missing_blocks",
    with_views(
        ["txn"],
        union([f"SELECT txn_id // 1000 AS block, '{c}' AS feature, count(*) - count({c}) AS missing FROM txn GROUP BY 1"
               for c in TXN_TYPES if c != "txn_id"]),
    ),
)
def missing_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.missing_blocks(view(spark, sf_dir, "txn"), "txn_id", 1000)


@register(
    "describe_numeric",
    with_views(
        ["card"],
        union(
            [
                f"SELECT '{c}' AS feature, count({c}) AS count, {sql_mean(c)} AS mean, "
                f"round(stddev_samp({c}), {DIGITS}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25, "
                f"quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM card"
                for c in CARD
            ]
        ),
    ),
)
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explore.describe_numeric(view(spark, sf_dir, "card"), [*CARD, "absent"], MEAN_SCALE), "std")


@register(
    "category_counts",
    with_views(["txn"], "SELECT browser, count(*) AS n FROM txn WHERE browser IS NOT NULL GROUP BY browser"),
)
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.category_frequencies(view(spark, sf_dir, "txn"), "browser")


@register(
    "class_distribution",
    with_views(["txn"], "SELECT class, count(*) AS n, count(*) / (SELECT count(*) FROM txn) AS share FROM txn GROUP BY class"),
)
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.class_distribution(view(spark, sf_dir, "txn"), "class")


@register(
    "distinct_guard",
    with_views(
        ["txn"],
        union([f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS distinct_values, count(DISTINCT {c}) > 50 AS too_many FROM txn"
               for c in ("source", "browser", "device_id", "ip_address")]),
    ),
)
def distinct_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.distinct_guard(view(spark, sf_dir, "txn"), ["source", "browser", "device_id", "ip_address"])


def sql_bin(value: str, low: str, high: str, bins: int) -> str:
    guess = f"CAST(least(floor(({value} - {low}) / ({high} - {low}) * {bins}), {bins - 1}) AS INTEGER)"

    def edge(index: str) -> str:
        return f"({low} + ({index}) * (({high} - {low}) / {bins}))"

    return (
        f"CASE WHEN {value} < {edge(guess)} THEN {guess} - 1 "
        f"WHEN {guess} < {bins - 1} AND {value} >= {edge(guess + ' + 1')} THEN {guess} + 1 ELSE {guess} END"
    )


@register(
    "histogram50",
    with_views(
        ["txn"],
        f"""WITH ends AS (SELECT min(purchase_value) AS lo, max(purchase_value) AS hi FROM txn),
binned AS (SELECT {sql_bin('purchase_value', 'lo', 'hi', 50)} AS bin FROM txn, ends),
counted AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin)
SELECT CAST(g.i AS INTEGER) AS bin, lo + g.i * ((hi - lo) / 50) AS low,
  CASE WHEN g.i = 49 THEN hi ELSE lo + (g.i + 1) * ((hi - lo) / 50) END AS high, coalesce(n, 0) AS n
FROM range(50) g(i) CROSS JOIN ends LEFT JOIN counted ON counted.bin = g.i""",
    ),
)
def histogram50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.histogram(view(spark, sf_dir, "txn"), "purchase_value")


@register(
    "density_curve",
    with_views(
        ["txn"],
        f"""WITH s AS (SELECT count(purchase_value) AS n, min(purchase_value) AS lo, max(purchase_value) AS hi,
  stddev_samp(purchase_value) * pow(count(purchase_value), -0.2E0) AS bw FROM txn),
grid AS (SELECT CAST(i AS INTEGER) AS point, lo + i * ((hi - lo) / 199) AS x, n, bw FROM range(200) g(i), s)
SELECT point, round(x, {DIGITS}) + 0.0E0 AS x,
  round(sum(exp(-0.5E0 * pow((x - purchase_value) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 9) AS density
FROM grid, txn GROUP BY point, x""",
    ),
)
def density_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = explore.density_curve(view(spark, sf_dir, "txn"), "purchase_value")
    return rounded(curve, "x").withColumn("density", F.round("density", 9))


def sql_box(column: str, source: str, group: str | None = None) -> str:
    """Box summary by plain quantiles, whole or per group."""
    keys = f"{group}, " if group else ""
    using = f" JOIN q USING ({group})" if group else " CROSS JOIN q"
    by = f" GROUP BY {group}" if group else ""
    where = f"WHERE {column} IS NOT NULL" + (f" AND {group} IS NOT NULL" if group else "")
    return f"""WITH q AS (SELECT {keys}quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS med,
  quantile_cont({column}, 0.75) AS q3 FROM {source} {where}{by}),
w AS (SELECT {source}.*, q1, med, q3, q1 - 1.5E0 * (q3 - q1) AS lo, q3 + 1.5E0 * (q3 - q1) AS hi FROM {source}{using} {where})
SELECT {keys or f"'{column}' AS feature, "}count(*) AS n, round(any_value(q1), 9) AS q1, round(any_value(med), 9) AS median, round(any_value(q3), 9) AS q3,
  min({column}) FILTER ({column} BETWEEN lo AND hi) AS whisker_low, max({column}) FILTER ({column} BETWEEN lo AND hi) AS whisker_high,
  count(*) FILTER ({column} < lo OR {column} > hi) AS outliers FROM w{by}"""


def _box_rounded(df: DataFrame) -> DataFrame:
    """Interpolated quartiles differ between engines in the last bit."""
    return df.withColumns({c: F.round(c, 9) for c in ("q1", "median", "q3")})


@register("box_summary", with_views(["txn"], sql_box("purchase_value", "txn")))
def box_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _box_rounded(explore.box_summary(view(spark, sf_dir, "txn"), ["purchase_value"]))


@register("box_by_category", with_views(["txn"], sql_box("purchase_value", "txn", "browser")))
def box_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _box_rounded(explore.box_by_category(view(spark, sf_dir, "txn"), "purchase_value", "browser"))


_IQR = """WITH q AS (SELECT quantile_cont(V5, 0.75) - quantile_cont(V5, 0.25) AS iqr,
  quantile_cont(V5, 0.25) AS q1, quantile_cont(V5, 0.75) AS q3 FROM card),
b AS (SELECT iqr, q1 - 1.5E0 * iqr AS lower, q3 + 1.5E0 * iqr AS upper FROM q)"""


@register(
    "iqr_outliers",
    with_views(
        ["card"],
        f"""{_IQR} SELECT 'V5' AS feature, any_value(iqr) AS iqr, any_value(lower) AS lower, any_value(upper) AS upper,
  count(*) FILTER (V5 < lower OR V5 > upper) AS outliers,
  count(*) FILTER (V5 < lower OR V5 > upper) * 100.0E0 / count(V5) AS outlier_percent FROM card, b""",
    ),
)
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.iqr_outliers(view(spark, sf_dir, "card"), "V5")


@register(
    "outlier_sample",
    with_views(
        ["card"],
        f"""{_IQR} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, V5 FROM card, b WHERE V5 < lower OR V5 > upper
ORDER BY 1, 2, 3, 4, 5 LIMIT 5""",
    ),
)
def outlier_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return explore.outlier_sample(view(spark, sf_dir, "card"), "V5", keys)


@register(
    "outlier_rows",
    with_views(["card"], f"{_IQR} SELECT card.* FROM card, b WHERE V5 < lower OR V5 > upper"),
)
def outlier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = view(spark, sf_dir, "card")
    _, low, high = explore.iqr_bounds(card, "V5")
    return clean.outside(card, "V5", low, high)


@register(
    "corr_pair",
    with_views(["card"], f"SELECT 'V5' AS feature_a, 'Amount' AS feature_b, round(corr(V5, Amount), {DIGITS}) + 0.0E0 AS r FROM card"),
)
def corr_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explore.correlation(view(spark, sf_dir, "card"), "V5", "Amount"), "r")


_CONSTANT = VIEWS["card"].strip().replace(" AS V5,", " AS V5, 1.5E0 AS flat,")


@register(
    "corr_matrix",
    f"WITH card AS ({_CONSTANT}) "
    + union(
        [
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
            + f"CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN "
            + ("1.0E0" if a == b else f"round(corr({a}, {b}), {DIGITS}) + 0.0E0")
            + " END AS r FROM card"
            for a, b in itertools.product([*CARD, "flat"], repeat=2)
        ]
    ),
)
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = view(spark, sf_dir, "card").withColumn("flat", F.lit(1.5))
    return rounded(explore.correlation_matrix(card, [*CARD, "flat"]), "r")


@register(
    "crosstab",
    with_views(
        ["txn"],
        "SELECT browser, " + ", ".join(f"count(*) FILTER (source = '{s}') AS {s}" for s in ("Ads", "Direct", "SEO"))
        + " FROM txn WHERE browser IS NOT NULL AND source IS NOT NULL GROUP BY browser",
    ),
)
def crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.crosstab(view(spark, sf_dir, "txn"), "browser", "source")


@register(
    "monthly_trend",
    f"SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, {sql_mean('o_totalprice', 2)} AS o_totalprice, "
    f"{sql_mean('o_custkey', 2)} AS o_custkey FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1",
)
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = explore.monthly_trend(
        view(spark, sf_dir, "orders"), "o_orderdate", ["o_totalprice", "o_custkey", "o_orderstatus"], 2
    )
    return trend.select(F.date_format("YearMonth", "yyyy-MM").alias("month"), "o_totalprice", "o_custkey")


def _sql_pairs(columns: list[str], bins: int) -> str:
    ends = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in columns)
    placed = ", ".join(f"{sql_bin(c, f'lo_{c}', f'hi_{c}', bins)} AS b_{c}" for c in columns)
    return f"WITH ends AS (SELECT {ends} FROM card), placed AS (SELECT {placed} FROM card, ends) " + union(
        [
            f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, b_{a} AS bin_x, b_{b} AS bin_y, count(*) AS n FROM placed GROUP BY ALL"
            for a, b in itertools.combinations_with_replacement(columns, 2)
        ]
    )


@register(
    "scatter_bins",
    with_views(["card"], f"SELECT bin_x, bin_y, n FROM ({_sql_pairs(['V5', 'Amount'], 50)}) WHERE feature_x <> feature_y"),
)
def scatter_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.scatter_bins(view(spark, sf_dir, "card"), "V5", "Amount")


@register("pair_bins", with_views(["card"], _sql_pairs(["V1", "V2", "V5", "Amount"], 20)))
def pair_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.pair_bins(view(spark, sf_dir, "card"), ["V1", "V2", "V5", "Amount"], 20)


@register(
    "scatter_sample",
    with_views(
        ["txn"],
        """SELECT txn_id, user_id, purchase_value FROM txn WHERE user_id IS NOT NULL AND purchase_value IS NOT NULL
ORDER BY md5(concat('42|', CAST(txn_id AS VARCHAR))) LIMIT 200""",
    ),
)
def scatter_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.scatter_sample(view(spark, sf_dir, "txn"), "user_id", "purchase_value", ["txn_id"], 200)


@register(
    "analysis_by_name",
    with_views(["txn"], "SELECT sex, count(*) AS n FROM txn WHERE sex IS NOT NULL GROUP BY sex"),
)
def analysis_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.analyse(view(spark, sf_dir, "txn"), "frequencies", "sex")
