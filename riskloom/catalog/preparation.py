"""Fitted preparation: fills, scaling, one-hot columns and the two whole preparations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import register
from riskloom.catalog.features import CENTS, FLAGSHIP_SQL, ID_COLS, SQL_GEO
from riskloom.fixtures import view, with_views
from riskloom.functions.coerce import clean_zero
from riskloom.operators import derive, encode, velocity
from riskloom.operators.dictionary import SparseEncoder
from riskloom.plans import prepare
from riskloom.session import scratch_path

DIGITS = 6


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Standardised values differ between engines in the last bits only."""
    return df.withColumns({c: clean_zero(F.round(c, DIGITS)) for c in columns})


def sql_scaled(column: str, source: str) -> str:
    middle = f"(SELECT avg({column}) FROM {source})"
    spread = f"(SELECT CASE WHEN min({column}) < max({column}) THEN stddev_pop({column}) ELSE 1.0E0 END FROM {source})"
    return f"round(({column} - {middle}) / {spread}, {DIGITS}) + 0.0E0 AS {column}"


def sql_one_hot(column: str, values: list[str]) -> list[str]:
    return [f"CASE WHEN {column} = '{v}' THEN 1.0E0 ELSE 0.0E0 END AS {column}_{v}" for v in values]


@register(
    "impute_fit",
    with_views(
        ["txn_dirty"],
        """WITH typed AS (SELECT TRY_CAST(purchase_value AS DOUBLE) AS v, TRY_CAST(age AS DOUBLE) AS a, browser, source FROM txn_dirty)
SELECT 'purchase_value' AS feature, quantile_cont(v, 0.5) AS number_fill, CAST(NULL AS VARCHAR) AS text_fill FROM typed
UNION ALL SELECT 'age', quantile_cont(a, 0.5), NULL FROM typed
UNION ALL SELECT 'browser', NULL, (SELECT browser FROM typed WHERE browser IS NOT NULL GROUP BY browser ORDER BY count(*) DESC, browser LIMIT 1)
UNION ALL SELECT 'source', NULL, (SELECT source FROM typed GROUP BY source ORDER BY count(*) DESC, source LIMIT 1)""",
    ),
)
def impute_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = view(spark, sf_dir, "txn_dirty")
    dirty = dirty.withColumns({c: F.col(c).try_cast("double") for c in ("purchase_value", "age")})
    numbers = encode.fit_number_fills(dirty, ["purchase_value", "age"])
    texts = encode.fit_category_fills(dirty, ["browser", "source"])
    rows = [(c, v, None) for c, v in numbers.items()] + [(c, None, v) for c, v in texts.items()]
    return spark.createDataFrame(rows, "feature string, number_fill double, text_fill string")


CARD_SCALED = ["V1", "V2", "V3", "V4", "V5", "Amount", "Time"]


@register(
    "scale_standard",
    with_views(
        ["card"],
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        + ", ".join(sql_scaled(c, "card") for c in CARD_SCALED)
        + " FROM card",
    ),
)
def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = view(spark, sf_dir, "card")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    model = encode.FeatureEncoder(numbers=CARD_SCALED, keep=keys, remainder="drop").fit(card)
    return rounded(model.transform(card), *CARD_SCALED)


SOURCES, BROWSERS, SEXES = ["Ads", "Direct", "SEO"], ["Chrome", "Edge", "Firefox", "Safari"], ["F", "M"]

SQL_BROWSER = (
    "coalesce(browser, (SELECT browser FROM txn WHERE browser IS NOT NULL GROUP BY browser "
    "ORDER BY count(*) DESC, browser LIMIT 1))"
)


@register(
    "one_hot",
    with_views(
        ["txn"],
        f"WITH filled AS (SELECT txn_id, source, {SQL_BROWSER} AS browser, sex FROM txn) SELECT txn_id, "
        + ", ".join(sql_one_hot("source", SOURCES) + sql_one_hot("browser", BROWSERS) + sql_one_hot("sex", SEXES))
        + " FROM filled",
    ),
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = view(spark, sf_dir, "txn")
    encoder = encode.FeatureEncoder(categories=["source", "browser", "sex"], keep=["txn_id"], remainder="drop")
    return encoder.fit(txn).transform(txn)


SPARSE = ["source", "browser", "device_id", "ip_address"]


def _sparse_sql() -> str:
    """Places by column and value after one number; a null is its column's most frequent value."""
    counts = " UNION ALL ".join(f"SELECT {i} AS f, {c} AS value, count(*) AS n FROM txn WHERE {c} IS NOT NULL GROUP BY {c}" for i, c in enumerate(SPARSE))
    texts = " UNION ALL ".join(f"SELECT txn_id, {i} AS f, {c} AS value FROM txn" for i, c in enumerate(SPARSE))
    return f"""WITH counts AS ({counts}),
places AS (SELECT f, value, row_number() OVER (ORDER BY f, value) AS place FROM counts),
most AS (SELECT f, value AS fill FROM counts QUALIFY row_number() OVER (PARTITION BY f ORDER BY n DESC, value) = 1),
texts AS (SELECT txn_id, f, coalesce(value, fill) AS value FROM ({texts}) JOIN most USING (f))
SELECT txn_id, place, 1.0E0 AS value FROM texts JOIN places USING (f, value)
UNION ALL SELECT txn_id, 0, round((purchase_value - (SELECT avg(purchase_value) FROM txn)) / (SELECT stddev_pop(purchase_value) FROM txn), {DIGITS}) + 0.0E0 FROM txn"""


@register("one_hot_sparse", with_views(["txn"], _sparse_sql()))
def one_hot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and values of every row over a stored dictionary, with a column that has an address per row."""
    txn = view(spark, sf_dir, "txn")
    encoder = SparseEncoder(dictionary=scratch_path(spark, "dictionary"), numbers=["purchase_value"], categories=SPARSE, keep=["txn_id"], numberStrategy="mean")
    encoded = encoder.fit(txn).transform(txn)
    return rounded(encoded.select("txn_id", F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("values").alias("value")))), "value")


_VELOCITY = [n for c in ID_COLS for n in velocity.feature_names(c)]
ECOMMERCE_SCALED = ["Amount", "age", derive.REFUND, *derive.CALENDAR_FEATURES, derive.SINCE_SIGNUP, *_VELOCITY]


def _ecommerce_sql() -> str:
    """The flagship rows, standardised, with one-hot columns and the passed-through rest."""
    names = ", ".join(f"avg({c}) AS m_{i}, CASE WHEN min({c}) < max({c}) THEN stddev_pop({c}) ELSE 1.0E0 END AS s_{i}"
                      for i, c in enumerate(ECOMMERCE_SCALED))
    scaled = ", ".join(
        f"round((w.{c} - f.m_{i}) / f.s_{i}, {DIGITS}) + 0.0E0 AS {c}" for i, c in enumerate(ECOMMERCE_SCALED)
    )
    hot = sql_one_hot("source", SOURCES) + sql_one_hot("browser", BROWSERS) + sql_one_hot("sex", SEXES)
    return f"""WITH wide AS ({FLAGSHIP_SQL}), fitted AS (SELECT {names} FROM wide),
{with_views(["txn"], "").replace("WITH ", "", 1)},
filled AS (SELECT * REPLACE ({SQL_BROWSER} AS browser) FROM txn)
SELECT w.txn_id, {scaled}, {', '.join(hot)}, w.country,
  CAST(epoch_us(t.purchase_time) // 1000000 AS DOUBLE) AS TransactionStartTime,
  CAST(epoch_us(t.signup_time) // 1000000 AS DOUBLE) AS signup_time,
  coalesce(CAST(t.user_id AS DOUBLE), 0.0E0) AS CustomerId, coalesce(CAST(t.user_id AS DOUBLE), 0.0E0) AS TransactionId,
  0.0E0 AS device_id, 0.0E0 AS ip_address, w.class
FROM wide w CROSS JOIN fitted f JOIN filled t ON t.txn_id = w.txn_id"""


@register("ecommerce_prepared", _ecommerce_sql())
def ecommerce_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with duplicates through the whole e-commerce preparation; the country stays readable."""
    rows = prepare.to_canonical(view(spark, sf_dir, "txn_dup"), view(spark, sf_dir, "ip_country"))
    preparation = prepare.ecommerce_preparation(
        categories=["source", "browser", "sex"], keep=["txn_id", "country", "class"], money_scale=CENTS
    )
    return rounded(prepare.fit_transform(preparation, rows)[1], *ECOMMERCE_SCALED)


@register(
    "country_one_hot",
    with_views(
        ["txn", "ip_country"],
        f"""WITH {SQL_GEO}, listed AS (SELECT DISTINCT country FROM geo)
SELECT geo.txn_id, listed.country AS category, CASE WHEN geo.country = listed.country THEN 1.0E0 ELSE 0.0E0 END AS hit
FROM geo, listed""",
    ),
)
def country_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot columns of the located country, as rows."""
    rows = prepare.to_canonical(view(spark, sf_dir, "txn"), view(spark, sf_dir, "ip_country"))
    model = encode.FeatureEncoder(categories=["country"], keep=["txn_id"], remainder="drop").fit(rows)
    hot = model.transform(rows)
    names = model.feature_names()
    pairs = [F.struct(F.lit(n[len("country_"):]).alias("category"), encode.quoted(n).alias("hit")) for n in names]
    return hot.select("txn_id", F.inline(F.array(*pairs)))


CARD_NUMBERS = ["V1", "V2", "V3", "V4", "V5", "Time", "Amount"]
_CARD_OUT = ["V1", "V2", "V3", "V4", "V5", "Amount", derive.REFUND, "Time"]


@register(
    "card_prepared",
    with_views(
        ["card"],
        f"""WITH rows_once AS (SELECT DISTINCT * REPLACE (abs(Amount) AS Amount), CAST(Amount < 0 AS INTEGER) AS IsRefund FROM card)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(sql_scaled(c, 'rows_once') for c in _CARD_OUT)},
  CAST(Class AS INTEGER) AS Class FROM rows_once""",
    ),
)
def card_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = view(spark, sf_dir, "card")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "Class"]
    prepared = prepare.fit_transform(prepare.card_preparation(CARD_NUMBERS, keep=keys), card)[1]
    return rounded(prepared, *_CARD_OUT)
