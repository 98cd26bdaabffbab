"""Cleaning, geolocation and feature queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.catalog import register
from riskloom.fixtures import view, with_views
from riskloom.functions.network import ip_to_int
from riskloom.operators import clean, derive, geo, velocity
from riskloom.operators.velocity_state import VelocityState
from riskloom.session import scratch_path
from riskloom.session import scratch_path
from riskloom.sources import tables

# Amounts of the driver tables are cents.
CENTS = 2

# --- SQL pieces shared by several checks ---------------------------------------------------


def sql_ip(column: str) -> str:
    def octet(i: int) -> str:
        return f"coalesce(CAST(trunc(TRY_CAST(nullif(split_part({column}, '.', {i}), '') AS DOUBLE)) AS BIGINT), 0)"

    return (
        f"CASE WHEN {column} IS NULL THEN NULL ELSE "
        f"{octet(1)} * 16777216 + {octet(2)} * 65536 + {octet(3)} * 256 + {octet(4)} END"
    )


def sql_velocity(id_col: str, rows: str, time: str, amount: str, windows=(1, 7, 30), key: str = "txn_id") -> str:
    """Query giving the key and the measures of every window by plain range frames."""
    parts = []
    for w in windows:
        frame = (
            f"(PARTITION BY {id_col} ORDER BY {time} RANGE BETWEEN INTERVAL {w} DAY PRECEDING "
            f"AND INTERVAL 1 MICROSECOND PRECEDING)"
        )
        n = f"count(*) OVER {frame}"
        s = f"sum(CAST(round({amount} * 100) AS BIGINT)) OVER {frame}"
        guard = f"{id_col} IS NULL OR {n} = 0"
        parts.append(f"CASE WHEN {id_col} IS NULL THEN 0 ELSE {n} END AS {id_col}_transactions_last_{w}d")
        parts.append(
            f"CASE WHEN {guard} THEN 0.0E0 ELSE CAST({s} AS DOUBLE) / 100.0E0 END AS {id_col}_total_amount_last_{w}d"
        )
        parts.append(
            f"CASE WHEN {guard} THEN 0.0E0 ELSE CAST({s} AS DOUBLE) / 100.0E0 / {n} END AS {id_col}_avg_amount_last_{w}d"
        )
    return f"SELECT {key}, {', '.join(parts)} FROM {rows}"


SQL_GEO = f"""
geo_dim AS (SELECT lo, max(hi) AS hi, max_by(country, hi) AS country FROM (
    SELECT {sql_ip('lower_bound_ip_address')} AS lo, {sql_ip('upper_bound_ip_address')} AS hi, country FROM ip_country)
  WHERE lo IS NOT NULL AND hi IS NOT NULL GROUP BY lo),
geo_num AS (SELECT txn_id, {sql_ip('ip_address')} AS ipn FROM txn),
geo AS (SELECT n.txn_id, CASE WHEN n.ipn <= d.hi THEN d.country ELSE 'Unknown' END AS country
  FROM geo_num n ASOF LEFT JOIN geo_dim d ON n.ipn >= d.lo)
"""

SQL_AMOUNT = "abs(purchase_value)"

SQL_CALENDAR = """
  CAST(hour(purchase_time) AS INTEGER) AS TransactionHour,
  CAST(isodow(purchase_time) - 1 AS INTEGER) AS TransactionDayOfWeek,
  CAST(month(purchase_time) AS INTEGER) AS TransactionMonth,
  CAST(year(purchase_time) AS INTEGER) AS TransactionYear,
  greatest(CAST(epoch_us(purchase_time) - epoch_us(signup_time) AS DOUBLE) / 86400000000.0E0, 0.0E0) AS time_since_signup"""

ID_COLS = ["CustomerId", "device_id", "ip_address"]

# --- flagship ------------------------------------------------------------------------------


def _velocity_cte(id_col: str) -> str:
    return f"v_{id_col} AS ({sql_velocity(id_col, 'feat', 'purchase_time', 'Amount')})"


FLAGSHIP_SQL = with_views(
    ["txn", "ip_country"],
    f"""WITH {SQL_GEO},
feat AS (SELECT txn_id, user_id AS CustomerId, device_id, ip_address, purchase_time, signup_time,
  {SQL_AMOUNT} AS Amount, CAST(purchase_value < 0 AS INTEGER) AS IsRefund,
  coalesce(TRY_CAST(age AS DOUBLE), 0.0E0) AS age, class FROM txn),
{', '.join(_velocity_cte(c) for c in ID_COLS)}
SELECT f.txn_id, f.CustomerId, f.device_id, f.ip_address, geo.country, f.Amount, f.IsRefund, f.age,
  {SQL_CALENDAR}, {', '.join(f"v_{c}.* EXCLUDE (txn_id)" for c in ID_COLS)}, f.class
FROM feat f JOIN geo USING (txn_id) {' '.join(f'JOIN v_{c} USING (txn_id)' for c in ID_COLS)}""",
)


@register("flagship_features", FLAGSHIP_SQL)
def flagship_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide feature row per transaction: clean, locate, velocity, calendar."""
    txn = clean.rename_known(view(spark, sf_dir, "txn"))
    txn = clean.correct_types(txn, ["TransactionStartTime", "signup_time"], ["Amount", "age"])
    txn = derive.add_refund_flag(txn)
    txn = velocity.add_velocity(txn, ID_COLS, money_scale=CENTS)
    txn = derive.add_calendar_features(txn)
    txn = geo.locate_addresses(txn, view(spark, sf_dir, "ip_country"))
    names = [n for c in ID_COLS for n in velocity.feature_names(c)]
    return txn.select(
        "txn_id", "CustomerId", "device_id", "ip_address", "country", "Amount", "IsRefund", "age",
        *derive.CALENDAR_FEATURES, derive.SINCE_SIGNUP, *names, "class",
    )


# --- cleaning ------------------------------------------------------------------------------

SQL_TXN_MICROS = "* REPLACE (epoch_us(purchase_time) AS purchase_time, epoch_us(signup_time) AS signup_time)"


def _micros(df: DataFrame, *columns: str) -> DataFrame:
    """Times as microseconds, so that both engines give plain numbers."""
    return df.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in columns})


@register("dedup_rows", with_views(["txn_dup"], f"SELECT DISTINCT {SQL_TXN_MICROS} FROM txn_dup"))
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(clean.drop_exact_duplicates(view(spark, sf_dir, "txn_dup")), "purchase_time", "signup_time")


@register(
    "dedup_report",
    with_views(
        ["txn_dup"],
        """SELECT (SELECT count(*) FROM txn_dup) AS rows_before, count(*) AS rows_after,
  (SELECT count(*) FROM txn_dup) - count(*) AS rows_removed, CAST(12 AS INTEGER) AS n_columns,
  CAST(max(CASE WHEN user_id IS NULL OR browser IS NULL OR ip_address IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS any_null
FROM (SELECT DISTINCT * FROM txn_dup)""",
    ),
)
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.duplicate_report(view(spark, sf_dir, "txn_dup"))


SQL_DIRTY_TIME = "epoch_us(coalesce(TRY_CAST(purchase_time AS TIMESTAMP), TIMESTAMP '1970-01-01 00:00:00'))"


@register(
    "coerce_types",
    with_views(
        ["txn_dirty"],
        f"""SELECT txn_id, {SQL_DIRTY_TIME} AS purchase_time,
  coalesce(TRY_CAST(purchase_value AS DOUBLE), 0.0E0) AS purchase_value,
  coalesce(TRY_CAST(age AS DOUBLE), 0.0E0) AS age, source, browser FROM txn_dirty""",
    ),
)
def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = clean.correct_types(view(spark, sf_dir, "txn_dirty"), ["purchase_time"], ["purchase_value", "age"])
    return _micros(df, "purchase_time")


# Layouts that text tables bring, with what each keeps of the time.
TIME_LAYOUTS = (
    ("yyyy-MM-dd HH:mm:ss", "second"), ("M/d/yyyy H:mm", "minute"), ("d-MMM-yyyy", "day"), ("yyyy/MM/dd HH:mm:ss", "second"),
    ("M/d/yyyy h:mm:ss a", "second"), ("yyyyMMdd", "day"), ("d.M.yyyy H:mm", "minute"),
)


@register(
    "coerce_times_mixed",
    with_views(
        ["txn"],
        f"""SELECT txn_id, epoch_us(CASE txn_id % {len(TIME_LAYOUTS)}
  {' '.join(f"WHEN {i} THEN date_trunc('{kept}', purchase_time)" for i, (_, kept) in enumerate(TIME_LAYOUTS))} END) AS purchase_time FROM txn""",
    ),
)
def coerce_times_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps written in different layouts in one column."""
    txn = view(spark, sf_dir, "txn")
    text = F.coalesce(
        *[
            F.when(F.col("txn_id") % len(TIME_LAYOUTS) == i, F.date_format("purchase_time", layout))
            for i, (layout, _) in enumerate(TIME_LAYOUTS)
        ]
    )
    df = clean.correct_types(txn.select("txn_id", text.alias("purchase_time")), ["purchase_time"], [])
    return _micros(df, "purchase_time")


@register(
    "ensure_numeric",
    with_views(
        ["txn"],
        """SELECT txn_id, CAST(txn_id AS DOUBLE) AS id_number,
  coalesce(CAST(user_id AS DOUBLE), 0.0E0) AS user_id, CAST(epoch_us(purchase_time) // 1000000 AS DOUBLE) AS purchase_time,
  CAST(epoch_us(signup_time) // 1000000 AS DOUBLE) AS signup_time, CAST(purchase_value AS DOUBLE) AS purchase_value,
  coalesce(TRY_CAST(device_id AS DOUBLE), 0.0E0) AS device_id, coalesce(TRY_CAST(source AS DOUBLE), 0.0E0) AS source,
  coalesce(TRY_CAST(browser AS DOUBLE), 0.0E0) AS browser, coalesce(TRY_CAST(sex AS DOUBLE), 0.0E0) AS sex,
  coalesce(TRY_CAST(age AS DOUBLE), 0.0E0) AS age, coalesce(TRY_CAST(ip_address AS DOUBLE), 0.0E0) AS ip_address,
  CAST(class AS DOUBLE) AS class FROM txn""",
    ),
)
def ensure_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = view(spark, sf_dir, "txn").withColumn("id_number", F.col("txn_id"))
    return clean.ensure_numeric(txn, exclude=["txn_id"])


@register(
    "rename_label_ids",
    with_views(
        ["txn"],
        """SELECT txn_id, user_id AS CustomerId, purchase_value AS Amount, epoch_us(purchase_time) AS TransactionStartTime,
  user_id AS TransactionId, CAST(class AS INTEGER) AS class FROM txn""",
    ),
)
def rename_label_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = clean.training_ids(view(spark, sf_dir, "txn"))
    txn = clean.label_to_int(clean.rename_known(txn), "class")
    return _micros(txn, "TransactionStartTime").select(
        "txn_id", "CustomerId", "Amount", "TransactionStartTime", "TransactionId", "class"
    )


@register(
    "scoring_ids",
    with_views(
        ["txn"],
        """SELECT txn_id, coalesce(CAST(user_id AS VARCHAR), 'nan') AS CustomerId,
  concat(coalesce(CAST(user_id AS VARCHAR), 'nan'), '_', CAST(txn_id AS VARCHAR)) AS TransactionId FROM txn""",
    ),
)
def scoring_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clean.scoring_ids(view(spark, sf_dir, "txn"), "ecommerce", row_key="txn_id")
    return out.select("txn_id", "CustomerId", "TransactionId")


@register(
    "scoring_ids_by_position",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat('CC_TXN_', CAST(row_number() OVER () - 1 AS VARCHAR)) AS TransactionId, "
    "concat('CC_CUST_', CAST(row_number() OVER () - 1 AS VARCHAR)) AS CustomerId FROM lineitem",
)
def scoring_ids_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the ids of its place in the file."""
    out = clean.scoring_ids(view(spark, sf_dir, "card"), "card")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "TransactionId", "CustomerId")


@register(
    "null_fill",
    with_views(
        ["txn"],
        """SELECT txn_id, coalesce(user_id, 0) AS user_id, coalesce(browser, 'missing_value') AS browser,
  coalesce(ip_address, 'missing_value') AS ip_address, 'Unknown' AS country,
  coalesce(TRY_CAST(age AS DOUBLE), 0.0E0) AS age FROM txn""",
    ),
)
def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = clean.add_missing_columns(view(spark, sf_dir, "txn"), clean.SCORING_DEFAULTS)
    txn = clean.fill_zero(txn.withColumn("age", F.col("age").try_cast("double")), ["age"])
    return clean.fill_missing(txn).select("txn_id", "user_id", "browser", "ip_address", "country", "age")


@register(
    "score_time_impute",
    with_views(
        ["txn_dirty"],
        """WITH typed AS (SELECT txn_id, TRY_CAST(purchase_value AS DOUBLE) AS purchase_value,
  coalesce(TRY_CAST(age AS DOUBLE), 0.0E0) AS age, browser, source FROM txn_dirty)
SELECT txn_id, coalesce(purchase_value, (SELECT quantile_cont(purchase_value, 0.5) FROM typed)) AS purchase_value,
  age, coalesce(browser, (SELECT browser FROM typed WHERE browser IS NOT NULL GROUP BY browser ORDER BY count(*) DESC, browser LIMIT 1)) AS browser,
  source FROM typed""",
    ),
)
def score_time_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = view(spark, sf_dir, "txn_dirty").drop("purchase_time")
    dirty = dirty.withColumn("purchase_value", F.col("purchase_value").try_cast("double"))
    return clean.fill_for_scoring(
        dirty, ["purchase_value", "age", "browser", "source"], numbers_from_text=["age"]
    )


@register(
    "numeric_only",
    with_views(["card"], "SELECT V1, V4, Amount, Class FROM card"),
)
def numeric_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the requested columns, those that exist and are numeric."""
    card = view(spark, sf_dir, "card").withColumn("note", F.lit("text"))
    return card.select(clean.numeric_columns(card, ["V1", "V4", "Amount", "note", "absent", "Class"]))


# --- sources -------------------------------------------------------------------------------


@register(
    "scan_csv_typed",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders",
)
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through delimited text and back, with the type of the key overridden."""
    orders = view(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "orders_text")
    tables.write_features(orders, path, fmt="csv")
    return tables.read_delimited(spark, path, schema=orders.schema, column_types={"o_orderkey": "string"})


@register(
    "scan_csv_refused",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'number of fields' WHEN o_orderkey % 89 = 0 THEN 'number of fields'
  WHEN o_orderkey % 83 = 0 THEN 'open quote' WHEN o_orderkey % 79 = 0 THEN 'o_totalprice is not double' ELSE 'read' END AS reason,
  CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0 OR o_orderkey % 79 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def scan_csv_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a field missing, one too many, an open quote or a wrong type come out apart, with their reasons."""
    lines = view(spark, sf_dir, "orders").select(
        F.expr("""CASE WHEN o_orderkey % 97 = 0 THEN concat(o_orderkey, ',', o_totalprice)
  WHEN o_orderkey % 89 = 0 THEN concat(o_orderkey, ',', o_totalprice, ',', o_orderstatus, ',more')
  WHEN o_orderkey % 83 = 0 THEN concat(o_orderkey, ',"', o_totalprice, ',', o_orderstatus)
  WHEN o_orderkey % 79 = 0 THEN concat(o_orderkey, ',much,', o_orderstatus)
  ELSE concat(o_orderkey, ',', o_totalprice, ',"', o_orderstatus, '"') END""").alias("value")
    )
    path = scratch_path(spark, "orders_lines")
    lines.write.text(path)
    schema = T._parse_datatype_string("o_orderkey long, o_totalprice double, o_orderstatus string")
    rows, refused = tables.read_delimited_checked(spark, path, schema, header=False)
    key = F.regexp_extract("line", "^[0-9]+", 0).cast("long").alias("o_orderkey")
    return rows.select("o_orderkey", F.lit("read").alias("reason"), "o_totalprice").unionByName(
        refused.select(key, "reason", F.lit(None).cast("double").alias("o_totalprice"))
    )


@register("read_or_build", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def read_or_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built and written on the first call, only read on the second."""
    path = scratch_path(spark, "event_counts")

    def build() -> DataFrame:
        return view(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))

    tables.read_or_build(spark, path, build)
    return tables.read_or_build(spark, path, build)


# --- scalar features -----------------------------------------------------------------------


@register("ip_to_int", with_views(["txn"], f"SELECT txn_id, {sql_ip('ip_address')} AS ip_number FROM txn"))
def ip_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "txn").select("txn_id", ip_to_int(F.col("ip_address")).alias("ip_number"))


@register(
    "ip_country_without_ranges",
    with_views(["txn"], "SELECT txn_id, ip_address FROM txn"),
)
def ip_country_without_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing to match with: the rows stay as they are."""
    txn = view(spark, sf_dir, "txn").select("txn_id", "ip_address")
    return geo.locate_addresses(txn, view(spark, sf_dir, "ip_country").where("false"))


@register("ip_country_asof", with_views(["txn", "ip_country"], f"WITH {SQL_GEO} SELECT txn_id, country FROM geo"))
def ip_country_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = view(spark, sf_dir, "txn").select("txn_id", "ip_address")
    return geo.locate_addresses(txn, view(spark, sf_dir, "ip_country")).select("txn_id", "country")


@register("ip_country_numeric", with_views(["txn", "ip_country"], f"WITH {SQL_GEO} SELECT txn_id, country FROM geo"))
def ip_country_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that come as numbers, bounds as dotted text."""
    number = ip_to_int(F.col("ip_address")).cast("double").cast("string")
    txn = view(spark, sf_dir, "txn").select("txn_id", number.alias("ip_address"))
    ranges = view(spark, sf_dir, "ip_country")
    found = geo.locate_addresses(txn, ranges, encoding="numeric", range_encoding="dotted")
    return found.select("txn_id", "country")


@register(
    "ip_country_shuffled", with_views(["txn", "ip_country"], f"WITH {SQL_GEO} SELECT txn_id, country FROM geo")
)
def ip_country_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the range table is too large to broadcast."""
    txn = view(spark, sf_dir, "txn").select("txn_id", "ip_address")
    ranges = view(spark, sf_dir, "ip_country")
    return geo.locate_addresses(txn, ranges, broadcast_ranges=0).select("txn_id", "country")


@register(
    "amount_refund",
    with_views(
        ["txn"],
        "SELECT txn_id, abs(purchase_value) AS Amount, CAST(purchase_value < 0 AS INTEGER) AS IsRefund FROM txn",
    ),
)
def amount_refund(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = clean.rename_known(view(spark, sf_dir, "txn"))
    return derive.add_refund_flag(txn).select("txn_id", "Amount", "IsRefund")


@register("temporal_parts", with_views(["txn"], f"SELECT txn_id, {SQL_CALENDAR} FROM txn"))
def temporal_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = clean.rename_known(view(spark, sf_dir, "txn"))
    return derive.add_calendar_features(txn).select("txn_id", *derive.CALENDAR_FEATURES, derive.SINCE_SIGNUP)


@register(
    "signup_gap_median_fill",
    with_views(
        ["txn"],
        """WITH gaps AS (SELECT txn_id, CASE WHEN txn_id % 7 <> 0 THEN
  CAST(epoch_us(purchase_time) - epoch_us(signup_time) AS DOUBLE) / 86400000000.0E0 END AS gap FROM txn)
SELECT txn_id, greatest(coalesce(gap, (SELECT quantile_cont(gap, 0.5) FROM gaps)), 0.0E0) AS time_since_signup FROM gaps""",
    ),
)
def signup_gap_median_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = view(spark, sf_dir, "txn")
    txn = txn.withColumn("signup_time", F.when(F.col("txn_id") % 7 != 0, F.col("signup_time")))
    out = derive.add_signup_gap_median_filled(txn, "purchase_time", "signup_time")
    return out.select("txn_id", derive.SINCE_SIGNUP)


# --- velocity ------------------------------------------------------------------------------


def _velocity_check(id_col: str) -> str:
    return with_views(["txn"], sql_velocity(id_col, "txn", "purchase_time", SQL_AMOUNT))


def _velocity_query(id_col: str, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        txn = derive.add_refund_flag(view(spark, sf_dir, "txn"), "purchase_value")
        out = velocity.add_velocity(
            txn, [id_col], "purchase_time", "purchase_value", money_scale=CENTS, **options
        )
        return out.select("txn_id", *velocity.feature_names(id_col))

    return run


for _name, _id in (("user", "user_id"), ("device", "device_id"), ("ip", "ip_address")):
    register(f"velocity_{_name}", _velocity_check(_id))(_velocity_query(_id))
    # The way taken for busy ids, forced for all of them.
    register(f"velocity_{_name}_chunked", _velocity_check(_id))(_velocity_query(_id, frame_rows=0))


@register(
    "velocity_batches",
    with_views(
        ["txn"],
        f"""WITH a AS ({sql_velocity('user_id', 'txn', 'purchase_time', SQL_AMOUNT)}), b AS ({sql_velocity('device_id', 'txn', 'purchase_time', SQL_AMOUNT)})
SELECT * FROM a JOIN b USING (txn_id)""",
    ),
)
def velocity_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches by time, each measured against the stored state of those before, every one applied twice and
    the state merged in between: the frames of their union."""
    txn = derive.add_refund_flag(view(spark, sf_dir, "txn"), "purchase_value")
    when = F.unix_micros("purchase_time")
    first, last = txn.agg(F.min(when), F.max(when)).first()
    txn = txn.withColumn("batch", F.floor((when - first) * 3 / (last - first + 1)))
    state = VelocityState(spark, scratch_path(spark, "velocity"), ["user_id", "device_id"], "purchase_time", "purchase_value", money_scale=CENTS)
    parts = []
    for number in range(3):
        rows = txn.where(F.col("batch") == number)
        state.apply(rows, f"batch-{number}")
        parts.append(state.measured(rows, f"batch-{number}"))
        state.apply(rows, f"batch-{number}")
        if number == 1:
            state.compact()
    names = [n for c in ("user_id", "device_id") for n in velocity.feature_names(c)]
    return reduce(DataFrame.unionByName, parts).select("txn_id", *names)


@register(
    "velocity_edges",
    with_views(
        ["txn"],
        """SELECT txn_id, CAST(0 AS BIGINT) AS absent_transactions_last_1d, 0.0E0 AS absent_total_amount_last_1d,
  0.0E0 AS absent_avg_amount_last_1d, 0.0E0 AS Amount FROM txn""",
    ),
)
def velocity_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No amount column and no id column: amounts and features are 0."""
    txn = view(spark, sf_dir, "txn").select("txn_id", "purchase_time")
    out = velocity.add_velocity(txn, ["absent"], "purchase_time", "Amount", windows=[1])
    return out.drop("purchase_time")
