"""Transaction views derived from the driver tables, in one SQL text for Spark and the oracle.

Only the text after ``SELECT`` is shared; nothing here is engine-specific. Doubles are written
``0.3E0`` because a plain ``0.3`` is a decimal in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.session import configure

VIEWS = {
    # E-commerce shape: null users, null, malformed and short addresses, signups after the
    # purchase, refunds.
    "txn": """
SELECT event_id AS txn_id,
  CASE WHEN event_id % 499 = 0 THEN NULL ELSE user_id END AS user_id,
  CAST(ts AS TIMESTAMP) AS purchase_time,
  TIMESTAMP '2023-06-01 00:00:00' + INTERVAL '1' DAY * (user_id * 2 % 300) AS signup_time,
  CASE WHEN event_type = 'error' THEN -value ELSE value END AS purchase_value,
  CONCAT('D', CAST((user_id * 7 + event_id % 3) % 97 AS STRING)) AS device_id,
  CASE user_id % 3 WHEN 0 THEN 'SEO' WHEN 1 THEN 'Ads' ELSE 'Direct' END AS source,
  CASE event_id % 5 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' WHEN 3 THEN 'Edge' ELSE NULL END AS browser,
  CASE user_id % 2 WHEN 0 THEN 'M' ELSE 'F' END AS sex,
  CASE WHEN event_id % 89 = 0 THEN 'n/a' ELSE CAST(18 + user_id % 50 AS STRING) END AS age,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'invalid.ip'
       WHEN event_id % 103 = 0 THEN CONCAT(CAST(1 + user_id % 30 AS STRING), '.', CAST((user_id * 13 + event_id) % 256 AS STRING), '.', CAST(event_id % 256 AS STRING))
       ELSE CONCAT(CAST(1 + user_id % 30 AS STRING), '.', CAST((user_id * 13 + event_id) % 256 AS STRING), '.', CAST(event_id % 256 AS STRING), '.', CAST((event_id * 7) % 256 AS STRING)) END AS ip_address,
  CASE WHEN event_id % 11 = 0 OR (event_type = 'purchase' AND value > 100) THEN 1 ELSE 0 END AS class
FROM events""",
    # Exact duplicates.
    "txn_dup": "SELECT * FROM txn UNION ALL SELECT * FROM txn WHERE txn_id % 50 = 0",
    # Text columns with unreadable and null values.
    "txn_dirty": """
SELECT txn_id,
  CASE WHEN txn_id % 83 = 0 THEN 'not a date' WHEN txn_id % 79 = 0 THEN NULL ELSE CAST(purchase_time AS STRING) END AS purchase_time,
  CASE WHEN txn_id % 73 = 0 THEN 'abc' WHEN txn_id % 71 = 0 THEN NULL ELSE CAST(purchase_value AS STRING) END AS purchase_value,
  age, source, browser
FROM txn""",
    # Gaps, nested ranges and a missing bound.
    "ip_country": """
SELECT CONCAT(CAST(n_nationkey + 1 AS STRING), '.0.0.0') AS lower_bound_ip_address, CONCAT(CAST(n_nationkey + 1 AS STRING), '.199.255.255') AS upper_bound_ip_address, n_name AS country FROM nation
UNION ALL SELECT CONCAT(CAST(r_regionkey * 5 + 1 AS STRING), '.64.0.0'), CONCAT(CAST(r_regionkey * 5 + 1 AS STRING), '.95.255.255'), r_name FROM region
UNION ALL SELECT '200.0.0.0', CAST(NULL AS STRING), 'Broken'""",
    # Card shape; key (l_orderkey, l_linenumber, l_partkey, l_suppkey).
    "card": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST((l_orderkey * 60) % 172800 AS DOUBLE) AS Time,
  l_quantity - 25 AS V1, l_discount * 100 AS V2, l_tax * 100 AS V3, CAST(l_linenumber - 4 AS DOUBLE) AS V4, l_extendedprice / l_quantity AS V5,
  CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS Amount,
  CASE WHEN l_orderkey % 200 = 0 THEN 1 ELSE 0 END AS Class FROM lineitem""",
    # Labels with tied scores.
    "scored": """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS y,
  CASE WHEN event_id % 11 = 0 THEN 0.3E0 + 0.7E0 * (CAST((event_id * 37) % 1000 AS DOUBLE) / 1000) ELSE 0.8E0 * (CAST((event_id * 37) % 1000 AS DOUBLE) / 1000) END AS p FROM events""",
    # Model runs with ties and NaN scores.
    "runs": """
SELECT event_type AS dataset, CONCAT('model_', CAST(user_id % 7 AS STRING)) AS model, CAST(event_id % 5 AS INT) AS version,
  CAST(event_id AS INT) AS run_order, CAST(ts AS TIMESTAMP) AS created_at,
  CASE WHEN event_id % 97 = 0 THEN CAST('NaN' AS DOUBLE) WHEN value > 100 THEN 0.9E0 ELSE CAST(FLOOR(value) AS DOUBLE) / 200 END AS roc_auc,
  value AS f1 FROM events""",
}
NEEDS = {
    "runs": ["events"],
    "txn": ["events"],
    "txn_dup": ["txn"],
    "txn_dirty": ["txn"],
    "ip_country": ["nation", "region"],
    "card": ["lineitem"],
    "scored": ["events"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived view as a lazy frame over the parquet tables."""
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    sources = {need: view(spark, sf_dir, need) for need in NEEDS[name]}
    text = VIEWS[name]
    for need in NEEDS[name]:
        text = text.replace(f"FROM {need}", f"FROM {{{need}}}")
    return spark.sql(text, **sources)


def with_views(names: list[str], body: str, recursive: bool = False) -> str:
    """Oracle SQL: the named views, and those they need, as CTEs before ``body``.

    ``body`` either starts with further CTEs (``WITH ...``) or is a plain query.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for need in NEEDS[name]:
                add(need)
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
