from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.ranked import build_index, search
from riskloom.llm.registry import register

SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL
), i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL
), total AS (
  SELECT count(*) AS big_n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0
), cells AS (
  SELECT doc_id, len(t) AS n, term, count(*) AS tf FROM (SELECT doc_id, t, unnest(t) AS term FROM d) GROUP BY doc_id, t, term
), df AS (
  SELECT term, count(*) AS df FROM cells GROUP BY term
), w AS (
  SELECT item_id, term, count(*) * CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM i JOIN df USING (term), total GROUP BY item_id, term, df, big_n
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // l)))) AS BIGINT) AS score
  FROM w JOIN cells USING (term), total GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""


@register("op13_ranked_search", SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
