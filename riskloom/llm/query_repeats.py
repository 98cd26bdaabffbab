from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.registry import register
from riskloom.llm.repeats import without_repeats

SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), w AS (
  SELECT doc_id, p, substr(x, 2 * p + 1, 200) AS s FROM d, unnest(range(0, length(x) // 2 - 99)) AS t(p)
), r AS (
  SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1
), marked AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS new FROM r
), numbered AS (
  SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked
), spans AS (
  SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, span
), pieces AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans
), cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(concat(coalesce(head, ''), substr(x, 2 * coalesce(last, 0) + 1)))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


@register("op3_repeats", SQL)
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), keep_text=False).drop("kept_text")
