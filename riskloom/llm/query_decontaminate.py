from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.decontaminate import document_hits
from riskloom.llm.registry import register

SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, p, p + 9), ' ') AS k
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(p) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM win), grams AS (
  SELECT doc_id, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p)
), hits AS (
  SELECT DISTINCT g.doc_id, g.p, g.n, x.item_id FROM grams g JOIN win x ON g.k = x.k AND g.n = x.n
), words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register("op8_decontaminate", SQL)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
