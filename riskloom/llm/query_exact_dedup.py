from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.exact_dedup import exact_duplicates
from riskloom.llm.registry import register

SQL = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM digests WINDOW g AS (PARTITION BY text_sha256)
"""


@register("op9_exact_dedup", SQL)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))
