from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import shuffle_partitions, table
from riskloom.llm.registry import register
from riskloom.llm.warc import archive, read_normalised

SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM r
"""


@register("op6_warc", SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = archive(table(spark, sf_dir, "pages")).repartition(shuffle_partitions(spark))
    return read_normalised(files, payloads=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
