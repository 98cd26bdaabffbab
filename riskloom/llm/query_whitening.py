from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.registry import register
from riskloom.llm.whitening import fit_whitening, whiten


@register("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return whiten(embeddings, fit_whitening(embeddings))
