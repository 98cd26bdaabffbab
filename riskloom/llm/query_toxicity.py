from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.registry import register
from riskloom.llm.toxicity import fit_toxicity, score_toxicity


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_toxicity(documents, fit_toxicity(documents, table(spark, sf_dir, "labels")))
