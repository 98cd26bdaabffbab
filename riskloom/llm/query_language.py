from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.language import fit_languages, predict_language
from riskloom.llm.registry import register


@register("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return predict_language(documents, fit_languages(documents))
