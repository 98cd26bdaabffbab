from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.html_text import extract
from riskloom.llm.registry import register


@register("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
