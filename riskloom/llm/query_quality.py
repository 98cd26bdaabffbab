from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.learning import held_out
from riskloom.llm.quality import fit_quality, score_quality
from riskloom.llm.registry import register


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    model = fit_quality(documents, table(spark, sf_dir, "labels"))
    return score_quality(documents, model).select(
        F.col("columns.doc_id").alias("doc_id"),
        held_out(F.col("columns.doc_id")).alias("held_out"),
        "score",
        "kept",
    )
