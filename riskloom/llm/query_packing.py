import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table
from riskloom.llm.packing import pack_documents
from riskloom.llm.registry import register

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0


@register("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)
