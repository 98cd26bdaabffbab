import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.llm.registry import register
from riskloom.llm.token_files import read_token_files, token_files

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


@register("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    folder, manifest = token_files(documents, public_tokenizers.path(TOKENIZER), END_ID, blanks_matter=False)
    return read_token_files(spark, folder, manifest).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32"
    )
