"""op7: token counts of all documents under the unigram reading of a public vocabulary."""

import public_tokenizers
from pyspark.sql import functions as F

from clickloom.llm import unigram
from clickloom.llm.common import small_batches, text_of
from clickloom.llm.queries.registry import register

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@register("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(
        "doc_id", F.length(text_of()).cast("long").alias("n_points"),
        unigram.token_count("text", VOCABULARY).alias("n_tokens"),
    )
