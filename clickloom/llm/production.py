"""Parameters that the queries and the pipeline share."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import toxicity
from clickloom.llm.common import crc_of, labelled_texts

TOKENIZER = {
    "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
}
TOXIC = 0.3
GOOD = 0.7


def held_out() -> Column:
    """Documents whose labels no classifier may learn from."""
    return F.pmod(crc_of(), F.lit(4)) == 2


def toxicity_model(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], float]:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.fit_table(labelled_texts(docs, labels, "toxic", ~held_out(), toxicity.SAMPLE))
