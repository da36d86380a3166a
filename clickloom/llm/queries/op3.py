"""op3: pack all documents into sequences of at most 1,024 tokens."""

from pyspark.sql import functions as F

from clickloom.llm import packing
from clickloom.llm.production import TOKENIZER
from clickloom.llm.queries.registry import register


@register("op3_best_fit_packing")
def op3_best_fit_packing(spark, sf_dir):
    pieces = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), **TOKENIZER)
    return pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
