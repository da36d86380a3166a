"""op5: language of all documents, learnt from the rows that are not held out."""

from pyspark.sql import functions as F

from clickloom.llm import language
from clickloom.llm.common import crc_of
from clickloom.llm.queries.registry import register


@register("op5_language_mixture")
def op5_language_mixture(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.pmod(crc_of(), F.lit(3)) == 1
    languages, table = language.train(docs.where(~held_out))
    judged = docs.select(
        "doc_id", held_out.alias("held_out"), language.identify(spark, "text", languages, table).alias("found")
    )
    return judged.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.languages", "found.proportions"
    )
