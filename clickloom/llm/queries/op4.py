"""op4: toxicity of all documents, learnt from the rows that are not held out."""

from pyspark.sql import functions as F

from clickloom.llm import toxicity
from clickloom.llm.production import TOXIC, held_out, toxicity_model
from clickloom.llm.queries.registry import register


@register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    score = toxicity.toxicity("text", *toxicity_model(spark, sf_dir))
    scored = docs.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
