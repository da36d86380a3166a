"""op8: quality of all documents, learnt from the rows that are not held out."""

from pyspark.sql import functions as F

from clickloom.llm import quality
from clickloom.llm.common import labelled_texts
from clickloom.llm.production import GOOD, held_out
from clickloom.llm.queries.registry import register


@register("op8_quality")
def op8_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules, intercept = quality.fit_table(labelled_texts(docs, labels, "quality", ~held_out(), quality.SAMPLE))
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    scored = stats.select(
        "doc_id", held_out().alias("held_out"), quality.compile_rules(rules, intercept).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
