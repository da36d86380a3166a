"""op9: mix all documents to the sources' target weights, with their places in the training order."""

from clickloom.llm import mixing
from clickloom.llm.queries.registry import register


@register("op9_curriculum_mix")
def op9_curriculum_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.plan_mix(docs)).select("doc_id", "source", "mix")
    placed = mixing.training_places(mixed)
    return placed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "mix.positions", "places")
