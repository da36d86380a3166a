"""op12: all embeddings on their four largest principal components, whitened."""

from clickloom.llm import whitening
from clickloom.llm.queries.registry import register


@register("op12_embedding_whitening")
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
