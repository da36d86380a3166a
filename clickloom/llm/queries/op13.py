"""op13: components of all documents whose three-word shingles reach a Jaccard similarity of 0.9."""

from clickloom.llm import jaccard_join
from clickloom.llm.queries.op2 import ORACLE as NEAR
from clickloom.llm.queries.registry import register

# The same definition as that of op2, at another threshold and without the verdict.
ORACLE = NEAR.replace("85 *", "90 *").replace(", doc_id = component_id AS kept", "")


@register("op13_jaccard_join", ORACLE)
def op13_jaccard_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_join.jaccard_join(docs, width=3, percent=90)
