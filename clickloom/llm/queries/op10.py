"""op10: exact duplicates of whole texts."""

from pyspark.sql import functions as F

from clickloom.llm import exact_dedup
from clickloom.llm.queries.registry import register

ORACLE = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, text_sha256,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept
FROM t
WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id)
"""


@register("op10_exact_dedup", ORACLE)
def op10_exact_dedup(spark, sf_dir):
    rows = exact_dedup.digest_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return exact_dedup.dedupe(rows, exact_dedup.first_half()).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
