"""op2: near-duplicate groups of all documents (three-word shingles, 0.85)."""

from clickloom.llm import near_dedup
from clickloom.llm.queries.registry import register

ORACLE = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM words
), elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id < b.doc_id
    WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (
    SELECT doc_id AS node, doc_id AS other FROM documents
    UNION
    SELECT r.node, l.y FROM reach r JOIN links l ON r.other = l.x
), least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON doc_id = node
"""


@register("op2_near_dedup", ORACLE)
def op2_near_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, width=3, percent=85)
