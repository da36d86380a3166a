"""op11: prefix trie of all conversations, each rebuilt on the start of a shared one."""

from pyspark.sql import functions as F

from clickloom.llm import conversation_trie
from clickloom.llm.common import crc_of
from clickloom.llm.queries.registry import register

MOST_SHARED = 5

# crc32 bit by bit, lowest bit first; keys are runs of 64-character turn hashes.
ORACLE = r"""
WITH turns AS (
    SELECT conv_id, length(coalesce(text, '')) AS chars,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h, turn
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) AS pos FROM turns
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, count(*) AS own,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1),
                   lambda i: list_transform(range(0, 8),
                       lambda j: ((ascii(substr(conv_id::VARCHAR, i, 1)) >> j::INT) & 1)::BIGINT)))),
               lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)
           ), 4294967295::BIGINT) % 6 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, p.pos AS place, p.h, p.chars FROM convs c JOIN placed p ON p.conv_id = c.base AND p.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1000000 + p.pos, p.h, p.chars FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.pos > c.h
), wholes AS (
    SELECT c.conv_id, coalesce(string_agg(r.h, '' ORDER BY r.place), '') AS whole,
           coalesce(list(r.chars ORDER BY r.place) FILTER (WHERE r.conv_id IS NOT NULL), []) AS chars
    FROM convs c LEFT JOIN rebuilt r ON c.conv_id = r.conv_id GROUP BY c.conv_id
), members AS (
    SELECT conv_id, unnest(range(0, len(chars) + 1)) AS depth, whole, chars FROM wholes
), nodes AS (
    SELECT left(whole, 64 * depth) AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           max(CASE WHEN depth = 0 THEN 0 ELSE chars[depth] END) AS chars,
           coalesce(string_agg(CASE WHEN depth = len(chars) THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
    FROM members GROUP BY ALL
), children AS (
    SELECT left(key, 64 * (depth - 1)) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), judged AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.key = c.key
), above AS (
    SELECT left(key, 64 * k) AS key, n_children = 0 AS leaf, (n_convs - 1) * chars AS saved
    FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM judged)
), sums AS (SELECT key, sum(leaf::INT) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY key)
SELECT j.conv_id, j.depth, p.conv_id AS parent_conv_id, j.n_convs, j.n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(j.ends) AS ends_sha256
FROM judged j JOIN sums s ON j.key = s.key
LEFT JOIN nodes p ON j.depth > 0 AND p.key = left(j.key, 64 * (j.depth - 1))
"""


@register("op11_conversation_trie", ORACLE)
def op11_conversation_trie(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    conv = F.col("conv_id")
    return conversation_trie.trie(rows, F.pmod(crc_of(conv), F.lit(MOST_SHARED + 1)), conv - conv % 100, MOST_SHARED)
