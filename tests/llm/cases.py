"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

from clickloom.llm.near_dedup import Parts
from clickloom.llm.shingles import overlap, shingle_set

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, row int, node int, pivot int"


def words(seed: int, n: int, letters: str = "abcdefghij") -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 8))) for _ in range(n))


def edge_rows() -> list[tuple]:
    long = words(1, 30_000)
    base = words(2, 120)
    texts = [
        (1, "Hello  World"), (2, "Hello World"), (3, " hello world "), (4, None), (5, ""), (6, " \t\n"),
        (7, long), (8, long + " end"), (9, base), (10, base + " more"), (11, base.upper()), (12, "one"),
        (12, "one"), (None, "one"), (None, None), (13, "one two"), (14, "ümläut 中文 \U0001F600"), (15, "a a a a a a"),
    ]
    sources = ["a", "b", None, "c"]
    return [
        (i, t, None if k % 5 == 0 else "en", sources[k % 4], None, k, k, k, k) for k, (i, t) in enumerate(texts)
    ]


def edge_docs(spark, empty: bool = False):
    return spark.createDataFrame([] if empty else edge_rows(), SCHEMA)


def brute_components(ids: list[int], texts: list[str | None], width: int, percent: int) -> list[int]:
    """Component ids by comparing all pairs: the definition, for small tests."""
    sets = [shingle_set(t or "", width) for t in texts]
    parts = Parts(len(ids))
    for i in range(len(ids)):
        for j in range(i):
            shared = overlap(sets[i], sets[j])
            if shared and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                parts.join(i, j)
    least: dict[int, int] = {}
    for i, doc in enumerate(ids):
        root = parts.find(i)
        least[root] = min(doc, least.get(root, doc))
    return [least[parts.find(i)] for i in range(len(ids))]
