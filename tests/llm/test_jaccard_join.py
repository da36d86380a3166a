import random

import cases
import numpy as np
import pytest

from clickloom.llm import jaccard_join as J
from clickloom.llm import shingles as S


def grown(n=60, seed=3):
    """Texts in groups of slow change, many with one passage in common, some equal."""
    draw = random.Random(seed)
    passage, rows, at = cases.words(77, 60), [], 0
    for g in range(8):
        text = cases.words(draw.randint(0, 10**6), draw.choice([4, 12, 40, 150])).split()
        for _ in range(n // 8):
            rows.append((at, " ".join([*([passage] if g % 2 else []), *text])))
            at += draw.choice([1, 3])
            for _ in range(draw.randint(0, max(1, len(text) // 60))):
                text[draw.randrange(len(text))] = "x" + str(draw.randrange(1000))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "percent", "limits"), [(3, 90, {}), (5, 80, {}),
                                                         (3, 90, {"block_prefixes": 60, "block_shingles": 300})])
def test_components_against_all_pairs(spark, width, percent, limits):
    rows = grown()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in J.jaccard_join(docs, width, percent, **limits).collect()}
    ids = [i for i, _ in rows]
    expected = cases.brute_components(ids, [t for _, t in rows], width, percent)
    assert {i: got[i].component_id for i in ids} == dict(zip(ids, expected, strict=True))
    assert len(set(expected)) < len(ids) - 8
    assert all(got[i].n_shingles == len(S.word_shingles(t, width)) for i, t in rows)


@pytest.mark.parametrize("percent", [70, 80, 90, 97])
def test_prefixes_of_sets_that_link_share_the_steps_they_ask_for(percent):
    draw = np.random.default_rng(percent)
    levels = draw.integers(0, 60, J.COUNTERS).astype(np.uint8)
    asked, linked = set(), 0
    for n in (*range(2, 24), 50, 200):
        for _ in range(30):
            both = int(draw.integers(n * percent // 100, n + 1))
            pool = draw.integers(0, 1 << 62, 3 * n).astype(np.uint64)
            a = np.sort(pool[:n])
            b = np.sort(np.concatenate([pool[:both], pool[n : n + int(draw.integers(0, n * (100 - percent) // percent + 2))]]))
            if len(a) == len(b) == both or 100 * both < percent * (len(a) + len(b) - both):
                continue
            linked += 1
            # Any two lengths, not only the cheapest ones.
            for most in ((1, 1), (8, 8), (1, 8), (8, 3)):
                (m, p), (k, q) = (J.prefix_of(x, levels, 0.0, percent, w) for x, w in zip((a, b), most, strict=True))
                assert len(np.intersect1d(p, q)) >= min(m, k) >= 1
                asked |= {m, k}
    assert linked > 15 and {1, 8} <= asked


def test_every_set_that_can_link_has_a_prefix():
    for percent in range(70, 101):
        for n in range(1, 400):
            if 100 * n >= percent * (n + 1):
                assert J.most_apart(n, percent) + n - J.least_shared(n, percent) + 2 <= n


def test_costly_prefixes_are_longer_and_ask_for_more():
    shingles = np.sort(np.random.default_rng(2).integers(0, 1 << 62, 100).astype(np.uint64))
    levels = np.full(J.COUNTERS, 4, np.uint8)
    rare = J.prefix_of(shingles, levels, 0.0, 90)
    # 100 - 90 shingles may be missing, 11 may part common ones.
    assert rare[0] == 1 and len(rare[1]) == 22
    levels[J.counter_of(shingles[:85])] = 32
    often = J.prefix_of(shingles, levels, 0.0, 90)
    assert often[0] > 1 and len(often[1]) == 21 + often[0]


def test_too_few_matches_part_documents():
    prefixes = [np.array(p, np.int64) for p in ([1, 2, 3], [2, 3, 9], [3, 20, 21], [3, 30, 31])]
    sizes = np.full(4, 30)
    assert J.candidates(sizes, sizes, np.array([2, 2, 2, 2]), prefixes, 90) == [[0, 1]]
    assert J.candidates(sizes, sizes, np.array([2, 2, 1, 2]), prefixes, 90) == [[0, 1, 2, 3]]
    apart = np.array([30, 30, 20, 20])
    assert J.candidates(apart, apart, np.ones(4, int), prefixes, 90) == [[0, 1], [2, 3]]


def test_counts_cover_all_documents(spark):
    docs = spark.createDataFrame([(i, f"same three words own{i} text{i}") for i in range(300)], "doc_id long, text string")
    levels, mean = J.shingle_counts(docs.repartition(7), 3)
    same, own = S.shingle_set("same three words", 3), S.shingle_set("three words own5", 3)
    assert levels[J.counter_of(same)][0] == round(4 * np.log2(301)) and levels[J.counter_of(own)][0] <= 8
    assert mean * J.COUNTERS == 300 * 3


def test_edge_rows(spark):
    got = J.jaccard_join(cases.edge_docs(spark), 3, 90).collect()
    assert len(got) == len(cases.edge_rows())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[4].n_shingles == by_id[5].n_shingles == by_id[6].n_shingles == 0
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[8].component_id == 7 and by_id[10].component_id == by_id[11].component_id == 9
    assert sorted(r.component_id or -1 for r in got if r.doc_id is None) == [-1, 12]
    assert J.jaccard_join(cases.edge_docs(spark, empty=True), 3, 90).count() == 0


def test_texts_of_one_id_link_as_one_document(spark):
    a, b = cases.words(5, 60), cases.words(6, 60)
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, cases.words(7, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in J.jaccard_join(docs, 3, 90).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}
