import random

import cases
import numpy as np
import pytest

from clickloom.llm import near_dedup
from clickloom.llm import shingles as S


def definition(text, width):
    """The shingle set as tuples of words."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_copies(n=60, seed=5):
    """Groups with chains: neighbours are close, ends are not."""
    draw = random.Random(seed)
    rows, at = [], 0
    for _ in range(6):
        text = cases.words(draw.randint(0, 10**6), draw.choice([8, 40, 150])).split()
        for _ in range(n // 6):
            rows.append((at, " ".join(text)))
            at += draw.choice([1, 3])
            for _ in range(max(1, len(text) // 60)):
                text[draw.randrange(len(text))] = "x" + str(draw.randrange(1000))
    draw.shuffle(rows)
    return rows


def test_shingles_match_their_definition():
    for row in cases.edge_rows():
        for width in (1, 3, 5):
            assert len(S.shingle_set(row[1] or "", width)) == len(definition(row[1], width))
    a, b = S.shingle_set("A b\x0bc d e", 3), S.shingle_set("x a B c\td", 3)
    assert S.overlap(a, b) == 2


def test_signature_estimates_similarity():
    draw = np.random.default_rng(3)
    both = draw.integers(0, 1 << 62, 800).astype(np.uint64)
    a, b = np.sort(both[:600]), np.sort(both[200:])
    same = (S.signature(a, 480) == S.signature(b, 480)).mean()
    assert abs(same - 0.5) < 0.1


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
@pytest.mark.parametrize("block", [1_000_000, 300])
def test_components_against_all_pairs(spark, width, percent, block):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs, width, percent, block_shingles=block).collect()}
    ids = [i for i, _ in rows]
    expected = cases.brute_components(ids, [t for _, t in rows], width, percent)
    assert {i: got[i].component_id for i in ids} == dict(zip(ids, expected, strict=True))
    assert len(set(expected)) < len(ids) - 10
    for i, t in rows:
        assert got[i].n_shingles == len(definition(t, width))
        assert got[i].kept == (i == got[i].component_id)


def test_blocks_report_a_spanning_part_only():
    sets = [S.shingle_set(cases.words(9, 50) + f" t{i % 3}", 3) for i in range(200)]
    links = near_dedup.link_block(list(range(200)), sets, [False] * 200, 80)
    assert len(links) == 199
    guests = [i == 7 for i in range(200)]
    assert {a for a, _ in near_dedup.link_block(list(range(200)), sets, guests, 80)} == {7}


def test_loose_nodes_meet_two_blocks_at_most_and_no_strangers(spark, monkeypatch):
    draw = random.Random(8)
    shared, rows = cases.words(11, 150), []
    for i in range(60):
        own = cases.words(1000 + i, 50)
        rows.append((i, f"{shared} {own}"))
        if i % 10 == 0:
            # One near copy, most likely in another block.
            rows.append((100 + i, f"{shared} {own} end"))
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    passes, verify = [], near_dedup._verify
    monkeypatch.setattr(near_dedup, "_verify", lambda members, *rest: passes.append(members) or verify(members, *rest))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 5, 80, block_shingles=2_000).collect()}
    ids = [i for i, _ in rows]
    assert got == dict(zip(ids, cases.brute_components(ids, [t for _, t in rows], 5, 80), strict=True))
    first, second = ([r.asDict() for r in p.collect()] for p in passes)
    assert len({r["block"] for r in first}) >= 4
    # Texts alike in what all share meet by chance alone (a boundary with the same next word); near copies do meet.
    by_task = {}
    for r in second:
        by_task.setdefault((r["pivot"], r["block"], r.get("other")), set()).add(r["node"])
    assert by_task and max(map(len, by_task.values())) <= 8
    assert any({i, 100 + i} <= nodes for nodes in by_task.values() for i in range(0, 60, 10))
    print("second pass:", len(second), "rows, largest task", max(map(len, by_task.values())))


def test_sets_at_the_threshold_share_a_first_element():
    draw = np.random.default_rng(1)
    for n in (1, 2, 5, 20, 100, 333):
        for percent in (80, 85):
            both = draw.integers(0, 1 << 62, 2 * n).astype(np.uint64)
            for shift in range(n // 3 + 1):
                a, b = np.sort(both[:n]), np.sort(both[shift : n + shift])
                last = np.sort(draw.choice(both, n, replace=False))
                if 100 * (n - shift) >= percent * (n + shift):
                    firsts = [near_dedup.first_elements(x, last, percent) for x in (a, b)]
                    assert len(np.intersect1d(*firsts))


def test_edge_rows(spark):
    got = near_dedup.near_duplicates(cases.edge_docs(spark), 3, 85).collect()
    assert len(got) == len(cases.edge_rows())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[4].n_shingles == by_id[5].n_shingles == by_id[6].n_shingles == 0
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[8].component_id == 7 and by_id[10].component_id == by_id[11].component_id == 9
    nameless = [r for r in got if r.doc_id is None]
    assert sorted((r.component_id or -1, r.kept) for r in nameless) == [(-1, True), (12, False)]
    assert near_dedup.near_duplicates(cases.edge_docs(spark, empty=True), 3, 85).count() == 0
    kept = near_dedup.drop_near_duplicates(cases.edge_docs(spark), 3, 85)
    assert kept.columns == cases.edge_docs(spark).columns


def thue_morse(n=10):
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_words_built_to_collide_have_their_own_hashes(spark):
    # Equal under any polynomial modulo 2^64.
    a, b = thue_morse()
    assert S.word_hashes(a) != S.word_hashes(b) and S.word_hashes(f"{a} x")[0] == S.word_hashes(a.upper())[0]
    rest = cases.words(3, 10)
    docs = spark.createDataFrame([(1, f"{a} {a} {rest}"), (2, f"{b} {b} {rest}"), (3, a), (4, b)], "doc_id long, text string")
    got = near_dedup.near_duplicates(docs, 3, 85).collect()
    assert all(r.component_id == r.doc_id and r.kept for r in got)


def test_long_and_short_words_hash_alike_wherever_they_stand():
    short, long = "abc", "x" * 200
    assert S.word_hashes(short)[0] == S.word_hashes(f"{long} {short}")[1]
    assert S.word_hashes("ab")[0] != S.word_hashes("ba")[0] != S.word_hashes("b a")[0]


def test_links_have_to_be_confirmed():
    sets = [S.shingle_set("a b c d", 3)] * 3
    assert near_dedup.link_block([1, 2, 3], sets, [False] * 3, 80, lambda i, j: (i, j) == (1, 2)) == [(2, 3)]
    assert S.linked("A b c d", "a B c d", 3, 100) and not S.linked("a b c d", "a b c e", 3, 80)
    assert not S.linked("", "", 3, 80) and S.linked("One", "one", 3, 85)


def test_only_texts_of_members_are_dealt(spark, monkeypatch):
    docs = spark.range(4_000).selectExpr("id as doc_id", "concat('text ', id) as text")
    docs = docs.unionByName(docs.where("doc_id = 400").selectExpr("doc_id", "'another text' as text"))
    members = spark.range(0, 4_000, 200).selectExpr("0L as pivot", "0 as block", "0 as other", "id as node", "false as guest")
    moved, real = [], type(docs).hint
    monkeypatch.setattr(type(docs), "hint", lambda df, *a: moved.append(df.count()) or real(df, *a))
    dealt = near_dedup._dealt(members, docs, "doc_id", "text").collect()
    assert sorted(r.node for r in dealt) == sorted([*range(0, 4_000, 200), 400])
    # What the join shuffles.
    assert len(moved) == 1 and 21 <= moved[0] < 400
