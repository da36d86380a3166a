import re
from collections import defaultdict

import cases
import pytest

from __spark_entry__ import queries
from clickloom.llm import mixing

FOLDER = "/root/testdata/sf0.01"


def plain_targets(sizes):
    """Targets by the contract's words: cut at twice the size, share the excess by weight, again and again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target = {s: 0.0 for s in order}
    rest, open_ = 1.5 * sum(sizes.values()), set(order)
    while rest > 1e-6 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        rest = 0.0
        for s, v in share.items():
            target[s] += v
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def check(docs, rows):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    mixed = mixing.mix(docs, mixing.plan_mix(docs), column="m")
    got = mixed.select("doc_id", "text", "source", "m.*").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.taken in (0, r.size, 2 * r.size) and len(r.positions) == r.passes
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    expected = plain_targets(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source], rel=1e-9)
    for source, words in taken.items():
        assert abs(words - expected[source]) <= largest[source]
    return sorted((r.doc_id or -1, r.taken, tuple(r.positions)) for r in got)


def test_targets_and_cutoffs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = check(docs, docs.collect())
    again = check(docs.repartition(7), docs.collect())
    assert first == again


def test_edge_rows(spark):
    docs = cases.edge_docs(spark)
    check(docs, cases.edge_rows())
    empty = cases.edge_docs(spark, empty=True)
    assert mixing.mix(empty, mixing.plan_mix(empty)).count() == 0


def test_positions_follow_the_schedule(spark):
    rows = [(i, "w " * 20, "abc"[i % 3]) for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    ordered = mixing.in_training_order(mixing.mix(docs, mixing.plan_mix(docs)))
    positions = [r.mix for r in ordered.collect()]
    assert positions == sorted(positions)
    # The first source of each three fades out, the third fades in.
    early = defaultdict(int)
    total = defaultdict(int)
    for r in ordered.collect():
        total[r.source] += 1
        early[r.source] += r.mix < 0.5
    assert early["a"] / total["a"] == pytest.approx(0.625, abs=0.04)
    assert early["b"] / total["b"] == pytest.approx(0.5, abs=0.04)
    assert early["c"] / total["c"] == pytest.approx(0.375, abs=0.04)


@pytest.mark.parametrize("copies", [500, 7])
def test_repeated_rows_meet_the_target(spark, copies):
    # "b" weighs 1 of 6: its target is below its size, so the cutoff lies in the pile of copies.
    rows = [(5, "w " * 11, "b", "x")] * copies + [(i, "v " * 10, "a", "x") for i in range(100, 200)]
    rows += [(i, "u " * 10, "c", "y") for i in range(200, 300)]
    schema = "doc_id long, text string, source string, size__ string"
    results = []
    for parts in (1, 9):
        docs = spark.createDataFrame(rows, schema).repartition(parts)
        mixed = mixing.mix(docs, mixing.plan_mix(docs), column="m")
        assert mixed.columns == [*docs.columns, "m"]
        results.append(check(docs, rows))
        target, taken = mixed.where("source = 'b'").selectExpr("max(m.target) t", "sum(m.taken) n").first()
        assert abs(target - taken) <= 11
    assert results[0] == results[1]


def test_any_column_name(spark):
    names = ["plan__", "key__", "size__", "copy__", "hash__", "PART__", "row__", "front__", "inside__", "n__", "__key",
             "__size", "position__"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame([(1, "a b c", "s", *range(len(names)))] * 9 + [(2, "d", "t", *range(len(names)))], schema)
    mixed = mixing.mix(docs, mixing.plan_mix(docs), column="m")
    ordered = mixing.in_training_order(mixed, "m")
    assert mixed.columns == [*docs.columns, "m"] and ordered.columns == [*docs.columns, "m"]
    assert {tuple(r[3:-1]) for r in ordered.collect()} == {tuple(range(len(names)))}


def test_query_gives_places_in_the_range_sorted_order(spark, tmp_path):
    rows = cases.edge_rows()
    docs = spark.createDataFrame(rows + rows[:3], cases.SCHEMA).repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op9_curriculum_mix"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + 3
    assert all(len(r.places) == len(r.positions) for r in got)
    passes = sorted((place, position) for r in got for place, position in zip(r.places, r.positions, strict=True))
    assert [place for place, _ in passes] == list(range(1, len(passes) + 1))
    assert [position for _, position in passes] == sorted(position for _, position in passes)


def test_places_of_any_column_name_and_an_empty_table(spark):
    names = ["row__", "part__", "front__", "n__", "position__"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame([(i, "a b c", "s", *range(len(names))) for i in range(9)], schema)
    for table, n in ((docs, 9), (docs.limit(0), 0)):
        placed = mixing.training_places(mixing.mix(table, mixing.plan_mix(table)))
        assert placed.columns == [*docs.columns, "mix", "places"]
        got = placed.collect()
        assert len(got) == n and all(tuple(r[3:-2]) == tuple(range(len(names))) for r in got)
        assert sorted(p for r in got for p in r.places) == list(range(1, sum(len(r.places) for r in got) + 1))
