import random

import pytest

from clickloom.operators import graph
from clickloom.operators.graph import connected_components


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_by_group(spark, seed):
    rng = random.Random(seed)
    edges = []
    for group in ("a", "b"):
        ids = [rng.randint(-2**62, 2**62) for _ in range(80)]
        edges += [(group, rng.choice(ids), rng.choice(ids)) for _ in range(60)]
        # A hub, a long chain and a self loop.
        edges += [(group, ids[0], x) for x in ids[1:25]]
        edges += [(group, 1000 + i, 1001 + i) for i in range(20)]
        edges += [(group, 7, 7)]
    df = spark.createDataFrame(edges + [("a", None, 5), ("a", 9, None)], "g string, src bigint, dst bigint")
    got = {(r.g, r.node): r.component for r in connected_components(df, ["g"]).collect()}
    want = {}
    for group in ("a", "b"):
        for node, root in union_find([(s, d) for g, s, d in edges if g == group]).items():
            want[(group, node)] = root
    assert got == want


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_pendants_take_no_part_in_the_rounds(spark, monkeypatch):
    given, solve = [], graph._solve
    monkeypatch.setattr(graph, "_solve", lambda edges, by: given.append(edges.count()) or solve(edges, by))
    rng = random.Random(3)
    hubs = [rng.randint(-2**62, 2**62) for _ in range(30)]
    edges = [(hub, rng.randint(-2**62, 2**62)) for hub in hubs for _ in range(20)]
    # Repeated edges, two sources of one target, a source that is a target too, a null.
    edges += edges[:40] + [(hubs[0], 5), (hubs[1], 5), (hubs[2], hubs[3]), (None, 6), (hubs[4], None)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == union_find([e for e in edges if None not in e])
    assert len(given) == 1 and given[0] < 10
    stars = connected_components(spark.createDataFrame(edges[:100], "src bigint, dst bigint")).collect()
    assert len(given) == 1 and {r.node: r.component for r in stars} == union_find(edges[:100])
