import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm import conversation_trie as C
from clickloom.llm import tree_contraction as T
from clickloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth int, prefix int, n_convs int, range int"


def turn_digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def definition(rows):
    """Every prefix of every rebuilt conversation, in plain Python."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, turn_digest(role or "", text or ""), (role or "", text or "")))
    turns = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - (c % 100 if c >= 0 else -(-c % 100)))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, whole in rebuilt.items():
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    sums = {}
    for key in sorted(members, key=len, reverse=True):
        leaves = sum(sums[k][0] for k in children[key]) or 1
        saved = (len(members[key]) - 1) * (len(key[-1][1]) if key else 0) + sum(sums[k][1] for k in children[key])
        sums[key] = leaves, saved
    out = set()
    for key, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(key))))
        out.add((min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), len(children[key]),
                 *sums[key], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def run(spark, rows, chunk=C.CHUNK):
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(5)
    conv = F.col("conv_id")
    h = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(6))
    found = C.trie(frame, h, conv - conv % 100, 5, chunk=chunk).collect()
    assert len(found) == len({(r.conv_id, r.depth) for r in found})
    return {tuple(r) for r in found}


def conversations(seed, n, texts=3, longest=9):
    draw = random.Random(seed)
    return [(draw.randrange(0, 350), t, draw.choice(["user", "bot", None]), draw.choice([None, "", "a", "bb ü\U0001F600"][:texts]))
            for _ in range(n) for t in range(draw.randint(1, longest))]


@pytest.mark.parametrize("chunk", [C.CHUNK, 2])
def test_against_plain_python(spark, chunk):
    rows = [r for c, r in enumerate(conversations(1, 60))]
    # Ids that no base holds, negative ones, an id whose base is absent, nulls, repeats.
    rows += [(-5, 1, "user", "a"), (-105, 1, "user", "a"), (100_042, 3, "bot", "x" * 5000), (None, 1, "user", "lost"),
             (7, None, None, None), (7, None, "user", "first"), (7, 2, "user", "twice"), (7, 2, "user", "twice")]
    assert run(spark, rows, chunk) == definition(rows)


def test_long_chains_and_wide_nodes(spark):
    # One conversation of 300 turns whose prefixes end in others, and a first turn with many different seconds.
    rows = [(100 + k, t, "user", f"t{t}") for k in (0, 1, 2, 3) for t in range(300 - 70 * k)]
    rows += [(c, t, "user", "same" if t < 6 else f"own {c}") for c in range(1000, 1100) for t in range(8)]
    assert run(spark, rows, chunk=16) == definition(rows)


def test_edges(spark):
    assert run(spark, []) == run(spark, [(None, None, None, None)]) == set()
    # Turnless: fewer own turns than are replaced, and no conversation to take them from.
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    assert run(spark, [(turnless, 1, "user", "a")]) == {
        (turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())
    }


def test_query_against_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in QUERIES["op11_conversation_trie"](spark, folder).collect()} == definition(rows)


@pytest.mark.parametrize("kind", ["random", "path", "star", "caterpillar", "forest"])
def test_subtree_sums(spark, kind):
    draw = random.Random(kind)
    n = 200
    parent = {
        "random": lambda i: draw.randrange(i), "path": lambda i: i - 1, "star": lambda i: 0,
        "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2), "forest": lambda i: None if i % 40 == 0 else i - 1,
    }[kind]
    parents = [None] + [parent(i) for i in range(1, n)]
    values = [draw.choice([None, 0, 1, 7]) for _ in range(n)]
    expected = [v or 0 for v in values]
    for i in range(n - 1, 0, -1):
        if parents[i] is not None:
            expected[parents[i]] += expected[i]
    nodes = spark.createDataFrame(list(zip(range(n), parents, values, strict=True)), "id long, parent long, v long")
    assert dict(T.subtree_sums(nodes, ["v"]).collect()) == dict(enumerate(expected))


def test_a_path_takes_logarithmic_rounds(spark, monkeypatch):
    steps, stored = [], T.cut_lineage
    monkeypatch.setattr(T, "cut_lineage", lambda df: steps.append(1) or stored(df))
    nodes = spark.range(500).selectExpr("id", "if(id = 0, null, id - 1) as parent", "1 as v")
    assert dict(T.subtree_sums(nodes, ["v"]).collect())[0] == 500
    assert len(steps) <= 30


def test_a_circle_raises(spark):
    nodes = spark.createDataFrame([(0, None, 1), (1, 2, 1), (2, 1, 1)], "id long, parent long, v long")
    with pytest.raises(ValueError, match="circle"):
        T.subtree_sums(nodes, ["v"])
