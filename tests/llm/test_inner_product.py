import math
import random

import pytest
from pyspark.sql import functions as F

from clickloom.llm import inner_product as ip


def brute(rows, k):
    usable = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = {}
    for q, a in usable:
        if q is not None and q % 50 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b, strict=False)), c is None, c or 0, c) for c, b in usable if c != q]
            out[q] = [(c, -s) for s, _, _, c in sorted(scored)[:k]]
    return out


def run(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ip.top_inner_products(df, k, F.pmod("vec_id", F.lit(50)) == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    return {q: [hits[i] for i in sorted(hits)] for q, hits in got.items()}


def test_against_brute_force_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ip, "CANDIDATES_PER_BLOCK", 40)
    monkeypatch.setattr(ip, "QUERIES_PER_BLOCK", 2)
    monkeypatch.setattr(ip, "LONGEST", 30)
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) * (1 + i % 7) / 8 for _ in range(24)]) for i in range(400)]
    rows += [(400 + i, rows[i % 5][1]) for i in range(20)]  # ties
    rows = [(i, [float(F_) for F_ in v]) for i, v in rows]
    import numpy as np

    rows = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    assert run(spark, rows) == brute(rows, 5)


def test_edge_vectors(spark):
    rows = [
        (0, [1.0, -0.5]), (50, [0.0, 0.0]), (100, [0.25]), (150, None), (200, [1.0, None]), (250, [float("nan"), 1.0]),
        (300, [float("inf"), 1.0]), (7, [2.0, 2.0]), (8, [2.0, 2.0]), (None, [2.0, 2.0]), (9, []),
    ]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, []) == {}


def run_wide(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in
                  ip.top_inner_products(df, k, F.pmod("vec_id", F.lit(50)) == 0).collect())


def test_large_components_are_scored_while_a_long_holds_the_score(spark):
    rows = [(0, [2.0**20, 1.0]), (7, [2.0**20, 2.0]), (8, [-(2.0**22), 0.0])]
    big = 1 << 28
    assert run_wide(spark, rows) == [(0, 1, 7, big * big + 256 * 512), (0, 2, 8, -4 * big * big)]
    # 256 components whose squares add up to just below 2^63.
    side = math.isqrt(((1 << 63) - 1) // 256) // 256
    wide = [(0, [float(side)] * 256), (7, [float(side)] * 256), (8, [1.0] * 256)]
    assert run_wide(spark, wide) == [(0, 1, 7, 256 * (256 * side) ** 2), (0, 2, 8, 256 * 256 * 256 * side)]
    # The bound of lengths is beyond a long, the products are not.
    apart = [(0, [2.0**30, 0.0]), (7, [1.0, 2.0**30]), (8, [0.0, -(2.0**30)])]
    assert run_wide(spark, apart) == [(0, 1, 7, 2**38 * 256), (0, 2, 8, 0)]


def test_a_score_beyond_a_long_raises(spark):
    for wide in ([(0, [2.0**20 - 1] * 256), (7, [2.0**20 - 1] * 256)], [(0, [2.0**30, 1.0]), (7, [-(2.0**30), 1.0])],
                 [(0, [1.0, 2.0]), (7, [2.0**55, 1.0])]):
        with pytest.raises(Exception, match="fits no long|2\\^55"):
            run_wide(spark, wide)


def test_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [3.0, 0.0])]
    # Asked once, with its least vector; candidates that repeat each count.
    assert run_wide(spark, rows) == [(0, 1, 8, 128 * 768), (0, 2, 7, 128 * 256), (0, 3, 7, 128 * 256)]
