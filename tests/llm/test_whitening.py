import numpy as np
import pytest

from clickloom.llm import whitening as W
from clickloom.llm.queries import QUERIES


def definition(rows):
    """(n, S, V) and the integers of each remaining row, in plain numpy."""
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in kept), default=0)
    padded = [(i, (*v, *[0] * (width - len(v)))) for i, v in kept]
    fit = np.array(sorted({v for _, v in padded}), float).reshape(-1, width)
    v = np.cov(fit.T, bias=True).reshape(width, width) if len(fit) else np.zeros((width, width))
    return padded, len(fit), [int(s) for s in fit.sum(axis=0)], v


def check(found, rows):
    padded, n, sums, v = definition(rows)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    rank = int((values > 1e-9 * max(values.max(initial=0), 1e-300)).sum())
    k = min(4, rank)
    by_key = {}
    for r in found:
        by_key.setdefault((r.vec_id, r.component), []).append(r)
    assert len(found) == k * len(padded)
    for c in range(k):
        signs = set()
        for i, x in padded:
            row = by_key[i, c + 1][0]
            z = (np.array(x, float) - np.array(sums) / n) @ axes[:, c] / np.sqrt(values[c])
            assert row.n == n and row.identity_error <= 1e-6
            assert row.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            assert abs(row.explained / (values[c] / np.trace(v)) - 1) < 1e-9
            assert abs(abs(row.whitened) - abs(z)) < 1e-7
            if abs(z) > 1e-3:
                signs.add(np.sign(row.whitened * z))
        assert len(signs) == 1


@pytest.mark.parametrize("shape", [(1, 1), (3, 3), (7, 7), (20, 6), (33, 33)])
def test_factor_and_axes(shape):
    draw = np.random.default_rng(shape[0])
    x = draw.normal(size=(shape[1], shape[0])) * 10.0 ** draw.integers(-4, 3, shape[0])
    v = x.T @ x
    factor, order = W.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v[order][:, order], rtol=1e-9, atol=1e-9 * v.max())
    assert np.allclose(np.triu(factor, 1), 0) and factor.shape[1] <= min(shape)
    values, axes = W.principal_axes(v)
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-8)
    expected = np.linalg.eigvalsh(v)[::-1][: len(values)]
    assert np.allclose(values, expected, rtol=1e-8, atol=1e-12 * v.max())


def test_small_eigenvalues_keep_their_digits():
    # Graded scales: the smallest eigenvalue is 1e-12 of the largest and still exact to many digits.
    d = np.array([1.0, 1e-3, 1e-6])
    c = np.array([[1, 0.5, 0.2], [0.5, 1, 0.3], [0.2, 0.3, 1]])
    values, _ = W.principal_axes(c * np.outer(d, d))
    assert abs(values[2] / (np.linalg.det(c) / (1 - 0.25) * 1e-12) - 1) < 1e-4


def test_against_brute_force(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(120, 8)) * [3, 2, 1.5, 1, 0.5, 0.1, 0.01, 0]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(200 + i, base[0].tolist()) for i in range(150)]
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 8), (903, [float("inf"), 1.0]),
             (904, []), (905, [1.0]), (906, [-0.0, 0.0]), (907, [1.0, 0.0, 0.0])]
    vectors = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                                    "vec_id long, embedding array<double>, key int, width int, component int")
    check(W.whiten(vectors.repartition(5)).collect(), rows)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(QUERIES["op12_embedding_whitening"](spark, folder).collect(), rows)


def test_edges(spark):
    schema = "vec_id long, embedding array<float>"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    assert W.whiten(frame([])).collect() == []
    assert W.whiten(frame([(1, None), (2, [])])).collect() == []
    assert W.whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    found = W.whiten(frame([(None, [0.0, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in sorted(found, key=lambda r: r.vec_id or 0)] == [
        (None, 1, 2, 2 * 256**2), (7, 1, 2, 2 * 256**2), (7, 1, 2, 2 * 256**2)
    ]
    assert {round(abs(r.whitened), 9) for r in found} == {1.0} and found[0].explained == pytest.approx(1)


def test_numbers_beyond_a_long_raise(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for rows in ([(1, [1e30]), (2, [0.0])], [(1, [1e12]), (2, [0.0])]):
        with pytest.raises(Exception, match="fits no long"):
            W.whiten(frame(rows)).collect()
    # Products of 2^62 in all are exact.
    found = W.whiten(frame([(1, [2.0**22]), (2, [0.0])])).collect()
    assert {r.deviation for r in found} == {1 << 60}


def test_keys_are_one_per_vector():
    vectors = [[], [0], [1], [1, 0], [300, -1], [1 << 20], [1 << 40, 5], [-32768], [32768]]
    lengths = np.array([len(v) for v in vectors])
    keys = W.keys_of(lengths, np.array([x for v in vectors for x in v], np.int64))
    assert keys[0] == keys[1] and keys[2] == keys[3] and len(set(keys)) == len(vectors) - 2
    assert W.matrix_of(keys, 2).tolist() == [(v + [0, 0])[:2] for v in vectors]
