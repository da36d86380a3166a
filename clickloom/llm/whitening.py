"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

1. Components become whole numbers, ``floor(256 x)``. The fit list is each
   distinct vector once, found by a grouped shuffle of compact byte keys.
2. Two passes over the fit list: exact sums per dimension, then the scatter of
   the vectors with the means subtracted. A task adds up one matrix and emits it
   row by row; rows are summed by a shuffle, so the driver sees width x width
   numbers, however many tasks there are.
3. ``pivoted_cholesky`` factors the covariance into L L' with its rows permuted,
   always the largest remaining diagonal element next. ``one_sided_jacobi``
   turns pairs of columns of the triangular factor until all are orthogonal: the
   product of L and a rotation, so its columns are the principal axes, their
   squared norms the eigenvalues, and the normalised columns the components.
   Neither step forms L'L, which would square the condition number.
4. Every row is projected. The covariance of the whitened fit list is computed
   from the projections and its distance to the identity goes with the result.

Defined cases. A vector that is null or holds null or non-finite entries takes
no part. Shorter vectors count as padded with zeros. Repeated vectors are one
of the fit list, and each of their rows has a result; ids may repeat or be null.
Dimensions without spread (down to rounding, 1e-13 of the largest eigenvalue)
give no component, so a fit list of one vector gives no rows, like an empty
table. Components with equal eigenvalues may be any basis of their space; the
largest entry of each is positive. Integers, sums and deviations that no long
holds raise. Only the id and the vector are read, so further columns may have
any name. The width of a vector bounds what the driver and a task hold (a few
matrices of width x width); rows come in bounded batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ship_code
from clickloom.session import cut_lineage

COMPONENTS = 4
SCALE = 256
_LIMIT = 2.0**63
_TOLERANCE = 1e-13
_KINDS = {2: "<i2", 4: "<i4", 8: "<i8"}


def scaled(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which rows take part, lengths of those, all their integers one after the other)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    items = column.flatten()
    holes = np.asarray(items.is_null())
    values = np.asarray(items.fill_null(0), np.float64)
    bad = holes | ~np.isfinite(values)
    owner = np.repeat(np.arange(len(column)), lengths)
    usable = np.asarray(column.is_valid()).copy()
    usable[owner[bad]] = False
    kept = np.floor(SCALE * values[usable[owner]])
    if len(kept) and np.abs(kept).max() >= _LIMIT:
        raise OverflowError("a vector component times 256 fits no long")
    return usable, lengths[usable], kept.astype(np.int64)


def keys_of(lengths: np.ndarray, integers: np.ndarray) -> list[bytes]:
    """One byte key per vector: the width of its numbers, then they, without the zeros at its end."""
    keys = []
    for end, n in zip(np.cumsum(lengths), lengths, strict=True):
        x = integers[end - n : end]
        places = np.flatnonzero(x)
        x = x[: places[-1] + 1] if len(places) else x[:0]
        low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
        size = next(s for s in _KINDS if -(1 << (8 * s - 1)) <= low and high < 1 << (8 * s - 1))
        keys.append(bytes([size]) + x.astype(_KINDS[size]).tobytes())
    return keys


def matrix_of(keys: list[bytes], width: int) -> np.ndarray:
    """Integer rows of byte keys, padded with zeros."""
    out = np.zeros((len(keys), width), np.int64)
    for i, key in enumerate(keys):
        x = np.frombuffer(key, _KINDS[key[0]], offset=1)
        out[i, : len(x)] = x
    return out


def fit_list(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(key, width) of each distinct vector, stored."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, lengths, integers = scaled(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(keys_of(lengths, integers), pa.binary())], names=["key"])

    ship_code(vectors.sparkSession)
    keys = vectors.select(F.col(vector).cast("array<double>")).mapInArrow(build, "key binary").distinct()
    items = F.length("key") - 1
    width = F.call_function("div", items, F.conv(F.hex(F.substring("key", 1, 1)), 16, 10).cast("long"))
    return cut_lineage(keys.withColumn("width", width.cast("int")))


def sums_of(fit: DataFrame, width: int) -> list[int]:
    """Exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            x = matrix_of(batch.column(0).to_pylist(), width)
            # Halves of 32 bits, so that a batch cannot overflow.
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(l) for t, h, l in zip(total, high, low, strict=True)]
        if any(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array([str(t) for t in total])], names=["dimension", "value"]
            )

    parts = fit.select("key").mapInArrow(add, "dimension int, value string")
    found = dict(parts.groupBy("dimension").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect())
    return [int(found.get(i, 0)) for i in range(width)]


def _scatter(fit: DataFrame, width: int, rows_of) -> np.ndarray:
    """Sum of the outer products of ``rows_of(integer matrix)``, which has ``width`` columns."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros((width, width)), False
        for batch in batches:
            y = rows_of(batch.column(0).to_pylist())
            total += y.T @ y
            any_row = any_row or len(y) > 0
        if any_row:
            at = np.arange(width)
            for i in range(width):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(width, i), pa.int32()), pa.array(at, pa.int32()), pa.array(total[i])],
                    names=["i", "j", "value"],
                )

    out = np.zeros((width, width))
    cells = fit.select("key").mapInArrow(add, "i int, j int, value double")
    for i, j, value in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[i, j] = value
    return (out + out.T) / 2


def pivoted_cholesky(v: np.ndarray, tolerance: float = _TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with ``v[order][:, order] = L L'``; L is lower triangular with as many columns as the rank."""
    n = len(v)
    a, order = v.astype(float).copy(), np.arange(n)
    factor = np.zeros((n, n))
    first = max(float(np.max(np.diag(a), initial=0.0)), 0.0)
    for k in range(n):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= tolerance * first or a[p, p] <= 0:
            return factor[:, :k], order
        for m in (a, factor):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        pivot = np.sqrt(a[k, k])
        factor[k, k] = pivot
        factor[k + 1 :, k] = a[k + 1 :, k] / pivot
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Columns of ``factor`` turned until all are orthogonal.

    Pairs are met as in a round-robin tournament: each round turns disjoint
    pairs, all at once.
    """
    x = factor.T.copy()
    n = len(x)
    players = list(range(n)) + ([-1] if n % 2 else [])
    half = len(players) // 2
    for _ in range(sweeps):
        worst = 0.0
        seats = players
        for _ in range(len(players) - 1):
            pairs = [(a, b) for a, b in zip(seats[:half], seats[half:][::-1], strict=True) if a >= 0 and b >= 0]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            p, q = (np.array(side, int) for side in zip(*pairs, strict=True))
            u, w = x[p], x[q]
            uu, ww, uw = (u * u).sum(axis=1), (w * w).sum(axis=1), (u * w).sum(axis=1)
            scale = np.sqrt(uu * ww)
            off = np.divide(np.abs(uw), scale, out=np.zeros_like(uw), where=scale > 0)
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > 1e-16
            if not turn.any():
                continue
            p, q, u, w = p[turn], q[turn], u[turn], w[turn]
            zeta = (ww[turn] - uu[turn]) / (2 * uw[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            c = (1 / np.sqrt(1 + t * t))[:, None]
            s = c * t[:, None]
            x[p], x[q] = c * u - s * w, s * u + c * w
        if worst < 1e-14:
            break
    return x.T


def principal_axes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a covariance, the largest first, zero ones left out."""
    factor, order = pivoted_cholesky(v)
    turned = one_sided_jacobi(factor) if factor.shape[1] > 1 else factor
    values = (turned * turned).sum(axis=0)
    by_size = np.argsort(-values, kind="stable")
    by_size = by_size[values[by_size] > _TOLERANCE * values.max(initial=0.0)]
    axes = np.zeros((len(v), len(by_size)))
    axes[order] = turned[:, by_size] / np.sqrt(values[by_size])
    largest = np.argmax(np.abs(axes), axis=0)
    return values[by_size], axes * np.where(axes[largest, np.arange(len(by_size))] < 0, -1.0, 1.0)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Sum over dimensions of (n x - S)^2 as exact longs."""
    far = max((max(abs(n * int(low) - s), abs(n * int(high) - s))
               for low, high, s in zip(x.min(axis=0), x.max(axis=0), sums, strict=True)), default=0)
    if len(sums) * far * far < 1 << 63:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1)
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation fits no long")
    return np.array(exact, np.int64)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n. The whole part of the mean is taken off in integers, so that large means lose nothing."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole) - part


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component."""
    fit = fit_list(vectors, vector)
    n, width = fit.agg(F.count("*"), F.coalesce(F.max("width"), F.lit(0))).first()
    sums = sums_of(fit, width)
    none = np.zeros((width, 0))
    if n and width:
        v = _scatter(fit, width, lambda keys: centred(matrix_of(keys, width), n, sums)) / n
        values, axes = principal_axes(v)
        explained = (values / np.trace(v))[:components].tolist() if len(values) else []
        onto = (axes / np.sqrt(values))[:, :components]
    else:
        explained, onto = [], none
    k = onto.shape[1]
    error = 0.0
    if k:
        # The whitened fit list, its own mean taken off as well.
        def projected(keys: list[bytes]) -> np.ndarray:
            z = centred(matrix_of(keys, width), n, sums) @ onto
            return np.column_stack([z, np.ones(len(z))])

        moments = _scatter(fit, k + 1, projected) / n
        means = moments[:k, k]
        error = float(np.abs(moments[:k, :k] - np.outer(means, means) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, lengths, integers = scaled(batch.column(1))
            rows = np.flatnonzero(usable)
            if not k or not len(rows):
                continue
            x = np.zeros((len(rows), width), np.int64)
            owner = np.repeat(np.arange(len(rows)), lengths)
            place = np.arange(len(integers)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            # What lies beyond the width are zeros.
            held = place < width
            x[owner[held], place[held]] = integers[held]
            z = centred(x, n, sums) @ onto
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                 pa.array(np.repeat(deviations(x, n, sums), k)), pa.array(z.ravel()),
                 pa.array(np.tile(explained, len(rows)))],
                names=["vec_id", "component", "deviation", "whitened", "explained"],
            )

    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    found = rows.mapInArrow(project, "vec_id long, component int, deviation long, whitened double, explained double")
    return found.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"),
    )
