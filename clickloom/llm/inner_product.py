"""Exact top-k inner products over vectors sorted by length.

Vectors are turned by the right singular vectors of the whole set, so the first
coordinates hold most of every inner product. A vector keeps its first ``HEAD``
turned coordinates and the lengths of the whole vector and of the rest. By
Cauchy-Schwarz, ``|q| |v|`` bounds a product, and the sum over the first
coordinates plus ``|rest of q| |rest of v|`` bounds it more closely.

Candidates are range-partitioned by descending length and packed into blocks,
queries are packed into blocks as well. The longest vectors are scored against
every query first, which gives each query the score that a candidate must
reach. A pair of blocks is then formed only if the product of their greatest
lengths can reach the least such score of the query block; a block pair stops
at the first candidate that is too short, scores the first coordinates of the
others, and computes whole products for those whose bound reaches the score.
Final scores are integer sums, so pruning never changes a result; bounds are
widened by a relative 1e-6 against rounding. At most k rows of each query leave
a block pair.

Defined cases. Vectors that are null or hold null or non-finite components take
no part. A finite component whose integer fits no long (2^55 or more) raises. Where
the lengths of a query and a candidate that is reached allow a product beyond a
long, it is added up without a limit; a result that fits no long raises.
Shorter vectors count as padded with zeros. Rows without an id take no part as
queries; as candidates they come last among ties. Rows that repeat a query's id
count as the query's own. A query id that repeats is asked once, with its least
vector. Repeated candidates each count. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import ship_code
from clickloom.session import cut_lineage

HEAD = 16
CANDIDATES_PER_BLOCK = 4_096
QUERIES_PER_BLOCK = 512
# Vectors whose products give every query its first threshold.
LONGEST = 2_048
SLACK = 1e-6

_HITS = "query_id long, vec_id long, score long"


def integers(vector: Column) -> Column:
    """floor(256 x) of each component, null where the vector takes no part; too large a component raises."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * 256))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double")) < float(1 << 55))
    too_large = F.raise_error(F.lit("a vector component is 2^55 or more in absolute value"))
    return F.when(usable & ~fits, too_large).when(usable, F.transform(scaled, lambda x: x.cast("long")))


def squared_length(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors (columns) of all vectors, by their summed outer products.

    Each task adds up one width x width matrix; the driver adds one matrix per task.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column(0), width).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(total.ravel())], names=["value"])

    parts = vectors.select("v").mapInArrow(products, "value double")
    numbered = parts.withColumn("cell", F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)))
    cells = numbered.groupBy("cell").agg(F.sum("value").alias("value")).collect()
    gram = np.zeros(width * width)
    for cell, value in cells:
        gram[cell] = value
    _, turned = np.linalg.eigh(gram.reshape(width, width)) if width else (None, np.zeros((0, 0)))
    return np.ascontiguousarray(turned[:, ::-1])


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer rows padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.int64)
    out = np.zeros((len(column), width), np.int64)
    if len(flat):
        rows = np.repeat(np.arange(len(column)), lengths)
        at = np.arange(len(flat)) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        out[rows, at] = flat
    return out


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


_NO_ID = np.iinfo(np.int64).max
_LONGS = np.iinfo(np.int64)


def products(held: np.ndarray, query: np.ndarray, reach: float) -> np.ndarray:
    """Whole inner products; ``reach`` bounds them in absolute value."""
    if reach < 2.0**62:
        return held @ query
    exact = [sum(int(a) * int(b) for a, b in zip(row, query, strict=True)) for row in held]
    if max(exact) > _LONGS.max:
        raise OverflowError("an inner product fits no long")
    # What is too low stays behind all that fits.
    return np.array([max(x, _LONGS.min) for x in exact], np.int64)


class Block:
    """Vectors of one block with what the bounds need."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray):
        self.ids, self.vectors = ids, vectors
        turned = vectors.astype(float) @ turn
        self.head = turned[:, :HEAD]
        self.length = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        self.rest = np.sqrt((turned[:, HEAD:] ** 2).sum(axis=1))


def search(queries: Block, least: np.ndarray, held: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, ids, scores) of at most k candidates that can reach ``least``.

    ``held`` is sorted by descending length.
    """
    for i in range(len(queries.ids)):
        floor = least[i]
        # Lengths descend: every candidate from here on is too short.
        stop = len(held.ids)
        if np.isfinite(floor):
            reach = queries.length[i] * held.length * (1 + SLACK) + SLACK
            stop = int(np.searchsorted(-reach, -floor, side="right"))
        if not stop:
            continue
        partial = held.head[:stop] @ queries.head[i]
        bound = partial + queries.rest[i] * held.rest[:stop]
        bound += SLACK * (1 + queries.length[i] * held.length[:stop])
        near = np.flatnonzero((bound >= floor) & (held.ids[:stop] != queries.ids[i]))
        if not len(near):
            continue
        reach = queries.length[i] * held.length[near].max() * (1 + SLACK)
        scores = products(held.vectors[near], queries.vectors[i], reach)
        best = _top(scores, held.ids[near], k)
        if (scores[best] == _LONGS.min).any():
            raise OverflowError("an inner product fits no long")
        keep = best[scores[best] >= floor]
        if len(keep):
            yield i, held.ids[near[keep]], scores[keep]


def _packed(rows: DataFrame, per_block: int, width: int) -> DataFrame:
    """Blocks of rows by descending length: ids, integers of all vectors (32 bits where they fit), greatest length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, longest = np.zeros(0, np.int64), np.zeros((0, width), np.int64), []
        for batch in batches:
            ids = np.concatenate([ids, np.asarray(batch.column(0).fill_null(_NO_ID))])
            vectors = np.concatenate([vectors, _matrix(batch.column(1), width)])
            longest += batch.column(2).to_pylist()
            while len(ids) >= per_block:
                yield block(ids[:per_block], vectors[:per_block], longest[0])
                ids, vectors, longest = ids[per_block:], vectors[per_block:], longest[per_block:]
        if len(ids):
            yield block(ids, vectors, longest[0])

    def block(ids: np.ndarray, vectors: np.ndarray, longest: float) -> pa.RecordBatch:
        narrow = vectors.astype(np.int32)
        vectors = narrow if (narrow == vectors).all() else vectors
        return pa.RecordBatch.from_arrays(
            [pa.array([ids.tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary()),
             pa.array([longest], pa.float64())], names=["ids", "vectors", "longest"],
        )

    order = [F.desc("length"), F.col("id")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("id", "v", "length").mapInArrow(cut, "ids binary, vectors binary, longest double")


def _load(ids: pa.Scalar, vectors: pa.Scalar, width: int, turn: np.ndarray) -> Block:
    numbers, raw = np.frombuffer(ids.as_py(), np.int64), vectors.as_py()
    kind = np.int64 if len(raw) == 8 * len(numbers) * width else np.int32
    return Block(numbers, np.frombuffer(raw, kind).reshape(len(numbers), width).astype(np.int64), turn)


def top_inner_products(vectors: DataFrame, k: int, is_query: Column, vec_id: str = "vec_id",
                       vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    ship_code(spark)
    rows = cut_lineage(
        vectors.select(F.col(vec_id).cast("long").alias("id"), integers(F.col(vector)).alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"))
        .where("v is not null").withColumn("length", F.sqrt(squared_length(F.col("v"))))
    )
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    turn = rotation(rows, width)
    asked = rows.where("asks and id is not null").groupBy("id").agg(F.min("v").alias("v"))
    asked = asked.withColumn("length", F.sqrt(squared_length(F.col("v"))))
    # A bounded number of rows, whatever the size of the table.
    longest = rows.orderBy(F.desc("length"), "id").limit(LONGEST).select("id", "v")
    first = longest.toArrow()
    seed_ids = np.asarray(first.column("id").fill_null(_NO_ID))
    seeds = spark.sparkContext.broadcast((seed_ids, _matrix(first.column("v"), width), turn))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's k-th best score among the longest vectors."""
        ids_, vectors_, turn_ = seeds.value
        held = Block(ids_, vectors_, turn_)
        for batch in batches:
            floors, least = [], []
            for ids, members in zip(batch.column("ids"), batch.column("vectors"), strict=True):
                queries = _load(ids, members, width, turn_)
                floor = np.full(len(queries.ids), -np.inf)
                for i, _, scores in search(queries, floor, held, k):
                    if len(scores) == k:
                        floor[i] = scores.min()
                floors.append(floor.tolist())
                # What the weakest query of the block asks of a candidate's length.
                asks = np.where(queries.length > 0, floor / np.maximum(queries.length, 1e-300), -np.inf)
                least.append(float(asks.min()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids"), batch.column("vectors"), pa.array(floors, pa.list_(pa.float64())),
                 pa.array(least, pa.float64())], names=["ids", "vectors", "floors", "least"],
            )

    query_blocks = cut_lineage(
        _packed(asked, QUERIES_PER_BLOCK, width)
        .mapInArrow(start, "ids binary, vectors binary, floors array<double>, least double")
        .withColumn("query_block", F.monotonically_increasing_id())
    )
    candidate_blocks = cut_lineage(
        _packed(rows, CANDIDATES_PER_BLOCK, width)
        .withColumn("candidate_block", F.monotonically_increasing_id())
    )
    # Pairs of block numbers only; the blocks themselves are joined to the pairs that can matter.
    pairs = query_blocks.select("query_block", "least").join(
        candidate_blocks.select("candidate_block", "longest"),
        F.col("longest") * (1 + SLACK) + SLACK >= F.col("least"),
    ).select("query_block", "candidate_block")
    tasks = pairs.join(query_blocks, "query_block").join(
        candidate_blocks.select("candidate_block", F.col("ids").alias("held_ids"), F.col("vectors").alias("held")),
        "candidate_block",
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_ = seeds.value[2]
        for batch in batches:
            for j in range(batch.num_rows):
                at = {name: batch.column(name)[j] for name in ("ids", "vectors", "floors", "held_ids", "held")}
                queries = _load(at["ids"], at["vectors"], width, turn_)
                held = _load(at["held_ids"], at["held"], width, turn_)
                found = list(search(queries, np.array(at["floors"].as_py()), held, k))
                asks = [np.full(len(ids), queries.ids[i]) for i, ids, _ in found]
                ids = np.concatenate([ids for _, ids, _ in found]) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(asks) if found else np.zeros(0, np.int64)),
                     pa.array(ids, mask=ids == _NO_ID),
                     pa.array(np.concatenate([s for _, _, s in found]) if found else np.zeros(0, np.int64))],
                    names=["query_id", "vec_id", "score"],
                )

    hits = tasks.select("ids", "vectors", "floors", "held_ids", "held").mapInArrow(meet, _HITS)
    # Spark limits each task's rows to k per query before they are shuffled.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").isNull(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
