"""Exact deduplication through a minimal perfect hash over historical digests.

A text's digest is the SHA-256 of the text without white space. The distinct
digests of the history are dealt into buckets, and each bucket gets a minimal
perfect hash (levels of bit arrays: a digest that is alone on its place in a
level is settled there, the others go to the next level). A slot holds the full
digest, the locator of the winner and the number of copies. A batch is reduced
to one row per digest before it meets the index; a lookup compares all 32 bytes
with its slot, so a digest that is not in the history can never pass as a
member. Digests that are not members form groups of their own.

Defined cases. Null text: the empty text. Repeated rows: each is a document; a
row number tells them apart, so exactly one of a group stays. Ties: most code
points, then the smaller id, null ids last, then the row number. Empty tables
give empty results. Only the id and the text are read, so further columns may
have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import free_name, SPACE, join_groups, ship_code, text_of
from clickloom.session import cut_lineage

# Digests per bucket of the index: a slot takes 64 bytes, so a bucket about 3 MB.
BUCKET_DIGESTS = 50_000
# Places per digest and level.
GAMMA = 2.0

_GROUP = "digest binary, group_size long, keep_points long, keep_id long, keep_row long"
_INDEX = (
    "bucket int, levels array<int>, bits binary, digests binary, sizes array<long>, points array<long>, "
    "ids array<long>, row_numbers array<long>"
)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.translate(text, SPACE, "").cast("binary"), 256))


def digest_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, digest, points) of every row, stored so that row numbers hold."""
    ship_code(docs.sparkSession)
    whole = text_of(text)
    return cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        digest(whole).alias("digest"),
        F.length(whole).cast("long").alias("points"),
    ))


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: its size and its winner, combined before the shuffle."""
    order = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    best = rows.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    return best.select(
        "digest", "group_size", (-F.col("best.p")).alias("keep_points"),
        F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"),
    )


# --- the perfect hash of one bucket -------------------------------------------------------------


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each digest (rows of four 64-bit words) in a level."""
    with np.errstate(over="ignore"):
        x = words[:, level % 4] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(level sizes, bits of all levels, slot of each digest) for distinct digests."""
    left = np.arange(len(words))
    slots = np.empty(len(words), np.int64)
    sizes: list[int] = []
    levels: list[np.ndarray] = []
    taken = 0
    while len(left):
        size = max(64, int(GAMMA * len(left)))
        places = _places(words[left], len(sizes), size)
        alone = np.bincount(places, minlength=size) == 1
        settled = alone[places]
        rank = np.cumsum(alone) - 1
        slots[left[settled]] = taken + rank[places[settled]]
        taken += int(alone.sum())
        left = left[~settled]
        sizes.append(size)
        levels.append(alone)
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    return sizes, bits, slots


def find_slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 where no level settles it. Nonmembers may get any slot."""
    slots = np.full(len(words), -1, np.int64)
    rank = np.cumsum(bits) - 1
    left, start = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        places = start + _places(words[left], level, size)
        hit = bits[places]
        slots[left[hit]] = rank[places[hit]]
        left = left[~hit]
        start += size
    return slots


def _words(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)


def _index_bucket(table: pa.Table) -> pa.Table:
    words = _words(table.column("digest"))
    sizes, bits, slots = build_hash(words)
    order = np.argsort(slots)
    held = table.take(pa.array(order))
    return pa.table({
        "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
        "levels": pa.array([sizes], pa.list_(pa.int32())),
        "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
        "digests": pa.array([words[order].tobytes()], pa.binary()),
        "sizes": pa.array([held.column("group_size").to_pylist()], pa.list_(pa.int64())),
        "points": pa.array([held.column("keep_points").to_pylist()], pa.list_(pa.int64())),
        "ids": pa.array([held.column("keep_id").to_pylist()], pa.list_(pa.int64())),
        "row_numbers": pa.array([held.column("keep_row").to_pylist()], pa.list_(pa.int64())),
    })


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The stored index over :func:`winners` of a history: one row per bucket."""
    dealt = history.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))
    return cut_lineage(dealt.groupBy("bucket").applyInArrow(_index_bucket, _INDEX))


def _better(points_a, id_a, row_a, points_b, id_b, row_b) -> bool:
    """Whether winner a goes before winner b."""
    return (-points_a, id_a is None, id_a or 0, row_a) < (-points_b, id_b is None, id_b or 0, row_b)


def _probe_bucket(index: pa.Table, batch: pa.Table) -> pa.Table:
    """Groups of one bucket: slots joined by the members found, then the nonmembers."""
    held: dict[str, list] = {"digest": [], "group_size": [], "keep_points": [], "keep_id": [], "keep_row": []}
    member = np.zeros(batch.num_rows, bool)
    if index.num_rows:
        row = {name: index.column(name)[0] for name in index.column_names}
        sizes = row["levels"].as_py()
        bits = np.unpackbits(np.frombuffer(row["bits"].as_py(), np.uint8))[: sum(sizes)].astype(bool)
        slot_words = np.frombuffer(row["digests"].as_py(), "<u8").reshape(-1, 4)
        held["digest"] = [w.tobytes() for w in slot_words]
        held["group_size"] = row["sizes"].as_py()
        held["keep_points"] = row["points"].as_py()
        held["keep_id"] = row["ids"].as_py()
        held["keep_row"] = row["row_numbers"].as_py()
        if batch.num_rows:
            words = _words(batch.column("digest"))
            slots = find_slots(words, sizes, bits)
            member = (slots >= 0) & (slot_words[slots] == words).all(axis=1)
            found = batch.filter(pa.array(member)).to_pydict()
            for i, slot in enumerate(slots[member].tolist()):
                held["group_size"][slot] += found["group_size"][i]
                new = found["keep_points"][i], found["keep_id"][i], found["keep_row"][i]
                if _better(*new, held["keep_points"][slot], held["keep_id"][slot], held["keep_row"][slot]):
                    held["keep_points"][slot], held["keep_id"][slot], held["keep_row"][slot] = new
    alone = batch.filter(pa.array(~member)).to_pydict() if batch.num_rows else {}
    for name, values in held.items():
        values.extend(alone.get(name, ()))
    kinds = {"digest": pa.binary()}
    return pa.table({name: pa.array(values, kinds.get(name, pa.int64())) for name, values in held.items()})


def probe(index: DataFrame, batch: DataFrame, buckets: int) -> DataFrame:
    """One row per digest of the index or of ``batch`` (both as :func:`winners`), stored."""
    dealt = batch.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))
    groups = index.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(_probe_bucket, _GROUP)
    return cut_lineage(groups)


def dedupe(rows: DataFrame, is_history: Column) -> DataFrame:
    """Verdict on each of :func:`digest_rows`; rows where ``is_history`` holds fill the index.

    Adds keep_id, group_size and kept. Every row gets a verdict, those of the
    history too: a later copy with more code points takes a winner's place.
    """
    n_history, n_batch = rows.agg(F.count_if(is_history), F.count_if(~is_history)).first()
    buckets = max(1, -(-max(n_history, n_batch) // BUCKET_DIGESTS))
    index = build_index(winners(rows.where(is_history)), buckets)
    groups = probe(index, winners(rows.where(~is_history)), buckets)
    judged = join_groups(rows, groups, "digest", "group_size")
    return judged.withColumn("kept", F.col("row") == F.col("keep_row"))


def first_half() -> Column:
    """The rows of a single table that play the history: about half, by a hash of id and digest."""
    return F.pmod(F.xxhash64("doc_id", "digest"), F.lit(2)) == 0


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns."""
    judged = dedupe(digest_rows(docs, doc_id, text), first_half())
    id_, hash_, points, own_id, own_hash, own_points, n = (
        free_name(x, docs) for x in ("id__", "hash__", "points__", "own_id__", "own_hash__", "own_points__", "n__")
    )
    kept = judged.where("kept").select(
        F.col("doc_id").alias(id_), F.col("digest").alias(hash_), F.col("points").alias(points)
    )
    whole = text_of(text)
    keyed = docs.select(
        "*", F.col(doc_id).cast("long").alias(own_id), digest(whole).alias(own_hash),
        F.length(whole).cast("long").alias(own_points),
    )
    # Kept rows are about as many as rows: shuffled at every size, never broadcast.
    matched = keyed.join(
        kept.hint("merge"), F.col(own_id).eqNullSafe(F.col(id_)) & (F.col(own_hash) == F.col(hash_))
        & (F.col(own_points) == F.col(points)),
    )
    # Rows alike in all three are copies of one another: the join has brought them together.
    once = Window.partitionBy(own_id, own_hash, own_points).orderBy(own_points)
    return matched.withColumn(n, F.row_number().over(once)).where(F.col(n) == 1).select(*docs.columns)
