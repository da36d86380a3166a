"""Exact n-gram Jaccard join by adaptive multi-match prefixes.

Sets are ordered by one order of all shingles, rare ones first. Of two sets that
link, each holds at least ``t = ceil(percent * n / 100)`` common shingles of its
``n``. So the first ``n - t + l`` of both share at least ``l``, for any ``l``: a
longer prefix asks for more matches. Two documents with ``l`` and ``l'`` share
the lesser number, as the longer prefix contains the shorter one.

Single rare shingles are shared by chance in a large corpus, so matches are
sought two by two: a *step* is a shingle of the prefix and the next one. The
shingles that only one of two linked sets holds number ``x = (100 - percent) * n
/ percent`` at most, and each of them parts two common shingles at most once. So
a prefix for ``l = 1 + x + m`` matches gives steps of which ``m`` are in common.
Each document takes the ``m`` that its estimated cost asks for, and two are
compared only if their prefixes share ``min(m, m')`` steps. Nothing is lost.

1. ``shingle_counts``: how many documents hold a shingle, over all documents, in
   a table of ``COUNTERS`` counters by hash, on a logarithmic scale: 4 MB at any
   size. Counters that shingles share are too high, which changes the order and
   the estimates, never a result.
2. ``prefixes_of``: every document's set, in the order of the counters. For each
   ``m`` the prefix costs a row for each of its steps, a look at each entry of
   their lists, and a comparison for each document that these entries can hold
   ``m`` times (entries / m at most). The cheapest ``m`` is taken.
3. Equal sets are one node. Each step that two prefixes hold has a pivot, its
   least node; a node joins the group of each of its pivots. Two nodes that share
   a step share its pivot, so lists are never expanded into pairs.
4. ``candidate_groups``: an index over the prefixes of a group counts the matches
   of a node with all others at once. Nodes hang together that have the matches
   they need and could have a size in the right proportion; all others leave.
   Groups beyond one block only lose the nodes that have too few steps in
   common with anybody.
5. Full sets are compared, in blocks of bounded size, and links are confirmed on
   the words (``near_dedup.links_of``). Components give each node its class.

Defined cases. Null or empty text, or white space alone: no shingles, linked
with nothing. Fewer words than the width: the whole sequence is the one shingle.
Null id: the component of texts with the same set; without any such row that has
an id, a null component. Rows that share an id are one document: each of its
texts takes part. Repeated rows get the same result. Empty tables give empty
results. A text is held whole in one task; nothing else is kept per task but the
counters and one block. Only the id and the text are read, so further columns
may have any name. ``percent`` has to be 70 or more: below, a set may have too
few shingles for a prefix with a common step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import join_groups, small_batches, text_of
from clickloom.llm.near_dedup import Index, links_of
from clickloom.llm.shingles import mix, set_digest, shingle_set
from clickloom.operators.graph import connected_components
from clickloom.session import cut_lineage

COUNTERS = 1 << 22
_SLICES = 64
# A counter c is kept as 4 log2(1 + c), which fits a byte.
_STEPS = 4
MOST_MATCHES = 8
# What a row of a step, an entry of a list and a shingle of a comparison cost.
ROW_COST, ENTRY_COST, SHINGLE_COST = 8.0, 1.0, 1.0
# Steps that one task may hold at a time, and shingles of full sets in a block.
BLOCK_PREFIXES = 200_000
BLOCK_SHINGLES = 100_000

_SETS = "doc_id long, n_shingles long, digest binary, matches int, prefix array<long>"


def counter_of(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) >> np.uint64(42)).astype(np.int64)


def shingle_counts(docs: DataFrame, width: int, text: str = "text") -> tuple[np.ndarray, float]:
    """(counters on the logarithmic scale, mean of the counters) over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            found = [counter_of(shingle_set(whole, width)) for whole in batch.column(0).to_pylist()]
            if found:
                total += np.bincount(np.concatenate(found), minlength=COUNTERS).astype(np.uint32)
        for i, part in enumerate(np.split(total, _SLICES)):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([zlib.compress(part.astype("<u4").tobytes(), 1)], pa.binary())],
                    names=["slice", "counts"],
                )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS // _SLICES, np.uint64)
        for batch in batches:
            for packed in batch.column("counts"):
                total += np.frombuffer(zlib.decompress(packed.as_py()), "<u4")
        level = np.rint(_STEPS * np.log2(1.0 + total)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([level.tobytes()], pa.binary()),
             pa.array([float(total.sum())])], names=["slice", "levels", "total"],
        )

    add.__annotations__ = {"key": tuple, "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    small_batches(docs.sparkSession)
    parts = docs.select(text_of(text).alias("text")).mapInArrow(count, "slice int, counts binary")
    levels, total = np.zeros((_SLICES, COUNTERS // _SLICES), np.uint8), 0.0
    for at, packed, n in parts.groupBy("slice").applyInArrow(add, "slice int, levels binary, total double").collect():
        levels[at] = np.frombuffer(bytes(packed), np.uint8)
        total += n
    return levels.ravel(), total / COUNTERS


def least_shared(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with any set it links with, at least."""
    return -(-percent * n // 100)


def most_apart(n: int, percent: int) -> int:
    """Shingles that only one of two sets holds, at most, where the sets link and one has ``n``."""
    return (100 - percent) * n // percent


def prefix_of(shingles: np.ndarray, levels: np.ndarray, mean: float, percent: int,
              most: int = MOST_MATCHES) -> tuple[int, np.ndarray]:
    """(common steps to ask for, steps of the prefix) of a sorted set."""
    n = len(shingles)
    if 100 * n < percent * (n + 1):
        # One shingle more on the other side already breaks the threshold: it links with equals only.
        return 1, np.zeros(0, np.int64)
    level = levels[counter_of(shingles)]
    first = n - least_shared(n, percent) + most_apart(n, percent)
    most = min(most, n - 1 - first)
    # One order for all sets: by counter, then by hash.
    chosen = np.lexsort((shingles, level))[: first + most + 1]
    level, ordered = level[chosen], shingles[chosen]
    # A step is in no more documents than either of its shingles.
    others = np.maximum(np.exp2(np.minimum(level[1:], level[:-1]) / _STEPS) - 2.0 - mean, 0.0)
    entries = np.cumsum(others)[first:]
    asked = np.arange(1, most + 1)
    cost = ROW_COST * (first + asked) + ENTRY_COST * entries + SHINGLE_COST * n * entries / asked
    best = int(np.argmin(cost)) + 1
    with np.errstate(over="ignore"):
        steps = mix(mix(ordered[:-1]) + ordered[1:])[: first + best].view(np.int64)
    return best, np.sort(steps)


def prefixes_of(docs: DataFrame, width: int, percent: int, levels: Broadcast, mean: float, doc_id: str = "doc_id",
                text: str = "text", most: int = MOST_MATCHES) -> DataFrame:
    """(doc_id, n_shingles, digest, matches, prefix) of every row, stored."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, matches, prefixes = [], [], [], []
            for whole in batch.column(1).to_pylist():
                found = shingle_set(whole, width)
                asked, prefix = prefix_of(found, levels.value, mean, percent, most)
                sizes.append(len(found))
                digests.append(set_digest(found) if len(found) else None)
                matches.append(asked)
                prefixes.append(prefix)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(matches, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "matches", "prefix"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return cut_lineage(rows.mapInArrow(build, _SETS))


def nodes_of(sets: DataFrame) -> DataFrame:
    """One stored row per distinct set."""
    return cut_lineage(sets.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles"), F.count("*").alias("n_rows"),
        F.max("matches").alias("matches"), F.any_value("prefix").alias("prefix"),
    ))


def candidates(least: np.ndarray, most: np.ndarray, matches: np.ndarray, prefixes: list[np.ndarray],
               percent: int) -> list[list[int]]:
    """Places that hang together by enough matches and sizes in proportion, in lists of two or more.

    ``least`` and ``most`` are the sizes of the sets of each place.
    """
    index = Index(prefixes)
    waiting = np.ones(len(prefixes), bool)
    found = []
    for start in range(len(prefixes)):
        if not waiting[start]:
            continue
        waiting[start] = False
        part = [start]
        for i in part:
            if not waiting.any():
                break
            near = waiting & (index.shared(prefixes[i]) >= np.minimum(matches, matches[i]))
            near &= (100 * most >= percent * least[i]) & (100 * most[i] >= percent * least)
            waiting &= ~near
            part += np.flatnonzero(near).tolist()
        if len(part) > 1:
            found.append(part)
    return found


def candidate_groups(nodes: DataFrame, percent: int, block_prefixes: int = BLOCK_PREFIXES) -> DataFrame:
    """(pivot, node, n_shingles): nodes with as many matches as they ask for share a pivot; stored."""
    named = nodes.where("node is not null")
    postings = named.select("node", F.explode("prefix").alias("step"))
    # Stored, so that both sides of the join are plain exchanges: a hot step is then split.
    pivots = cut_lineage(
        postings.groupBy("step").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
        .where("pivot <> last").select("step", "pivot")
    )
    held = cut_lineage(postings.join(pivots, "step"))
    # Steps that nobody else's prefix holds match nothing.
    shared = held.groupBy("node").agg(F.sort_array(F.collect_list("step")).alias("shared"))
    # Several sets can carry one id; each of them takes part under it.
    asks = named.groupBy("node").agg(
        F.min("matches").alias("matches"), F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"),
    )
    known = cut_lineage(shared.join(asks, "node").withColumn("n_shared", F.size("shared")))
    members = cut_lineage(held.select("pivot", "node").distinct().join(
        known.select("node", "matches", "most", "n_shared"), "node"
    ))
    sizes = cut_lineage(members.groupBy("pivot").agg(
        F.min("matches").alias("asked"), F.sum("n_shared").alias("total"), F.count("*").alias("members")
    ))
    # A pair asks for the lesser number of both, so nobody needs fewer matches than the least of the group.
    able = cut_lineage(
        join_groups(members, sizes, "pivot", "members").where("n_shared >= asked")
        .select("pivot", "node", "total", F.col("most").alias("n_shingles"))
    )
    large = able.where(F.col("total") > block_prefixes).select("pivot", "node", "n_shingles")
    small = able.where(F.col("total") <= block_prefixes).select("pivot", "node")
    rows = small.join(known, "node").select("pivot", "node", "matches", "least", "most", "shared")
    dealt = rows.repartition("pivot").sortWithinPartitions("pivot")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if len(group) < 2:
                return
            ids, matches, least, most = (np.array(c, np.int64) for c in list(zip(*group, strict=True))[:4])
            for part in candidates(least, most, matches, [g[4] for g in group], percent):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), ids[part].min())), pa.array(ids[part]), pa.array(most[part])],
                    names=["pivot", "node", "n_shingles"],
                )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            lists = batch.column(5)
            for i, (pivot, *rest) in enumerate(zip(*columns, strict=True)):
                if pivot != at:
                    yield from close()
                    at, group = pivot, []
                group.append((*rest, np.asarray(lists[i].values)))
        yield from close()

    found = dealt.mapInArrow(walk, "pivot long, node long, n_shingles long")
    return cut_lineage(found.unionByName(large).groupBy("pivot", "node").agg(F.max("n_shingles").alias("n_shingles")))


def jaccard_links(docs: DataFrame, nodes: DataFrame, width: int, percent: int, doc_id: str = "doc_id",
                  text: str = "text", block_prefixes: int = BLOCK_PREFIXES,
                  block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(src, dst) links between nodes whose components are those of all links."""
    groups = candidate_groups(nodes, percent, block_prefixes)
    return links_of(groups, docs, width, percent, doc_id, text, block_shingles)


def jaccard_join(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
                 most_matches: int = MOST_MATCHES, block_prefixes: int = BLOCK_PREFIXES,
                 block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    if not 70 <= percent <= 100:
        raise ValueError("percent has to be between 70 and 100")
    levels, mean = shingle_counts(docs, width, text)
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    sets = prefixes_of(docs, width, percent, shared, mean, doc_id, text, most_matches)
    nodes = nodes_of(sets)
    links = jaccard_links(docs, nodes, width, percent, doc_id, text, block_prefixes, block_shingles)
    classes = cut_lineage(nodes.join(connected_components(links), "node", "left").select(
        "digest", "n_rows", F.coalesce("component", "node").alias("component_id")
    ))
    some = join_groups(sets.where("n_shingles > 0"), classes, "digest", "n_rows").select(
        "doc_id", "n_shingles", "component_id"
    )
    none = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.unionByName(none)
