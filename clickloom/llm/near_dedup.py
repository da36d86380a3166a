"""Near-duplicate groups: circulant MinHash bands, then exact Jaccard on full sets.

1. Every text becomes its shingle set, a digest of the set and the band keys of
   its signature (``shingles``). Texts with the same set are one node, named by
   the smallest id. Sets so small that one different element already breaks the
   threshold can only link with equals; they need no bands.
2. In each bucket (equal band key) the smallest node is the pivot. A node joins
   the group of each of its pivots, once per pivot, however many buckets they
   share. Two nodes of a bucket share its pivot, so each candidate pair meets in
   a group; buckets are never expanded into pairs.
3. A group is cut into blocks of bounded size, each with the pivot in it. A
   task holds one block at a time: an inverted index counts the intersections of a set
   with all others at once, and only links that join two parts of the block
   leave it (fewer than its members). Links are found on full sets of hashes and
   confirmed on the words of the two texts.
4. In a group of several blocks, nodes that are not linked to its pivot by then
   (loose nodes) may link with nodes of other blocks. Sets that reach the
   threshold share one of the first elements of both under any common order
   (prefix filter). The order of a group puts what its pivot holds last, so
   text that the whole group shares does not bring its members together. Two
   blocks meet in a task of their own, with those of their nodes only that share
   such an element with a node of the other block, one of the two being loose.
   Nodes that are linked to the pivot need not meet each other: they are in its
   component whatever else they link with.
5. Components of the links give each node its class.

Only the banding can miss a link: a pair at the threshold shares no bucket with
a probability below 1e-6.

Defined cases. Null or empty text, or white space alone: no shingles, linked
with nothing. Null id: it takes part in no group of its own but gets the
component of texts with the same set; a set of which no row has an id has a null
component and its rows are kept. Rows that share an id are one document.
Repeated rows get the same verdict. Empty tables give empty results. Only the
id and the text are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import free_name, join_groups, small_batches, text_of
from clickloom.llm.shingles import band_keys, linked, set_digest, shingle_set, signature
from clickloom.operators.bloom import might_be_member
from clickloom.operators.graph import connected_components
from clickloom.session import cut_lineage

# Shingles that one block may hold: 8 MB of hashes.
BLOCK_SHINGLES = 1_000_000

_SETS = "doc_id long, n_shingles long, digest binary, bands array<long>"
_LINKS = "src long, dst long"


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): as many bands as it takes to miss a pair at the threshold less than once in a million."""
    share = percent / 100
    rows = 5 if percent >= 85 else 4
    bands = int(np.ceil(np.log(1e-6) / np.log(1 - share**rows)))
    return bands, rows


def _can_differ(n: int, percent: int) -> bool:
    """Whether a set of n elements can link with a different one: with one more element at best."""
    return 100 * n >= percent * (n + 1)


def sets_of(docs: DataFrame, width: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, bands) of every row, stored."""
    bands, rows = bands_for(percent)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for whole in batch.column(1).to_pylist():
                found = shingle_set(whole, width)
                sizes.append(len(found))
                digests.append(set_digest(found) if len(found) else None)
                keys.append(band_keys(signature(found, bands * rows), rows) if _can_differ(len(found), percent) and
                            len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "bands"],
            )

    small_batches(docs.sparkSession)
    rows_ = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return cut_lineage(rows_.mapInArrow(build, _SETS))


def nodes_of(sets: DataFrame) -> DataFrame:
    """One stored row per distinct set: its node, size, number of rows and bands."""
    return cut_lineage(sets.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles"), F.count("*").alias("n_rows"),
        F.any_value("bands").alias("bands"),
    ))


def groups_of(nodes: DataFrame) -> DataFrame:
    """(pivot, node, n_shingles): each node once per pivot, the pivot with itself; stored."""
    keyed = nodes.where("node is not null").select("node", "n_shingles", F.explode("bands").alias("key"))
    # Stored, so that both sides of the join are plain exchanges: a hot bucket is then split.
    buckets = cut_lineage(
        keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
        .where("pivot <> last").select("key", "pivot")
    )
    return cut_lineage(keyed.join(buckets, "key").select("pivot", "node", "n_shingles").distinct())


def _blocks(groups: DataFrame, block_shingles: int) -> DataFrame:
    """Add the number of blocks of the group and the block of the node; stored."""
    sizes = cut_lineage(groups.groupBy("pivot").agg(F.sum("n_shingles").alias("words"), F.count("*").alias("members")))
    # Most groups fit one block; the sizes of the others are few, and every row of a group needs its own.
    parts = F.greatest(F.lit(1), F.ceil(F.col("words") / block_shingles)).cast("int")
    joined = join_groups(groups, sizes.withColumn("blocks", parts), "pivot", "members")
    return cut_lineage(joined.select(
        "pivot", "node", "blocks", F.pmod(F.xxhash64("node", "pivot"), F.col("blocks")).cast("int").alias("block")
    ))


class Index:
    """Postings of a list of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(elements, kind="stable")
        elements, self.owners = elements[order], owners[order]
        first = np.flatnonzero(np.concatenate([[True], elements[1:] != elements[:-1]])) if len(elements) else []
        self.vocabulary = elements[first] if len(elements) else elements
        self.starts = np.append(first, len(elements)).astype(np.int64)

    def shared(self, one: np.ndarray) -> np.ndarray:
        """Size of the intersection of one set with each of the list."""
        out = np.zeros(len(self.sizes), np.int64)
        if not len(self.vocabulary) or not len(one):
            return out
        at = np.searchsorted(self.vocabulary, one)
        at = at[at < len(self.vocabulary)]
        at = at[self.vocabulary[at] == one[: len(at)]]
        lengths = self.starts[at + 1] - self.starts[at]
        total = int(lengths.sum())
        if not total:
            return out
        ends = np.cumsum(lengths)
        places = np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(self.starts[at], lengths)
        return np.bincount(self.owners[places], minlength=len(out))


class Parts:
    """Union-find over the places of a block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _links(one: np.ndarray, index: Index, percent: int) -> np.ndarray:
    """Places of the sets that link with ``one``."""
    shared = index.shared(one)
    return np.flatnonzero((shared > 0) & (100 * shared >= percent * (index.sizes + len(one) - shared)))


def link_block(nodes: list[int], sets: list[np.ndarray], guests: list[bool], percent: int,
               confirm: Callable[[int, int], bool] = lambda i, j: True) -> list[tuple[int, int]]:
    """Links that join the parts of one block.

    Without guests every pair is looked at, but for those that hang together
    already. With guests only pairs of a guest and another node are. ``confirm``
    has the last word on a link of two places.
    """
    parts = Parts(len(nodes))
    index = Index(sets)
    found: list[tuple[int, int]] = []
    askers = [i for i, guest in enumerate(guests) if guest] or range(len(nodes))
    for i in askers:
        root = parts.find(i)
        if len(found) >= len(nodes) - 1:
            break
        # The first set's component is settled by the first question.
        if not any(guests) and i and root == parts.find(0):
            continue
        for j in _links(sets[i], index, percent).tolist():
            if parts.find(i) != parts.find(j) and confirm(i, j):
                parts.join(i, j)
                found.append((nodes[i], nodes[j]))
    return found


def first_elements(one: np.ndarray, last: np.ndarray, percent: int) -> np.ndarray:
    """The elements of a set of which any set that links with it holds one, among its own first ones too.

    ``last`` holds the elements that come last in the order of the group, which is otherwise that of the hashes.
    """
    least = -(-percent * len(one) // 100)
    held = np.isin(one, last, assume_unique=True)
    return np.concatenate([one[~held], one[held]])[: len(one) - least + 1]


def _texts(members: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, text) of the ids of ``members`` and few others, so that a join does not shuffle the whole corpus."""
    texts = docs.select(F.col(doc_id).cast("long").alias("node"), text_of(text).alias("text"))
    return might_be_member(texts, cut_lineage(members.select("node").distinct()), ["node"])


def _dealt(members: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(pivot, block, other, node, guest, text) of ``members``, each (pivot, block, other) in one run, its pivot first."""
    # Rows of one id are one document: each of its texts takes part. The texts are the large side and
    # members grow with them, so both are always shuffled; the plan is the same at every size.
    texts = _texts(members, docs, doc_id, text)
    key = ["pivot", "block", "other"]
    rows = members.join(texts.hint("merge"), "node").select(*key, "node", "guest", "text")
    return rows.repartition(*key).sortWithinPartitions(*key, F.col("node") != F.col("pivot"))


def _first_elements(members: DataFrame, docs: DataFrame, width: int, percent: int, doc_id: str,
                    text: str) -> DataFrame:
    """(pivot, block, node, guest, element) of the first elements of ``members``, each block with its pivot."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last = None, np.zeros(0, np.uint64)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 5)]
            chosen, places = [], []
            for i, (pivot, block, node, whole) in enumerate(zip(*columns, strict=True)):
                if (pivot, block) != at:
                    at, last = (pivot, block), np.zeros(0, np.uint64)
                found = shingle_set(whole, width)
                if node == pivot:
                    last = np.union1d(last, found)
                elif len(found):
                    chosen.append(first_elements(found, last, percent))
                    places.append(i)
            if chosen:
                rows = pa.array(np.repeat(places, [len(c) for c in chosen]))
                kept = [batch.column(i).take(rows) for i in (0, 1, 3, 4)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(chosen).view(np.int64))],
                                                 names=["pivot", "block", "node", "guest", "element"])

    schema = "pivot long, block int, node long, guest boolean, element long"
    return _dealt(members, docs, doc_id, text).mapInArrow(walk, schema)


def _meetings(firsts: DataFrame) -> DataFrame:
    """(pivot, block, other, node, guest): for each two blocks of a group, their nodes that must meet; stored.

    The rows of an element are its nodes times its blocks at most, never pairs of nodes.
    """
    firsts = cut_lineage(firsts.distinct())
    # Stored, so that the join splits an element that very many nodes hold.
    shared = cut_lineage(firsts.groupBy("pivot", "element").agg(
        F.min("block").alias("least"), F.max("block").alias("most"), F.max("guest").alias("any")
    ).where("least <> most and any").select("pivot", "element"))
    firsts = cut_lineage(firsts.join(shared, ["pivot", "element"], "left_semi"))
    blocks = cut_lineage(firsts.groupBy("pivot", "element", F.col("block").alias("there")).agg(
        F.max("guest").alias("asks")
    ))
    met = firsts.join(blocks, ["pivot", "element"]).where("block <> there and (guest or asks)")
    return cut_lineage(met.select(
        "pivot", F.least("block", "there").alias("block"), F.greatest("block", "there").alias("other"), "node", "guest"
    ).distinct())


def _verify(members: DataFrame, docs: DataFrame, width: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """Links inside each (pivot, block, other) of ``members`` (with node and guest); texts are joined by id."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        nodes: list[int] = []
        sets: list[np.ndarray] = []
        guests: list[bool] = []
        texts: list[str] = []

        def confirm(i: int, j: int) -> bool:
            return linked(texts[i], texts[j], width, percent)

        def close() -> Iterator[pa.RecordBatch]:
            links = link_block(nodes, sets, guests, percent, confirm)
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())],
                    names=["src", "dst"],
                )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for pivot, block, other, node, guest, whole in zip(*columns, strict=True):
                if (pivot, block, other) != at:
                    yield from close()
                    at, nodes, sets, guests, texts = (pivot, block, other), [], [], [], []
                nodes.append(node)
                texts.append(whole)
                sets.append(shingle_set(whole, width))
                guests.append(guest)
        yield from close()

    return _dealt(members, docs, doc_id, text).mapInArrow(walk, _LINKS)


def links_of(groups: DataFrame, docs: DataFrame, width: int, percent: int, doc_id: str = "doc_id", text: str = "text",
             block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(src, dst) links whose components are those of all links; stored."""
    blocks = _blocks(groups, block_shingles)
    single = blocks.where("blocks = 1 or node <> pivot").select("pivot", "block", "node")
    # The pivot of a large group is in each of its blocks.
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pivots = blocks.where("blocks > 1 and node = pivot").select("pivot", every.alias("block"), "node")
    members = single.unionByName(pivots).select("pivot", "block", F.col("block").alias("other"), "node")
    links = cut_lineage(_verify(members.withColumn("guest", F.lit(False)), docs, width, percent, doc_id, text))

    large = blocks.where("blocks > 1")
    if large.limit(1).count():
        known = cut_lineage(connected_components(links))
        part = known.select(F.col("node"), F.col("component").alias("part"))
        heads = known.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_part"))
        # A node without a link is alone.
        judged = cut_lineage(large.join(part, "node", "left").join(heads, "pivot", "left").withColumn(
            "guest", F.coalesce("part", "node") != F.coalesce("pivot_part", "pivot")
        ).select("pivot", "node", "block", "blocks", "guest"))
        asking = judged.where("guest").select("pivot").distinct()
        inner = judged.where("node <> pivot").select("pivot", "block", "node", "guest")
        heads = judged.where("node = pivot").select("pivot", every.alias("block"), "node", "guest")
        # Stored, as their ids are read first.
        second = cut_lineage(
            inner.unionByName(heads).join(asking, "pivot", "left_semi").withColumn("other", F.col("block"))
        )
        met = _meetings(_first_elements(second, docs, width, percent, doc_id, text))
        links = cut_lineage(links.unionByName(_verify(met, docs, width, percent, doc_id, text)))
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    sets = sets_of(docs, width, percent, doc_id, text)
    nodes = nodes_of(sets)
    links = links_of(groups_of(nodes), docs, width, percent, doc_id, text, block_shingles)
    components = connected_components(links)
    classes = nodes.join(components, "node", "left").select(
        "digest", "n_rows", F.coalesce("component", "node").alias("component_id")
    )
    classes = cut_lineage(classes)
    some = join_groups(sets.where("n_shingles > 0"), classes, "digest", "n_rows").select(
        "doc_id", "n_shingles", "component_id"
    )
    none = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept = F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return some.unionByName(none).withColumn("kept", kept)


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns. Documents without an id cannot be named and all stay."""
    judged, name = near_duplicates(docs, width, percent, doc_id, text), free_name("kept__", docs)
    kept = judged.where("kept and doc_id is not null").select(F.col("doc_id").alias(name)).distinct()
    named = docs.join(kept.hint("merge"), F.col(doc_id).cast("long") == F.col(name), "left_semi")
    nameless = docs.where(F.col(doc_id).isNull())
    return named.unionByName(nameless)
