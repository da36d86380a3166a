"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

1. Turns are numbered. Rows are range-partitioned by conversation and turn; the
   counts of the ranges in front of a row and its place in its own range give
   its number, so a conversation of any length is spread over tasks. Only a
   digest and the length of each text travel.
2. Conversations are rebuilt: some conversations open with the first turns of a
   shared one. A rebuilt turn is a row (conversation, depth, digest).
3. Each prefix gets a digest: a chain of SHA-256 over at most ``CHUNK`` turns,
   a chunk's start hanging on the digest of all chunks in front of it, which is
   found the same way over rows of whole chunks. Equal prefixes, and no others,
   have equal digests.
4. Prefixes with equal digests are one node, named by its smallest member and
   its depth. The node's parent is the node of that member one turn earlier.
5. ``tree_contraction.subtree_sums`` gives leaves and saved tokens of subtrees.
6. The members that end at a node are listed in parts of bounded size; a hash
   runs over the parts in order.

Defined cases. Rows without a conversation id take no part. A null turn comes
first; turns with the same number come in the order of their digests, so rows
that repeat are two turns. Null role and text count as empty, also an empty
text makes a turn. A conversation whose own turns all fall away and that has no
shared ones is a member of the root alone. Long texts are hashed where they
lie. An empty table gives no node, not even a root. Only the four columns named
are read, so further ones may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import numbered, ship_code
from clickloom.llm.tree_contraction import subtree_sums
from clickloom.operators.rendering import text_parts
from clickloom.session import cut_lineage

CHUNK = 1_024
ROOT = b""


def numbered_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """(conv_id, pos, digest, chars) of every turn, pos from 1; stored."""
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    # The length of the role keeps role and text apart.
    digest = F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256))
    turns = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"),
        F.length(said).cast("long").alias("chars"),
    )
    placed = numbered(turns, ["conv_id"], [F.asc_nulls_first("turn"), F.asc("digest")], "pos")
    return cut_lineage(placed.select("conv_id", "pos", "digest", "chars"))


def rebuild(turns: DataFrame, shared: Column, base: Column, most_shared: int) -> tuple[DataFrame, DataFrame]:
    """(rebuilt turns, (conv_id, length) of every conversation), both stored.

    ``shared`` and ``base`` are expressions of ``conv_id``: the conversation
    opens with the first ``shared`` (at most ``most_shared``) turns of ``base``
    and goes on with its own turns after that many.
    """
    sizes = cut_lineage(turns.groupBy("conv_id").agg(F.count("*").alias("own")).select(
        "conv_id", "own", shared.cast("long").alias("shared"), base.alias("base")
    ))
    opening = sizes.alias("c").join(sizes.alias("b"), F.col("c.base") == F.col("b.conv_id"), "left").select(
        "c.conv_id", "c.base", "c.shared", "c.own",
        F.least("c.shared", F.coalesce("b.own", F.lit(0))).alias("taken"),
    )
    convs = cut_lineage(opening.withColumn(
        "length", F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    ))
    starts = turns.where(F.col("pos") <= most_shared).withColumnRenamed("conv_id", "base")
    first = convs.select("conv_id", "base", "taken").join(starts, "base").where("pos <= taken").select(
        "conv_id", F.col("pos").alias("depth"), "digest", "chars"
    )
    own = turns.join(convs.select("conv_id", "shared", "taken"), "conv_id").where("pos > shared").select(
        "conv_id", (F.col("pos") - F.col("shared") + F.col("taken")).alias("depth"), "digest", "chars"
    )
    return cut_lineage(first.unionByName(own)), convs.select("conv_id", "length")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each turn's digest by that of its chunk up to there."""
    at, state = None, b""
    for batch in batches:
        out = []
        columns = [batch.column(i).to_pylist() for i in (0, 1, 3)]
        for conv, chunk, digest in zip(*columns, strict=True):
            if (conv, chunk) != at:
                at, state = (conv, chunk), b""
            state = hashlib.sha256(state + digest).digest()
            out.append(state)
        kept = [batch.column(i) for i in (0, 1, 2)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.binary()), batch.column(4)],
                                         names=["conv_id", "chunk", "depth", "prefix", "chars"])


def prefix_digests(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, depth, prefix, chars): the digest of the first ``depth`` turns; stored."""
    ship_code(turns.sparkSession)
    number = F.floor((F.col("depth") - 1) / chunk)
    dealt = turns.withColumn("chunk", number).repartition("conv_id", "chunk").sortWithinPartitions(
        "conv_id", "chunk", "depth"
    )
    chained = cut_lineage(dealt.select("conv_id", "chunk", "depth", "digest", "chars").mapInArrow(
        _chain, "conv_id long, chunk long, depth long, prefix binary, chars long"
    ))
    if chained.where("chunk > 0").isEmpty():
        return chained.drop("chunk")
    ends = chained.where(F.col("depth") % chunk == 0).select(
        "conv_id", (F.col("chunk") + 1).alias("depth"), F.col("prefix").alias("digest"), "chars"
    )
    fronts = prefix_digests(ends, chunk).select("conv_id", F.col("depth").alias("chunk"), F.col("prefix").alias("front"))
    hung = F.unhex(F.sha2(F.concat("front", "prefix"), 256))
    joined = chained.join(fronts, ["conv_id", "chunk"], "left")
    return cut_lineage(joined.select("conv_id", "depth", F.coalesce(hung, "prefix").alias("prefix"), "chars"))


def nodes_of(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, prefix, parent_conv_id, n_convs, n_children, chars) of every node, the root included; stored."""
    nodes = cut_lineage(
        prefixes.groupBy("prefix", "depth").agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars")
        ).unionByName(
            convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
                F.lit(ROOT).alias("prefix"), F.lit(0).cast("long").alias("depth"), "n_convs", "conv_id",
                F.lit(0).cast("long").alias("chars"),
            )
        )
    )
    # The prefix one turn earlier, of the member that names the node.
    earlier = prefixes.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    above = cut_lineage(nodes.join(earlier, ["conv_id", "depth"], "left").withColumn(
        "parent", F.when(F.col("depth") == 1, F.lit(ROOT)).otherwise(F.col("parent"))
    ))
    children = above.where("parent is not null").groupBy(F.col("parent").alias("prefix")).agg(
        F.count("*").alias("n_children")
    )
    # The parents' table is stored and has one row per prefix; a parent of very many children is a skewed key that
    # adaptive execution splits.
    names = nodes.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return cut_lineage(
        above.join(names, "parent", "left").join(children, "prefix", "left").select(
            "conv_id", "depth", "prefix", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"), "chars",
        )
    )


def _hash_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its parts, which come one after the other."""
    at, state = None, None

    def close() -> Iterator[pa.RecordBatch]:
        if at is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.binary()), pa.array([state.hexdigest()])], names=["prefix", "ends_sha256"]
            )

    for batch in batches:
        for prefix, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if prefix != at:
                yield from close()
                at, state = prefix, hashlib.sha256()
            else:
                state.update(b",")
            state.update(line.encode())
    yield from close()


def end_hashes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of the nodes at which some member ends."""
    here = convs.withColumnRenamed("length", "depth")
    ends = cut_lineage(
        prefixes.join(here, ["conv_id", "depth"]).select("prefix", "conv_id").unionByName(
            convs.where("length = 0").select(F.lit(ROOT).alias("prefix"), "conv_id")
        )
    )
    parts = text_parts(ends, ["prefix"], F.col("conv_id"), ",")
    dealt = parts.select("prefix", "part", "line").repartition("prefix").sortWithinPartitions("prefix", "part")
    return dealt.mapInArrow(_hash_parts, "prefix binary, ends_sha256 string")


def trie(rows: DataFrame, shared: Column, base: Column, most_shared: int, conv_id: str = "conv_id",
         turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations; see ``rebuild`` for ``shared`` and ``base``."""
    turns = numbered_turns(rows, conv_id, turn, role, text)
    rebuilt, convs = rebuild(turns, shared, base, most_shared)
    prefixes = prefix_digests(rebuilt, chunk)
    nodes = nodes_of(prefixes, convs)
    sums = subtree_sums(
        nodes.select(
            F.struct("conv_id", "depth").alias("id"),
            F.when(F.col("depth") > 0, F.struct(
                F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
            )).alias("parent"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    totals = sums.select("id.conv_id", "id.depth", "n_leaves", "saved_tokens")
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(totals, ["conv_id", "depth"]).join(end_hashes(prefixes, convs), "prefix", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
