"""Subtree sums of a forest by parallel tree contraction.

Two steps alternate until the roots alone are left, each a handful of joins
over the nodes that are still there:

- *Rake.* A leaf's sums are complete; they are added to its parent's and the
  leaf goes. Leaves are added up before they are shuffled, so a parent of any
  number of children is one row per task.
- *Compress.* A maximal chain of nodes with one child each goes at once. Every
  chain node finds the node below the chain and the sums of the chain down to
  there by pointer doubling: in join round k it knows 2^k nodes, so a chain
  takes log2(length) joins, in which each key meets one row. The node below
  then hangs on the chain's parent, which takes the chain's sums.

After a compress every inner node but the roots has two children or more, so a
rake takes at least half of the nodes: the rounds grow with the logarithm of
the nodes, not with the depth.

Removed nodes are expanded in reverse: a raked node's sums are complete; those
of a chain node are its chain sums and the sums of the node below, which was
removed later. A step's join thus reads only what later steps removed.

Defined cases. An empty table gives an empty result. Several roots (null
parents) are several trees. Null values count as 0. Ids must be unique and
parents must exist. A circle has no leaf and no end; it raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import cut_lineage


def _add(live: DataFrame, sums: DataFrame, values: list[str]) -> DataFrame:
    """``live`` with the sums at each of its nodes added; ``sums`` has one row per ``at``."""
    added = [(F.col(f"l.{v}") + F.coalesce(F.col(f"s.{v}"), F.lit(0))).alias(v) for v in values]
    return live.alias("l").join(sums.alias("s"), F.col("l.id") == F.col("s.at"), "left").select("id", "parent", *added)


def rake(live: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(leaves with their complete sums, the other nodes with the leaves' sums added), both stored."""
    parents = live.where("parent is not null").groupBy(F.col("parent").alias("at")).agg(F.lit(True).alias("inner"))
    judged = cut_lineage(
        live.join(parents, F.col("id") == F.col("at"), "left").select("id", "parent", *values, "inner")
    )
    leaf = F.col("inner").isNull() & F.col("parent").isNotNull()
    leaves = judged.where(leaf).select("id", "parent", *values)
    sums = leaves.groupBy(F.col("parent").alias("at")).agg(*[F.sum(v).alias(v) for v in values])
    return leaves.select("id", *values), cut_lineage(_add(judged.where(~leaf), sums, values))


def chains(live: DataFrame, values: list[str]) -> DataFrame:
    """(id, parent, below, values) of each chain node: the node below its chain, the sums down to there; stored."""
    only = live.where("parent is not null").groupBy(F.col("parent").alias("at")).agg(
        F.count("*").alias("n"), F.min("id").alias("below")
    ).where("n = 1").select("at", "below")
    inner = live.where("parent is not null").join(only, F.col("id") == F.col("at"))
    known = cut_lineage(inner.select("id", "parent", "below", *values, F.lit(False).alias("ended")))
    # A chain has no more nodes than the table, so doubling ends by then.
    for _ in range(known.count().bit_length() + 1):
        if known.where("not ended").isEmpty():
            return known.drop("ended")
        # What is below is the end, or a chain node that knows as many nodes again.
        more = [(F.col(f"a.{v}") + F.coalesce(F.col(f"b.{v}"), F.lit(0))).alias(v) for v in values]
        jumped = known.where("not ended").alias("a").join(
            known.alias("b"), F.col("a.below") == F.col("b.id"), "left"
        ).select(
            "a.id", "a.parent", F.coalesce("b.below", "a.below").alias("below"), *more,
            F.coalesce("b.ended", F.lit(True)).alias("ended"),
        )
        known = cut_lineage(jumped.unionByName(known.where("ended")))
    raise ValueError("the parents form a circle")


def compress(live: DataFrame, chained: DataFrame, values: list[str]) -> DataFrame:
    """``live`` without chain nodes: the node below hangs on the chain's parent, which takes the sums; stored."""
    # The top of a chain is the node whose parent is not in it.
    tops = cut_lineage(
        chained.alias("c").join(chained.select(F.col("id").alias("at")), F.col("parent") == F.col("at"), "left_anti")
        .select("below", F.col("parent").alias("above"), *values)
    )
    rest = live.join(chained.select(F.col("id").alias("at")), F.col("id") == F.col("at"), "left_anti")
    moved = rest.join(tops.select("below", "above"), F.col("id") == F.col("below"), "left").select(
        "id", F.coalesce("above", "parent").alias("parent"), *values
    )
    sums = tops.groupBy(F.col("above").alias("at")).agg(*[F.sum(v).alias(v) for v in values])
    return cut_lineage(_add(moved, sums, values))


def subtree_sums(nodes: DataFrame, values: Sequence[str], max_rounds: int = 200) -> DataFrame:
    """(id, values): each value summed over the subtree of ``id``, itself included.

    ``nodes`` has ``id`` and ``parent`` of any type that can be ordered, and whole-number values.
    """
    values = list(values)
    live = cut_lineage(nodes.select("id", "parent", *[F.coalesce(v, F.lit(0)).cast("long").alias(v) for v in values]))
    removed: list[tuple[DataFrame, DataFrame]] = []
    for _ in range(max_rounds):
        if live.where("parent is not null").isEmpty():
            break
        leaves, inner = rake(live, values)
        chained = chains(inner, values)
        live = compress(inner, chained, values) if not chained.isEmpty() else inner
        removed.append((leaves, chained))
    else:
        raise ValueError("the parents form a circle")
    totals = [live.select("id", *values)]
    for leaves, chained in reversed(removed):
        # What hangs below a chain went later; its sums are complete by now.
        later = reduce(DataFrame.unionByName, totals)
        whole = [(F.col(f"c.{v}") + F.col(f"t.{v}")).alias(v) for v in values]
        if not chained.isEmpty():
            totals.append(cut_lineage(
                chained.alias("c").join(later.alias("t"), F.col("c.below") == F.col("t.id")).select("c.id", *whole)
            ))
        totals.append(leaves)
    return reduce(DataFrame.unionByName, totals)
