"""Item recommenders: by pair count within a group, and by confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.baskets import (
    basket_pairs,
    bounded_baskets,
    item_support,
    neighbour_confidence,
    pair_counts,
    ranked_lists,
    top_neighbours,
)
from clickloom.operators.joins import both_members, only_members
from clickloom.operators.metrics import both_directions
from clickloom.session import cut_lineage, store_in_small_tasks


def group_pair_counts(views: DataFrame, day: str, user: str, group: str, item: str,
                      low: int = 2, high: int = 10) -> DataFrame:
    """(group, item_a, item_b, n), stored: baskets are one user's items of one group on one day."""
    baskets = bounded_baskets(views, [day, user, group], item, low, high)
    return store_in_small_tasks(pair_counts(basket_pairs(baskets, [group]), [group]))


def group_recommendations(counts: DataFrame, online: DataFrame, group: str, online_id: str,
                          k: int = 5) -> DataFrame:
    """(group, node, neighbour, n, rank): best partners, both ends online.

    The online list names items as ``group_item``.
    """
    named = counts.withColumn("__a", F.concat_ws("_", F.col(group).cast("string"), F.col("item_a").cast("string")))
    named = named.withColumn("__b", F.concat_ws("_", F.col(group).cast("string"), F.col("item_b").cast("string")))
    kept = both_members(named, "__a", "__b", online, online_id).drop("__a", "__b")
    directed = both_directions(kept, "item_a", "item_b", group, "n")
    return top_neighbours(directed, [group, "node"], "n", k)


def group_lines(ranked: DataFrame, group: str) -> DataFrame:
    """Two text forms per item: neighbour ids only, and with group and count."""
    head = F.concat_ws("_", F.col(group).cast("string"), F.col("node").cast("string"))
    detail = F.format_string("(%s,%s,%d)", F.col(group).cast("string"), F.col("neighbour").cast("string"), F.col("n"))
    entry = F.struct("rank", F.col("neighbour").cast("string").alias("id"), detail.alias("detail"))
    # At most k entries per item by construction.
    lists = ranked.groupBy(head.alias("__head")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return lists.select(
        F.concat_ws(",", "__head", F.array_join("e.id", ",")).alias("ids_line"),
        F.concat_ws(",", "__head", F.array_join("e.detail", ",")).alias("detail_line"),
    )


def confidence_recommendations(views: DataFrame, day: str, user: str, item: str, online: DataFrame,
                               online_id: str, low: int = 2, high: int = 7, k: int = 10) -> DataFrame:
    """(node, neighbour, n, confidence, rank): count over the neighbour's support."""
    known = only_members(views, item, online, online_id)
    # Stored: pairs and supports both read it.
    baskets = store_in_small_tasks(bounded_baskets(known, [day, user], item, low, high))
    counts = store_in_small_tasks(pair_counts(basket_pairs(baskets, [])))
    # Stored, so that the join can split the pairs of a popular item.
    support = cut_lineage(item_support(baskets))
    scored = neighbour_confidence(counts, support).withColumn("confidence", F.round("confidence", 6))
    return top_neighbours(scored, ["node"], "confidence", k)


def confidence_lines(ranked: DataFrame) -> DataFrame:
    """``item,neighbour,neighbour,...`` per item."""
    lists = ranked_lists(ranked, ["node"], F.col("neighbour"), "ids")
    return lists.select(F.concat_ws(",", F.col("node").cast("string"), "ids").alias("line"))

