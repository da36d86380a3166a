"""Items per basket, item pairs, supports and best neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.dedupe import top_per_group
from clickloom.operators.metrics import both_directions


def bounded_baskets(df: DataFrame, basket: Sequence[str], item: str, low: int, high: int) -> DataFrame:
    """Baskets of ``low`` to ``high`` distinct items, the items as a sorted array.

    A basket beyond ``high`` is no basket by definition and is left out whole.
    Only ``high + 1`` items of a basket ever reach the task that judges its
    size: Spark applies the row limit before the shuffle as well.
    """
    usable = df.select(*basket, item).where(F.col(item).isNotNull())
    for key in basket:
        usable = usable.where(F.col(key).isNotNull())
    kept = top_per_group(usable.distinct(), basket, [F.col(item)], high + 1)
    return (
        kept.groupBy(*basket)
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .where(F.size("items").between(low, high))
    )


def basket_pairs(baskets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, item_a, item_b) with item_a < item_b; baskets are bounded, so pairs are too."""
    pairs = F.flatten(F.transform(
        "items",
        lambda x, i: F.transform(
            F.slice("items", i + 2, F.size("items")),
            lambda y: F.struct(x.alias("item_a"), y.alias("item_b")),
        ),
    ))
    return baskets.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.item_a", "p.item_b")


def item_pairs(df: DataFrame, basket: Sequence[str], item: str, low: int = 2, high: int = 24) -> DataFrame:
    return basket_pairs(bounded_baskets(df, basket, item, low, high), list(basket))


def pair_counts(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return pairs.groupBy(*keys, "item_a", "item_b").agg(F.count("*").alias("n"))


def item_support(baskets: DataFrame) -> DataFrame:
    """Number of baskets that hold each item."""
    return baskets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("support"))


def accumulate_pairs(days: Sequence[DataFrame] | DataFrame, a: str = "item_a", b: str = "item_b",
                     n: str = "n", keys: Sequence[str] = ()) -> DataFrame:
    """Sum saved pair counts over days."""
    if isinstance(days, DataFrame):
        everything = days
    else:
        everything = days[0]
        for day in days[1:]:
            everything = everything.unionByName(day)
    return everything.groupBy(*keys, a, b).agg(F.sum(n).alias(n))


def top_neighbours(scored: DataFrame, keys: Sequence[str], score: str, k: int,
                   neighbour: str = "neighbour", rank_col: str = "rank") -> DataFrame:
    """Best ``k`` neighbours per key, ties by neighbour."""
    return top_per_group(scored, keys, [F.desc(score), F.asc(neighbour)], k, rank_col)


def neighbour_confidence(counts: DataFrame, support: DataFrame) -> DataFrame:
    """Pair count over the neighbour's support, for both directions."""
    directed = both_directions(counts, "item_a", "item_b", "n")
    table = support.select(F.col("item").alias("neighbour"), "support")
    return directed.join(table, ["neighbour"], "inner").select(
        "node", "neighbour", "n", (F.col("n").cast("double") / F.col("support")).alias("confidence")
    )


def ranked_lists(ranked: DataFrame, keys: Sequence[str], value: Column, out: str, sep: str = ",",
                 rank_col: str = "rank") -> DataFrame:
    """Text list per key in rank order; at most k entries per key by construction."""
    entry = F.struct(F.col(rank_col).alias("r"), value.cast("string").alias("v"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"])
    return ranked.groupBy(*keys).agg(F.array_join(listed, sep).alias(out))
