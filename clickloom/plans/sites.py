"""Site co-occurrence and site clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.hashing import md5_signed64
from clickloom.functions.weights import affinity
from clickloom.operators.baskets import item_pairs, pair_counts
from clickloom.operators.dedupe import top_per_group
from clickloom.operators.graph import connected_components
from clickloom.operators.metrics import both_directions
from clickloom.operators.rendering import text_parts
from clickloom.operators.skew import spread_join
from clickloom.session import cut_lineage, store_in_small_tasks


def site_pairs(visits: DataFrame, user: str, site: str, low: int = 2, high: int = 24,
               keys: Sequence[str] = ()) -> DataFrame:
    """Pair counts of sites that users with ``low`` to ``high`` sites share, as a stored table."""
    pairs = item_pairs(visits, [*keys, user], site, low, high)
    return store_in_small_tasks(pair_counts(pairs, keys))


def scored_neighbours(pairs: DataFrame, min_weight: int = 30, min_degree: int = 4) -> DataFrame:
    """(node, neighbour, n, score) of nodes with more than ``min_degree`` strong pairs.

    The score uses the neighbour's own total and degree; a neighbour that is
    not such a node scores zero.
    """
    # Few pairs are strong, but all pairs are counted for it.
    strong = store_in_small_tasks(both_directions(
        pairs.groupBy("item_a", "item_b").agg(F.sum("n").alias("n")).where(F.col("n") > min_weight),
        "item_a", "item_b", "n",
    ))
    nodes = cut_lineage(strong.groupBy("node").agg(F.sum("n").alias("total"), F.count("*").alias("n_rows")).where(
        F.col("n_rows") > min_degree
    ))
    kept = spread_join(strong, nodes.select("node"), ["node"], "left_semi", counts=nodes)
    # Every pair stands in ``strong`` both ways, so a node has as many rows as
    # neighbour as it has as node.
    table = nodes.select(F.col("node").alias("neighbour"), "total", F.col("n_rows").alias("degree"))
    scored = spread_join(kept, table, ["neighbour"], "left", counts=table, count_col="degree")
    return scored.select(
        "node", "neighbour", "n",
        F.round(affinity(F.col("n"), F.col("total"), F.col("degree")), 6).alias("score"),
    )


def best_neighbours(scored: DataFrame, min_score: float = 1.0) -> DataFrame:
    """The best neighbour of each node when it scores above ``min_score``."""
    best = top_per_group(scored, ["node"], [F.desc("score"), F.asc("neighbour")], 1)
    return best.where(F.col("score") > min_score)


def site_clusters(best: DataFrame) -> DataFrame:
    """(site, cluster): components of the best-neighbour links."""
    best = cut_lineage(best.select("node", "neighbour"))
    edges = best.select(
        md5_signed64(F.col("node").cast("string")).alias("src"),
        md5_signed64(F.col("neighbour").cast("string")).alias("dst"),
    )
    names = best.select(F.explode(F.array("node", "neighbour")).alias("site")).distinct().withColumn(
        "node", md5_signed64(F.col("site").cast("string"))
    )
    return names.join(connected_components(edges), ["node"]).select("site", F.col("component").alias("cluster"))


def cluster_sizes(clusters: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` largest clusters."""
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members"))
    return sizes.orderBy(F.desc("members"), "cluster").limit(k)


def cluster_lines(clusters: DataFrame, **options) -> DataFrame:
    """Members of each cluster as one text (several parts for a very large cluster)."""
    return text_parts(clusters, ["cluster"], F.col("site").cast("string"), ",", out="members", **options)
