"""Connected components by alternating large-star and small-star steps.

The algorithm is the one of Kiveris et al., "Connected Components in MapReduce
and Beyond" (SoCC 2014), written as grouped minima and joins. The component id
is the least member id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.bloom import might_be_member
from clickloom.session import cut_lineage, discard, fresh_folder


def _attach(edges: DataFrame, minima: DataFrame, on: list[str]) -> DataFrame:
    """Give each edge the minimum of its ``on`` node.

    The minima are a stored table, so both sides are plain exchanges and
    adaptive execution splits the edges of a hot node.
    """
    return edges.join(minima, on, "inner")


def _large_star(edges: DataFrame, by: list[str], stage: _Stages) -> DataFrame:
    """Hang every larger neighbour of a node on the least node it knows."""
    # A node's own id takes part in its minimum.
    ends = F.array(F.col("lo"), F.col("hi"))
    minima = edges.select(*by, F.explode(ends).alias("node"), "lo").groupBy(*by, "node").agg(F.min("lo").alias("least"))
    joined = _attach(edges.withColumnRenamed("lo", "node"), stage.store(minima), [*by, "node"])
    return joined.select(*by, F.col("least").alias("lo"), "hi")


def _small_star(edges: DataFrame, by: list[str], stage: _Stages) -> DataFrame:
    """Hang a node and all its smaller neighbours on the least of them."""
    minima = edges.groupBy(*by, "hi").agg(F.min("lo").alias("least"))
    joined = _attach(edges, stage.store(minima), [*by, "hi"])
    least = F.col("least")
    # ``lo`` itself moves too; a pair of equal ends says nothing and is dropped.
    heads = F.when(F.col("lo") == least, F.array("hi")).otherwise(F.array("lo", "hi"))
    return joined.select(*by, least.alias("lo"), F.explode(heads).alias("hi")).distinct()


class _Stages:
    """Stored tables of the rounds; those of a round go once its result is stored."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []

    def store(self, df: DataFrame) -> DataFrame:
        self.folders.append(fresh_folder(self.spark, "round"))
        return cut_lineage(df, self.folders[-1])

    def store_marked(self, edges: DataFrame, by: list[str]) -> tuple[DataFrame, tuple]:
        """Store edges; their count and two order-free hashes are taken while they are written."""
        code = F.xxhash64(*by, "lo", "hi")
        seen = Observation()
        watched = edges.observe(
            seen, F.count(F.lit(1)).alias("n"), F.bit_xor(code).alias("x"),
            F.sum(code.cast("decimal(38,0)")).alias("s"),
        )
        stored = self.store(watched)
        return stored, tuple(seen.get[name] for name in ("n", "x", "s"))

    def drop_all_but_last(self) -> None:
        for folder in self.folders[:-1]:
            discard(self.spark, folder)
        self.folders = self.folders[-1:]


def _nodes(edges: DataFrame, by: list[str], stage: _Stages) -> DataFrame:
    """One stored row per node: its only source, if it has no more edges, else its least target and itself.

    ``hub`` is set for a pendant: a node that stands only as ``dst``, and only
    below one source. ``inner`` marks the other nodes that stand as ``dst``.
    """
    a, b = F.col("src"), F.col("dst")
    none = F.lit(None).cast(edges.schema["src"].dataType)

    def end(node, above, below):
        return F.struct(node.alias("node"), above.alias("above"), below.alias("below"))

    ends = F.when(a == b, F.array(end(a, none, none))).otherwise(F.array(end(b, a, none), end(a, none, b)))
    # Repeated edges change no minimum, so they need not be dropped. Where the edges of a source lie
    # together, they are one row before anything is shuffled.
    found = edges.select(*by, F.explode(ends).alias("e")).groupBy(*by, F.col("e.node").alias("node")).agg(
        F.min("e.above").alias("first"), F.max("e.above").alias("last"), F.min("e.below").alias("below"),
    )
    pendant = F.col("below").isNull() & (F.col("first") == F.col("last"))
    return stage.store(found.select(
        *by, "node", F.when(pendant, F.col("first")).alias("hub"), "below",
        (F.col("first").isNotNull() & ~F.coalesce(pendant, F.lit(False))).alias("inner"),
    ))


def connected_components(edges: DataFrame, by: Sequence[str] = (), src: str = "src", dst: str = "dst") -> DataFrame:
    """(by..., node, component) for every node that has an edge.

    ``by`` names columns that separate independent graphs, for instance one per
    hour; all graphs are solved in the same rounds. Pendants, nodes that stand
    only as ``dst`` of one source, take no part in the rounds: they get the
    component of their source, and the least of them stands for all of them.
    """
    by = list(by)
    a, b = F.col("src"), F.col("dst")
    given = edges.select(*by, F.col(src).alias("src"), F.col(dst).alias("dst"))
    whole = a != b
    for name in by:
        whole = whole & F.col(name).isNotNull()
    stage = _Stages(edges.sparkSession)
    # Stored in the order they come in, so that hashed ids are not computed again.
    raw = stage.store(given.where((a == b) | whole))
    nodes = _nodes(raw, by, stage)
    rest = nodes.where(F.col("hub").isNull())
    inner = rest.where("inner").select(*by, F.col("node").alias("dst"))
    n_inner = inner.count()
    least = F.least("node", "below")
    labels = rest.select(*by, "node", least.alias("component"))
    if n_inner:
        likely = might_be_member(raw.where(a != b), inner, [*by, "dst"], n_inner)
        links = stage.store(likely.join(inner, [*by, "dst"], "left_semi").select(*by, "src", "dst").distinct())
        linked = links.select(*by, F.explode(F.array("src", "dst")).alias("node")).distinct()
        # A linked node's least target goes along, in case it is a pendant.
        below = rest.where("below is not null").join(linked, [*by, "node"], "left_semi")
        core = links.unionByName(below.select(*by, F.col("node").alias("src"), F.col("below").alias("dst")))
        solved = _solve(core.select(*by, F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct(), by)
        found = rest.join(solved.withColumnRenamed("component", "found"), [*by, "node"], "left")
        labels = found.select(*by, "node", F.coalesce("found", least).alias("component"))
    # Stored, so that adaptive execution splits the pendants of a hot node.
    labels = cut_lineage(labels)
    pendants = nodes.where(F.col("hub").isNotNull()).select(*by, "node", "hub")
    attached = pendants.join(labels.withColumnRenamed("node", "hub"), [*by, "hub"], "inner")
    return labels.unionByName(attached.select(*by, "node", "component"))


def _solve(edges: DataFrame, by: list[str]) -> DataFrame:
    """(by..., node, component) of distinct edges ``lo < hi``.

    Each round is stored in the shared folder, the tables of the round before
    are deleted, and the loop ends when a round leaves the edge set unchanged.
    """
    stage = _Stages(edges.sparkSession)
    current, mark = stage.store_marked(edges, by)
    while mark[0]:
        # Read twice by the next step; a lost block is computed again from the stored tables.
        large = _large_star(current, by, stage).persist(StorageLevel.MEMORY_AND_DISK)
        current, new_mark = stage.store_marked(_small_star(large, by, stage), by)
        large.unpersist()
        stage.drop_all_but_last()
        if new_mark == mark:
            break
        mark = new_mark
    members = current.select(*by, F.col("hi").alias("node"), F.col("lo").alias("component"))
    # Every node hangs below its component now, and is no component itself.
    roots = current.select(*by, F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return members.unionByName(roots)
