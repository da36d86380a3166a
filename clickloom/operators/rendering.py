"""Lists and text lines per group, in parts of bounded size that follow the order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

PART_ROWS = 10_000


def _ranked_pieces(counted: DataFrame, keys: list[str], descending: bool, part_rows: int) -> DataFrame:
    """Values of large groups with their part: the place in the whole order, divided by ``part_rows``.

    A group may be of any size, so places are not counted in one task. Rows are
    range-partitioned by key and value; the sums of the partitions in front of a
    row and the running sum inside its own partition give its place.
    """
    order = F.desc("__value") if descending else F.asc("__value")
    ranged = cut_lineage(
        counted.repartitionByRange(*[F.asc(k) for k in keys], order).withColumn("__range", F.spark_partition_id())
    )
    sums = ranged.groupBy(*keys, "__range").agg(F.sum("__copies").alias("__in_range"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    fronts = sums.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__range").alias("__r"),
        F.coalesce(F.sum("__in_range").over(before), F.lit(0)).alias("__front"),
    )
    same = F.col("__range") == F.col("__r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    running = Window.partitionBy("__range", *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(fronts, same).withColumn(
        "__place", F.col("__front") + F.coalesce(F.sum("__copies").over(running), F.lit(0))
    )
    size = F.lit(part_rows).cast("bigint")
    first = F.call_function("div", F.col("__place"), size)
    last = F.call_function("div", F.col("__place") + F.col("__copies") - 1, size)
    cut = placed.withColumn("part", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("__place"), F.col("part") * size)
    end = F.least(F.col("__place") + F.col("__copies"), (F.col("part") + 1) * size)
    return cut.select(*keys, "__value", F.col("part").cast("int").alias("part"), (end - start).alias("__copies"))


def collect_parts(df: DataFrame, keys: Sequence[str], value: Column, out: str = "values",
                  descending: bool = False, part_rows: int = PART_ROWS) -> DataFrame:
    """Sorted list of all values per key, duplicates kept, with a ``part`` number.

    A group of up to ``part_rows`` values gives one row with part 0. A larger
    one gives as many rows as it needs, each but the last with ``part_rows``
    values; the parts one after the other are the whole sorted list. Copies of
    one value are counted first, so a pile of equal values is split as well.
    """
    keys = list(keys)
    counted = cut_lineage(
        df.select(*keys, value.alias("__value")).groupBy(*keys, "__value").agg(F.count("*").alias("__copies"))
    )
    # Fewer keys than rows / part_rows.
    large = cut_lineage(
        counted.groupBy(*keys).agg(F.sum("__copies").alias("__total")).where(F.col("__total") > part_rows).select(*keys)
    )
    if large.isEmpty():
        pieces = counted.withColumn("part", F.lit(0))
    else:
        names = [F.col(k).alias(f"__l{i}") for i, k in enumerate(keys)]
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__l{i}"))
        listed = large.select(*names)
        fitting = counted.join(listed, same, "left_anti").withColumn("part", F.lit(0))
        ranked = _ranked_pieces(counted.join(listed, same, "left_semi"), keys, descending, part_rows)
        pieces = fitting.unionByName(ranked)
    entry = F.struct(F.col("__value").alias("value"), F.col("__copies").cast("int").alias("copies"))
    listed = F.sort_array(F.collect_list(entry), asc=not descending)
    repeated = F.flatten(F.transform(listed, lambda e: F.array_repeat(e["value"], e["copies"])))
    return pieces.groupBy(*keys, "part").agg(repeated.alias(out))


def text_parts(df: DataFrame, keys: Sequence[str], value: Column, sep: str, out: str = "line",
               descending: bool = False, part_rows: int = PART_ROWS) -> DataFrame:
    """:func:`collect_parts` joined to text."""
    lists = collect_parts(df, keys, value, out, descending, part_rows)
    return lists.withColumn(out, F.array_join(out, sep))
