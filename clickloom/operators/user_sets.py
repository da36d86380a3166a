"""Exact user sets as bitmaps over dense user numbers: stored once, united and overlapped without the log.

A user gets a number from a dictionary that only grows. A set is one row of 4 KB per
32,768 numbers, so a day of a billion users takes 125 MB, and the users of any days are
counted from the stored rows of those days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import cut_lineage


def user_numbers(rows: DataFrame, user: str, known: DataFrame | None = None) -> DataFrame:
    """(user, number): known users keep their numbers, new ones take the next, without gaps, from 1.

    New users are range-partitioned and counted per partition, so none of the tasks
    numbers them all. Store the result before it is used: it is the dictionary.
    """
    fresh = rows.where(F.col(user).isNotNull()).select(user).distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known, [user], "left_anti")
        first = known.agg(F.max("number")).first()[0] or 0
    ranged = cut_lineage(fresh.repartitionByRange(user).withColumn("__part", F.spark_partition_id()))
    # One row per partition.
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    fronts = ranged.groupBy("__part").agg(F.count("*").alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__front"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(user))
    numbered = ranged.join(F.broadcast(fronts), ["__part"]).select(
        user, (F.lit(first) + F.col("__front") + inside).cast("long").alias("number"))
    return numbered if known is None else known.select(user, "number").unionByName(numbered)


def user_bitmaps(rows: DataFrame, keys: Sequence[str], user: str, numbers: DataFrame) -> DataFrame:
    """(keys, bucket, bitmap): the users of each key. Every user has to be in ``numbers``."""
    # A user with most of the rows counts once per key before the join.
    seen = rows.where(F.col(user).isNotNull()).select(*keys, user).distinct()
    return seen.join(numbers, [user]).groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def union_counts(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct users per key, over all rows of the key."""
    united = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias("users"))


def overlap_counts(bitmaps: DataFrame, key: str, base: object) -> DataFrame:
    """Distinct users per key, and how many of them the base key has too.

    The overlap of a bucket is what both sides count less what their union counts.
    """
    own = bitmaps.groupBy(key, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    other = bitmaps.where(F.col(key) == base).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("__base"))
    both = own.join(other, ["bucket"], "left").withColumn("__each", F.explode(F.array("bitmap", "__base")))
    counts = both.groupBy(key, "bucket").agg(
        F.max(F.bitmap_count("bitmap")).alias("__users"), F.max(F.bitmap_count("__base")).alias("__others"),
        F.bitmap_count(F.bitmap_or_agg("__each")).alias("__both"),
    )
    shared = F.coalesce(F.col("__users") + F.col("__others") - F.col("__both"), F.lit(0))
    return counts.groupBy(key).agg(F.sum("__users").alias("users"), F.sum(shared).alias("overlap"))
