"""Keep one or a few records per key, always under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rest(df: DataFrame, keys: Sequence[str], first: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in first]


def latest(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Record with the greatest time per key; ties go to the greatest remaining columns."""
    return top_per_group(df, keys, [F.desc(c) for c in (time, *_rest(df, keys, [time]))], 1)


def earliest(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Record with the least time per key; ties go to the least remaining columns."""
    return top_per_group(df, keys, [F.asc(c) for c in (time, *_rest(df, keys, [time]))], 1)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                  rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows per key.

    Spark limits each map task to ``k`` rows per key before the shuffle
    (WindowGroupLimit), so a hot key does not travel whole.
    """
    rank = rank_col or "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
    return ranked if rank_col else ranked.drop(rank)


def recent_per_group(df: DataFrame, keys: Sequence[str] = ("uid", "id_type"), limit: int = 50) -> DataFrame:
    """Newest ``limit`` identity records per group: minute, then cid, descending."""
    used = [*keys, "minute", "cid"]
    order = [F.desc("minute"), F.desc("cid")] + [F.desc(c) for c in df.columns if c not in used]
    return top_per_group(df, keys, order, limit)


def oldest_per_group(df: DataFrame, group: str, member: str, time: str) -> DataFrame:
    """Per group: size and the member with the least (time, member)."""
    return df.groupBy(group).agg(
        F.min(F.struct(F.col(time).alias("t"), F.col(member).alias("m"))).alias("__o"),
        F.count("*").alias("n_rows"),
    ).select(group, F.col("__o.m").alias("oldest"), F.col("__o.t").alias("oldest_time"), "n_rows")
