"""Joins and guards that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single join task should see at most.
HOT_ROWS = 1_000_000
# A key is hot only above 1/HOT_SHARE of all rows, so there are fewer hot keys than this.
HOT_SHARE = 10_000

_SALT = "__salt"
_SALTS = "__salts"


def hot_key_salts(counts: DataFrame, on: Sequence[str], n: str, hot_rows: int = HOT_ROWS,
                  hot_share: int = HOT_SHARE) -> DataFrame | None:
    """Hot keys with the number of salts each needs, as a local table; None if no key is hot.

    ``counts`` should be a stored table: its sum and then its hot keys are
    read. The threshold rises with the rows, so the list is bounded by
    construction and every key above that share is on it.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    least = max(hot_rows, -(-total // hot_share))
    hot = counts.where(F.col(n) > least).select(*on, F.ceil(F.col(n) / hot_rows).cast("int").alias(_SALTS))
    rows = hot.collect()
    return counts.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                counts: DataFrame | None = None, count_col: str = "n_rows",
                hot_rows: int = HOT_ROWS, hot_share: int = HOT_SHARE) -> DataFrame:
    """Equi-join whose left side may hold very many rows of a single key.

    Without ``counts`` it is the plain join: where both sides come in
    unshuffled, adaptive execution broadcasts a small side or splits a skewed
    key. With the left rows per key in ``counts`` (a stored table), a key of
    ``n`` rows is split over ``ceil(n / hot_rows)`` salts and only that key's
    right rows are repeated, so at most ``rows / hot_rows`` of them are added.

    The salt is a hash of the whole left row and its partition: it spreads a
    left side that comes in one partition, and it is the same when a lost task
    runs again.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    hot = None if counts is None else hot_key_salts(counts, on, count_col, hot_rows, hot_share)
    if hot is None:
        return left.join(right, on, how)
    hashable = [F.col(f.name) for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.xxhash64(*hashable, F.spark_partition_id())
    listed = F.broadcast(hot)
    salted_left = left.withColumn(_SALT, spread).join(listed, on, "left").withColumn(
        _SALT, F.pmod(F.col(_SALT), F.coalesce(F.col(_SALTS), F.lit(1))).cast("int")
    ).drop(_SALTS)
    salted_right = right.join(listed, on, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
    ).drop(_SALTS)
    return salted_left.join(salted_right, [*on, _SALT], how).drop(_SALT)


def drop_oversized(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Drop every group of ``limit`` rows or more.

    Only the keys of oversized groups are joined back, so the usual case is an
    empty or tiny right side, which Spark broadcasts; the rows of a huge group
    then stay where they are.
    """
    keys = list(keys)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return df.join(sizes.where(F.col("n_rows") >= limit).select(*keys), keys, "left_anti")
