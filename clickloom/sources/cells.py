"""Keyed cell tables: (row_key, family, qualifier, value, version) in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.rendering import text_parts

# Fixed value: the qualifier whose value is a number.
COUNTER = "counter"


def cells_from_wide(df: DataFrame, row_key: str, family: str, columns: Sequence[str], version: Column) -> DataFrame:
    """One cell per present column."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return df.select(
        F.col(row_key).cast("string").alias("row_key"), F.lit(family).alias("family"),
        F.explode(cells).alias("c"), version.cast("bigint").alias("version"),
    ).select("row_key", "family", "c.qualifier", "c.value", "version").where(F.col("value").isNotNull())


def upsert_cells(table: DataFrame, changes: DataFrame) -> DataFrame:
    """Last write per cell wins; at equal versions the change does.

    The result is a new table: write it next to the old one, never over it.
    """
    both = table.withColumn("__from", F.lit(0)).unionByName(changes.withColumn("__from", F.lit(1)))
    best = both.groupBy("row_key", "family", "qualifier").agg(
        F.max(F.struct("version", "__from", "value")).alias("b")
    )
    return best.select("row_key", "family", "qualifier", F.col("b.value").alias("value"),
                       F.col("b.version").alias("version"))


def scan_cells(table: DataFrame, families: Sequence[str] = (), columns: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Cells of whole families and of single (family, qualifier) columns; all when neither is given."""
    wanted = None
    for family in families:
        test = F.col("family") == family
        wanted = test if wanted is None else wanted | test
    for family, qualifier in columns:
        test = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        wanted = test if wanted is None else wanted | test
    return table if wanted is None else table.where(wanted)


def lookup_cells(keys: DataFrame, table: DataFrame, key: str = "row_key", **options) -> DataFrame:
    """Rows of the listed keys as ``key:(qualifier,value)...`` text."""
    wanted = keys.select(F.col(key).alias("row_key"))
    # A semi-join ignores repeated keys; a short key list is broadcast by size.
    found = table.join(wanted, ["row_key"], "left_semi")
    shown = F.when(F.col("qualifier") == COUNTER, F.col("value").try_cast("bigint").cast("string")).otherwise(
        F.col("value")
    )
    cell = F.concat(F.lit("("), F.col("qualifier"), F.lit(","), F.coalesce(shown, F.lit("")), F.lit(")"))
    lists = text_parts(found, ["row_key"], cell, "", out="cells", **options)
    return lists.select("row_key", "part", F.concat_ws(":", "row_key", "cells").alias("line"))
