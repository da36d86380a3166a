"""Ad cost columns and the cost rollup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def internal_cost(win: Column, markup: Column) -> Column:
    """Win price plus markup per cent, rounded half up; 0 when not computable."""
    raw = F.floor(win.cast("double") * (F.lit(1.0) + markup.cast("double") / 100.0) + 0.5)
    return F.coalesce(raw.cast("bigint"), F.lit(0).cast("bigint"))


def unit_price(base: Column, factor: Column) -> Column:
    """Price per thousand times factor, as a whole unit price; NULL on overflow."""
    product = F.try_multiply(base.cast("bigint"), factor.cast("bigint"))
    return F.call_function("div", product, F.lit(1000).cast("bigint"))


def with_costs(df: DataFrame, win: str = "win", markup: str = "markup", base: str = "base",
               factor: str = "factor") -> DataFrame:
    """Add internal cost and customer cost, the lesser of internal cost and unit price."""
    inner = internal_cost(F.col(win), F.col(markup))
    unit = unit_price(F.col(base), F.col(factor))
    failed = unit.isNull() | F.col(win).isNull() | F.col(markup).isNull()
    zero = F.lit(0).cast("bigint")
    return df.withColumn("internal_cost", F.when(failed, zero).otherwise(inner)).withColumn(
        "cost", F.when(failed, zero).otherwise(F.least(inner, unit))
    )


def cost_rollup(df: DataFrame, keys: Sequence[str], **columns: str) -> DataFrame:
    return with_costs(df, **columns).groupBy(*keys).agg(
        F.count("*").alias("hits"),
        F.sum("internal_cost").alias("internal_cost"),
        F.sum("cost").alias("cost"),
    )
