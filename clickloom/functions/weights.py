"""Numeric scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: numerator of the rarity factor and stand-in for absent totals.
INT_MAX = 2147483647


def affinity(pair_count: Column, neighbour_total: Column, neighbour_degree: Column) -> Column:
    """Share of the neighbour's weight, times the log rarity of the neighbour.

    A neighbour without totals takes the largest int for both, which makes the
    logarithm and so the score zero.
    """
    total = F.coalesce(neighbour_total.cast("double"), F.lit(float(INT_MAX)))
    degree = F.coalesce(neighbour_degree.cast("double"), F.lit(float(INT_MAX)))
    return pair_count.cast("double") / total * F.ln(F.lit(float(INT_MAX)) / degree)
