"""Unions of logs and of results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_labelled(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """Bag union with the source's name in a column."""
    return union_all([df.withColumn(label, F.lit(name)) for name, df in frames.items()])
