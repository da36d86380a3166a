"""Send-counter state per id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import blank_to_null
from clickloom.operators.rendering import PART_ROWS, collect_parts
from clickloom.session import cut_lineage


def parse_counter_lines(lines: DataFrame) -> DataFrame:
    """State text -> (id, send_type, send_num, num, time), one row per counter entry.

    A line is ``id,type,number`` followed by number/time pairs, possibly with
    list and tuple marks. A number without a time is not an entry.
    """
    flat = F.translate(F.replace(F.col("value"), F.lit(",List("), F.lit(",")), "() ", "")
    parsed = lines.select(F.split(flat, ",").alias("p"))
    n_pairs = F.call_function("div", F.size("p") - 3, F.lit(2)).cast("int")
    steps = F.when(n_pairs > 0, F.sequence(F.lit(0), n_pairs - 1)).otherwise(F.array().cast("array<int>"))
    return parsed.select(
        F.get("p", F.lit(0)).alias("id"),
        F.get("p", F.lit(1)).alias("send_type"),
        F.get("p", F.lit(2)).try_cast("int").alias("send_num"),
        F.explode_outer(steps).alias("i"),
        "p",
    ).select(
        "id", "send_type", "send_num",
        F.get("p", F.col("i") * 2 + 3).try_cast("int").alias("num"),
        F.get("p", F.col("i") * 2 + 4).alias("time"),
    )


def merge_counters(entries: DataFrame, drop_newest: bool = False) -> DataFrame:
    """(id, send_type, send_num, time, num): the greatest number per id and time.

    The scalars are the greatest present type and positive number of the id.
    ``drop_newest`` leaves out each id's newest time.
    """
    entries = cut_lineage(entries)
    # Stored, so that the join can split the times of one id.
    scalars = cut_lineage(entries.groupBy("id").agg(
        F.coalesce(F.max(blank_to_null(F.col("send_type"))), F.lit("")).alias("send_type"),
        F.coalesce(F.max(F.when(F.col("send_num") > 0, F.col("send_num"))), F.lit(0)).alias("send_num"),
        F.max("time").alias("__newest"),
    ))
    sends = entries.where(F.col("time").isNotNull()).groupBy("id", "time").agg(F.max("num").alias("num"))
    merged = sends.join(scalars, ["id"], "inner")
    if drop_newest:
        merged = merged.where(F.col("time") < F.col("__newest"))
    return merged.select("id", "send_type", "send_num", "time", "num")


def counter_states(merged: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per id with its sends, newest first (several parts for an extreme id)."""
    value = F.struct(F.col("time").alias("time"), F.col("num").alias("num"))
    return collect_parts(merged, ["id", "send_type", "send_num"], value, "sends", descending=True,
                         part_rows=part_rows)
