"""Daily channel-id merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.times import history_floor
from clickloom.operators.dedupe import latest
from clickloom.operators.joins import dictionary_lookup
from clickloom.schemas import CHANNEL_HISTORY_DAYS
from clickloom.session import cut_lineage, discard, fresh_folder


def day_changes(changes: DataFrame) -> DataFrame:
    """(old_uid, new_uid, hour) of the day's windows -> the latest hour per old uid."""
    return latest(changes.select("old_uid", "new_uid", "hour"), ["old_uid"], "hour").select("old_uid", "new_uid")


def chained_changes(changes: DataFrame) -> DataFrame:
    """Follow a -> b -> c to the end of each chain.

    An old uid has one successor, so each round lets every uid jump to where its
    present place has got to: 2, 4, 8 ... hops, and the rounds are the logarithm of the
    number of uids at most. Who then still stands on an old uid is in a circle or leads
    into one, has no end and keeps the single hop. Of several successors the least counts.
    Both sides of a round's join are stored tables, so a uid that many lead to is no
    bottleneck.
    """
    spark = changes.sparkSession
    hops = changes.where(F.col("old_uid").isNotNull()).groupBy("old_uid").agg(F.min("new_uid").alias("new_uid"))
    folder = fresh_folder(spark, "chains")
    at = cut_lineage(hops.withColumn("place", F.col("new_uid")), folder)
    for _ in range((at.count() - 1).bit_length()):
        further = at.select(F.col("old_uid").alias("place"), F.col("place").alias("next"))
        before, folder = folder, fresh_folder(spark, "chains")
        moved = at.join(further, ["place"], "left").select(
            "old_uid", "new_uid", F.coalesce("next", "place").alias("place"), F.col("next").isNotNull().alias("moved"))
        stored = cut_lineage(moved, folder)
        discard(spark, before)
        at = stored.drop("moved")
        if stored.where("moved").isEmpty():
            break
    olds = at.select(F.col("old_uid").alias("place"), F.lit(True).alias("endless"))
    return at.join(olds, ["place"], "left").select(
        "old_uid", F.when(F.col("endless"), F.col("new_uid")).otherwise(F.col("place")).alias("new_uid"))


def merge_channels(today: DataFrame, history: DataFrame | None, changes: DataFrame, day: str,
                   keep_days: int = CHANNEL_HISTORY_DAYS, transitive: bool = False) -> DataFrame:
    """Channel ids: history not older than ``keep_days`` and today, latest per cid, uids remapped."""
    rows = today.select("cid", "uid", "id_type", "minute")
    if history is not None:
        kept = history.where(F.col("minute") >= history_floor(day, keep_days))
        rows = rows.unionByName(kept.select("cid", "uid", "id_type", "minute"))
    return _remap(latest(rows, ["cid"], "minute"), changes, transitive)


def merge_cookies(today: DataFrame, changes: DataFrame, transitive: bool = False) -> DataFrame:
    """Cookie ids: today only, latest per cid and type, uids remapped."""
    rows = today.select("cid", "uid", "id_type", "minute")
    return _remap(latest(rows, ["cid", "id_type"], "minute"), changes, transitive)


def _remap(rows: DataFrame, changes: DataFrame, transitive: bool) -> DataFrame:
    table = chained_changes(changes) if transitive else changes
    return dictionary_lookup(rows, table, "uid", "old_uid", "new_uid", "new_uid").select(
        "cid", F.col("new_uid").alias("uid"), "id_type", "minute"
    )
