"""Identity index: a base table in hash buckets of the id, and one delta per window on top of it.

A window writes only what it touches: the merged records of its ids, and its
uid changes. Records that a change concerns but whose id did not occur in the
window stay where they are; the change is applied when they are read. Reading
names the ids it wants, so only their buckets are opened. The daily base folds
all layers into a new base.

Layers count from 0, the base. A record read from layer k is under the uid it
had after window k, and passes through the changes of the later windows in
their order, so a uid that is given up and later comes up again is not mistaken.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.hashing import compact_id_encode
from clickloom.plans.identity import IDENTITY_COLUMNS, history_from_daily_base, real_changes

BUCKETS = 64
# Explicit, so that empty layers can be read.
RECORDS = "cid_hash long, uid long, cid string, id_type int, minute long, num long, bucket int"
REDIRECTS = "uid long, new_uid long"
BASE = "uid_code string, cid string, id_type int, minute long, num long, bucket int"


def bucket_of(cid_hash: str | Column = "cid_hash", buckets: int = BUCKETS) -> Column:
    return F.pmod(cid_hash, F.lit(buckets)).cast("int")


def write_bucketed(records: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Records with one directory per bucket; a bucket's rows come together before they are written."""
    placed = records.withColumn("bucket", bucket_of(buckets=buckets))
    placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


@dataclass
class Layer:
    """What one window wrote: merged records of its ids and (uid, new_uid) of its changes."""

    records: DataFrame
    redirects: DataFrame


@dataclass
class IdentityIndex:
    """The base (None where there is none yet) and the layers on it, the oldest first."""

    base: DataFrame | None
    layers: list[Layer] = field(default_factory=list)
    buckets: int = BUCKETS

    def is_empty(self) -> bool:
        return self.base is None and not self.layers

    def touched_buckets(self, cids: DataFrame) -> list[int]:
        """Buckets of some ids: a list that is never longer than the number of buckets."""
        return sorted(r[0] for r in cids.select(bucket_of(buckets=self.buckets)).distinct().collect())

    def records(self, cids: DataFrame | None = None) -> DataFrame:
        """Current records; with ``cids`` (cid_hash), those of these ids, from their buckets alone."""
        named = None if cids is None else self.touched_buckets(cids)
        parts = []
        tables = [] if self.base is None else [(0, self.base)]
        for at, table in [*tables, *((i + 1, layer.records) for i, layer in enumerate(self.layers))]:
            if named is not None:
                table = table.where(F.col("bucket").isin(named)).join(
                    cids.select("cid_hash"), ["cid_hash"], "left_semi"
                )
            parts.append(table.select(*IDENTITY_COLUMNS, F.lit(at).alias("layer")))
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        if self.layers:
            newest = F.max(F.struct("layer", *[c for c in IDENTITY_COLUMNS if c != "cid_hash"])).alias("r")
            found = found.groupBy("cid_hash").agg(newest).select("cid_hash", "r.*")
        for at, layer in enumerate(self.layers, start=1):
            moved = layer.redirects.select("uid", "new_uid", F.lit(at).alias("since"))
            found = found.join(moved, ["uid"], "left").withColumn(
                "uid", F.when(F.col("since") > F.col("layer"), F.col("new_uid")).otherwise(F.col("uid"))
            ).drop("new_uid", "since")
        return found.select(*IDENTITY_COLUMNS)

    def older_in_range(self, first: int, end: int, cids: DataFrame) -> DataFrame:
        """Current records of other ids with a newest time in the range. The range reaches the files' statistics."""
        between = (F.col("minute") >= first) & (F.col("minute") < end)
        parts = [] if self.base is None else [self.base]
        hits = [p.where(between).select("cid_hash") for p in [*parts, *(layer.records for layer in self.layers)]]
        wanted = hits[0]
        for hit in hits[1:]:
            wanted = wanted.unionByName(hit)
        wanted = wanted.distinct().join(cids.select("cid_hash"), ["cid_hash"], "left_anti")
        return self.records(wanted).where(between)


def redirects_of(changes: DataFrame) -> DataFrame:
    return real_changes(changes).select(F.col("old_uid").alias("uid"), "new_uid")


def write_base(records: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """All current records as the coded base of a day."""
    coded = records.select("cid_hash", compact_id_encode(F.col("uid")).alias("uid_code"), "cid", "id_type", "minute", "num")
    placed = coded.withColumn("bucket", bucket_of(buckets=buckets)).drop("cid_hash")
    placed.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_base(spark: SparkSession, path: str) -> DataFrame:
    """A coded daily base as records with their bucket; the bucket prunes directories."""
    return history_from_daily_base(spark.read.schema(BASE).parquet(path), "bucket")


def read_layer(spark: SparkSession, records: str, redirects: str) -> Layer:
    return Layer(spark.read.schema(RECORDS).parquet(records), spark.read.schema(REDIRECTS).parquet(redirects))
