"""Sinks: delimited text, hourly multi-output, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str, sep: str = "\t", compression: str | None = "gzip",
                    mode: str = "overwrite") -> None:
    """Delimited lines without header, quoting or escaping; NULL becomes empty text."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    writer = df.select(line.alias("value")).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def read_delimited(spark: SparkSession, path: str, schema, sep: str = "\t") -> DataFrame:
    """Lines back to typed columns; a missing or unreadable field is NULL."""
    parts = F.split(F.col("value"), F.lit("\\Q" + sep + "\\E"), -1)
    columns: list[Column] = []
    for i, field in enumerate(schema.fields):
        columns.append(F.get("p", F.lit(i)).try_cast(field.dataType).alias(field.name))
    return spark.read.text(path).select(parts.alias("p")).select(*columns)


# Output kind by id type, types without an output are left out.
COOKIE_KIND = "agsid"
CHANNEL_KIND = "channelid"


def hourly_kinds(df: DataFrame, id_type: str = "id_type") -> DataFrame:
    """Mark cookie rows (type 1) and channel rows (all but 1 and 5)."""
    kind = F.when(F.col(id_type) == 1, COOKIE_KIND).when(F.col(id_type) != 5, CHANNEL_KIND)
    return df.withColumn("kind", kind).where(F.col("kind").isNotNull())


def write_hourly(df: DataFrame, path: str, slot: str = "hour", kind: str = "kind") -> None:
    """All slots and kinds in one pass, one directory each.

    Only the slots present are replaced (dynamic partition overwrite). The
    rebalance hint gathers small slots and splits large ones.
    """
    (
        df.hint("rebalance", F.col(slot), F.col(kind))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(slot, kind).parquet(path)
    )


def compact(spark: SparkSession, source: str, target: str, keys: Sequence[str]) -> None:
    """Rewrite a partitioned table into files of the advisory partition size.

    The rebalance hint gathers the small files of a partition value and lets
    Spark split a large one over several tasks.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compaction must not write the path it reads")
    (
        spark.read.parquet(source).hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(target)
    )
