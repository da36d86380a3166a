"""Log scans: partitioned log tables and raw text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of a log table: one directory per log type, channel and day; the hour
# is a column that rows are sorted by, so an hour filter skips row groups.
PARTITIONS = ("log_type", "channel", "day")

# Log families and their types.
DISPLAY_TYPES = ("bidder", "adshow", "show", "cm", "tt")
VIEW_TYPES = ("pv", "track")
TAG_TYPES = ("inc", "all")
REALTIME_TYPE = "realtime_tags"


def write_log_table(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write (log_type, channel, day, hour, value) lines as a log table.

    Rows are gathered by partition and hour so that each file covers few hours;
    the rebalance hint lets Spark split a gathered piece that is too large.
    """
    (
        lines.select(*PARTITIONS, "hour", "value")
        .hint("rebalance", *[F.col(c) for c in (*PARTITIONS, "hour")])
        .sortWithinPartitions(*PARTITIONS, "hour")
        .write.mode(mode).partitionBy(*PARTITIONS).parquet(path)
    )


def scan_log(spark: SparkSession, path: str, log_types: Sequence[str] | None = None,
             channels: Sequence[str] | None = None, days: Sequence[str] | None = None,
             hours: Sequence[str] | None = None) -> DataFrame:
    """Pruned scan of a log table. ``hours`` are ``yyyy-MM-dd-HH`` slots.

    An hour list also names its days, so only those directories are listed and
    the hour test goes down to the files.
    """
    table = spark.read.schema(
        "hour string, value string, log_type string, channel string, day string"
    ).parquet(path)
    if hours is not None:
        days = sorted({h[:10] for h in hours}) if days is None else days
        table = table.where(F.col("hour").isin(*hours))
    for name, wanted in (("log_type", log_types), ("channel", channels), ("day", days)):
        if wanted is not None:
            table = table.where(F.col(name).isin(*wanted))
    return table


# One value or a list of values.
Some = str | Sequence[str]


def _listed(some: Some) -> list[str]:
    return [some] if isinstance(some, str) else list(some)


def scan_display(spark: SparkSession, path: str, log_type: Some, channel: Some, time: Some) -> DataFrame:
    """Display logs of some types and channels in one scan; ``time`` is a day or an hour slot, or a list of either."""
    return _scan_family(spark, path, log_type, DISPLAY_TYPES, channel, time)


def scan_page_views(spark: SparkSession, path: str, log_type: str, time: Some) -> DataFrame:
    """Page-view or tracking logs: any type but ``pv`` means tracking."""
    kind = "pv" if log_type == "pv" else "track"
    return _scan_family(spark, path, kind, VIEW_TYPES, None, time)


def scan_tag_export(spark: SparkSession, path: str, log_type: Some, channel: Some, time: Some) -> DataFrame:
    return _scan_family(spark, path, log_type, TAG_TYPES, channel, time)


def scan_realtime_tags(spark: SparkSession, path: str, time: Some) -> DataFrame:
    return _scan_family(spark, path, REALTIME_TYPE, (REALTIME_TYPE,), None, time)


def _scan_family(spark: SparkSession, path: str, log_type: Some, known: Sequence[str],
                 channel: Some | None, time: Some) -> DataFrame:
    types = _listed(log_type)
    unknown = [x for x in types if x not in known]
    if unknown:
        raise ValueError(f"unknown log type {unknown[0]!r}, expected one of {known}")
    channels = None if channel is None else _listed(channel)
    times = _listed(time)
    if any(len(x) > 10 for x in times):
        return scan_log(spark, path, types, channels, hours=times)
    return scan_log(spark, path, types, channels, days=times)


def scan_text(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw text lines; gzip and zstd files are unpacked by Spark."""
    return spark.read.text(list(paths))


def scan_hours(spark: SparkSession, paths: Sequence[str], hours: Sequence[str], **pruning) -> DataFrame:
    """An explicit list of hours from several log tables, as one bag."""
    scans = [scan_log(spark, p, hours=hours, **pruning) for p in paths]
    everything = scans[0]
    for more in scans[1:]:
        everything = everything.unionByName(more)
    return everything
