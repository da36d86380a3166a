"""Driver of consecutive identity windows: log tables in, tables in one folder out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions.times import hour_list, hours_before, previous_day, previous_hour, slot_minute
from clickloom.plans import channels, identity
from clickloom.plans.index import BUCKETS, IdentityIndex, read_base, read_layer, redirects_of, write_base, write_bucketed
from clickloom.session import cut_lineage
from clickloom.sources.logs import scan_hours
from clickloom.sources.sinks import COOKIE_KIND, hourly_kinds, write_hourly


@dataclass
class WindowPaths:
    """Where the windows keep their tables, and in how many buckets the index lies (the same in all runs)."""

    root: str
    buckets: int = BUCKETS

    def hourly(self) -> str:
        return f"{self.root}/hourly"

    def delta(self, slot: str, part: str) -> str:
        return f"{self.root}/index/{slot}/{part}"

    def daily_base(self, day: str) -> str:
        return f"{self.root}/daily_base/{day}"

    def output(self, slot: str, name: str) -> str:
        return f"{self.root}/window/{slot}/{name}"

    def idmap(self) -> str:
        return f"{self.root}/idmap"

    def channel_history(self, kind: str, day: str) -> str:
        return f"{self.root}/merged/{kind}/{day}"


def _stored(spark: SparkSession, path: str, may_lack: bool) -> DataFrame | None:
    """A table of an earlier run. It may be missing only where nothing can have written it yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.read.parquet(path)
    if may_lack:
        return None
    raise FileNotFoundError(f"{path} is missing; pass first_run=True only if there is no earlier run")


def previous_index(spark: SparkSession, paths: WindowPaths, hours: list[str], last: str,
                   first_run: bool = False) -> tuple[IdentityIndex, str | None, list[str]]:
    """(index to merge into, day of its base, slots of its layers).

    After a last hour 23 it is the day's base table alone, else what the last
    window stood on and its layer.
    """
    if last.endswith("-23"):
        day = hours[0][:10]
        found = _stored(spark, paths.daily_base(day), first_run)
        return (IdentityIndex(None), None, []) if found is None else (_index(spark, paths, day, []), day, [])
    known = _stored(spark, paths.delta(last, "layers"), first_run)
    if known is None:
        return IdentityIndex(None), None, []
    day, below = known.select("base", "slots").first()
    slots = [*below, last]
    return _index(spark, paths, day, slots), day, slots


def _index(spark: SparkSession, paths: WindowPaths, day: str | None, slots: list[str]) -> IdentityIndex:
    layers = [read_layer(spark, paths.delta(slot, "records"), paths.delta(slot, "redirects")) for slot in slots]
    base = None if day is None else read_base(spark, paths.daily_base(day))
    return IdentityIndex(base, layers, paths.buckets)


def run_hourly(spark: SparkSession, log_paths: Sequence[str], paths: WindowPaths, hours: list[str]) -> None:
    """Resolve the hours' id-pair lines; only their directories and row groups of the log tables are read."""
    pairs = identity.pairs_from_lines(scan_hours(spark, log_paths, hours))
    slotted = pairs.where(identity.slot_of(F.col("time")).isin(*hours))
    identity.identity_map(slotted).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("slot").parquet(paths.hourly())


def run_window(spark: SparkSession, paths: WindowPaths, hours: list[str], last: str,
               recent: int = schemas.RECENT_PER_GROUP, group_limit: int = schemas.GROUP_SIZE_LIMIT,
               first_run: bool = False) -> None:
    """Merge one window and write its outputs below its last hour.

    Reads the buckets and ids of the index that the window touches and writes a
    layer of them; the whole index is read and written once a day, as the base.
    """
    slot, start, minutes = hours[-1], slot_minute(hours[0]), 60 * len(hours)
    window = spark.read.parquet(paths.hourly()).where(F.col("slot").isin(*hours))
    index, day, slots = previous_index(spark, paths, hours, last, first_run)
    cids = cut_lineage(window.select("cid_hash").distinct())
    known = None if index.is_empty() else index.records(cids)
    merge = identity.merge_history(window, known, recent, group_limit)
    changes = cut_lineage(merge.changes)
    # The layer of this window: nothing of the index but its ids is written again.
    write_bucketed(identity.remap_uids(merge.everything(), changes), paths.delta(slot, "records"), paths.buckets)
    redirects_of(changes).write.mode("overwrite").parquet(paths.delta(slot, "redirects"))
    layers = spark.createDataFrame([(day, slots)], "base string, slots array<string>")
    layers.coalesce(1).write.mode("overwrite").parquet(paths.delta(slot, "layers"))
    layer = read_layer(spark, paths.delta(slot, "records"), paths.delta(slot, "redirects"))
    added = identity.window_records(layer.records, start, minutes).select(*identity.IDENTITY_COLUMNS)
    if known is not None:
        older = identity.remap_uids(index.older_in_range(start, start + minutes, cids), changes)
        added = added.unionByName(older)
    outputs = {
        "delete": identity.uids_to_delete(changes, start),
        "add": identity.add_rows(added, group_limit),
        "changes": identity.change_log(changes),
        "audit": identity.change_audit(changes, added),
    }
    for name, table in outputs.items():
        table.write.mode("overwrite").parquet(paths.output(slot, name))
    write_hourly(hourly_kinds(identity.slot_rows(window, changes)), paths.idmap(), "slot")
    if slot.endswith("-23"):
        # The next day starts from the coded base table.
        whole = _index(spark, paths, day, [*slots, slot]).records()
        write_base(whole, paths.daily_base(_next_day(slot)), paths.buckets)


def _next_day(slot: str) -> str:
    return hour_list(slot, 2)[-1][:10]


def day_window_ends(last_slot: str, hour_span: int, start: str | None = None) -> list[str]:
    """Ends of the windows that ended on the day of ``last_slot``, back to ``start`` if that is given."""
    ends, at = [], last_slot
    while at[:10] == last_slot[:10] and (start is None or at >= start):
        ends.append(at)
        at = hours_before(at, hour_span)
    return ends[::-1]


def run_daily_merge(spark: SparkSession, paths: WindowPaths, day: str, change_slots: list[str],
                    first_run: bool = False) -> None:
    """Merge the day's channel and cookie ids; ``change_slots`` are the ends of the day's windows."""
    if not change_slots:
        raise ValueError(f"no window ended on {day}")
    parts = [
        _stored(spark, paths.output(slot, "delete"), False).select(
            F.col("old_code").alias("old_uid"), F.col("new_code").alias("new_uid"), F.lit(slot[-2:]).alias("hour")
        )
        for slot in change_slots
    ]
    changes = cut_lineage(channels.day_changes(reduce(DataFrame.unionByName, parts)))
    today = spark.read.parquet(paths.idmap()).where(F.col("slot").startswith(day))
    cookies = today.where(F.col("kind") == COOKIE_KIND)
    ids = today.where(F.col("kind") != COOKIE_KIND)
    history = _stored(spark, paths.channel_history("channel", previous_day(day)), first_run)
    channels.merge_channels(ids, history, changes, day).write.mode("overwrite").parquet(
        paths.channel_history("channel", day)
    )
    channels.merge_cookies(cookies, changes).write.mode("overwrite").parquet(paths.channel_history("agsid", day))


def run_windows(spark: SparkSession, log_paths: Sequence[str], root: str, start: str, hour_span: int, run_count: int,
                last: str | None = None, do_hourly: bool = True, do_merge: bool = True, first_run: bool = False,
                buckets: int = BUCKETS, **limits) -> list[str]:
    """Run consecutive windows over log tables and return the slot each one was saved under.

    A missing history raises, unless ``first_run`` says that there is none: then
    the first window starts without an index, and the first daily merge without
    a channel history. After a window that ends at hour 23 the daily merge
    follows, over all windows that ended on that day. A span of more than a day
    has its channel history under the days its windows end on.
    """
    paths = WindowPaths(root.rstrip("/"), buckets)
    saved: list[str] = []
    every = hour_list(start, hour_span * run_count)
    merged_days = 0
    for run in range(run_count):
        hours = every[run * hour_span:(run + 1) * hour_span]
        before = last if run == 0 and last else previous_hour(hours[0])
        if do_hourly:
            run_hourly(spark, log_paths, paths, hours)
        if do_merge:
            run_window(spark, paths, hours, before, first_run=first_run and run == 0, **limits)
            if hours[-1].endswith("-23"):
                slots = day_window_ends(hours[-1], hour_span, start if first_run else None)
                # Yesterday has a history unless its last window is not part of this chain.
                begins = first_run and (merged_days == 0 or hour_span > 24)
                run_daily_merge(spark, paths, hours[-1][:10], slots, first_run=begins)
                merged_days += 1
        saved.append(hours[-1])
    return saved
