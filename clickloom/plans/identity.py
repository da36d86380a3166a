"""Identity resolution: id pairs -> components per slot -> merged history."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.hashing import compact_id_decode, compact_id_encode, md5_signed64
from clickloom.functions.text import blank_to_null
from clickloom.functions.times import epoch_minute
from clickloom.operators.bloom import split_members
from clickloom.operators.dedupe import oldest_per_group, recent_per_group
from clickloom.operators.graph import connected_components
from clickloom.operators.skew import drop_oversized, spread_join
from clickloom.schemas import GROUP_SIZE_LIMIT, RECENT_PER_GROUP, WINDOW_MINUTES
from clickloom.session import cut_lineage, own_stages

IDENTITY_COLUMNS = ("cid_hash", "uid", "cid", "id_type", "minute", "num")
# Fixed value: id types that have a column in the add rows.
ADD_TYPES = (1, 2, 3, 4, 5)
SLOT_CHARS = 13


def slot_of(time: Column, chars: int = SLOT_CHARS) -> Column:
    """Hour slot ``yyyy-MM-dd-HH`` of a text time (fewer characters: a longer slot)."""
    return F.replace(F.substring(time, 1, chars), F.lit(" "), F.lit("-"))


def clean_pairs(pairs: DataFrame) -> DataFrame:
    """Trim all fields; both missing markers become NULL.

    The cleaned row is generated, so it is built once: merged projections would
    clean an id again for each use of its hash.
    """
    names = ("time", "id1", "id1_type", "id2", "id2_type")
    cleaned = F.struct(*[blank_to_null(F.trim(F.col(n))).alias(n) for n in names])
    return pairs.select(F.explode(F.array(cleaned)).alias("p")).select("p.*")


def pairs_from_lines(lines: DataFrame) -> DataFrame:
    """Tab-separated id-pair lines with five fields or more; shorter lines are left out."""
    p = F.split(F.col("value"), "\t", -1)
    names = ("time", "id1", "id1_type", "id2", "id2_type")
    kept = lines.where(F.size(p) >= 5)
    return clean_pairs(kept.select(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(names)]))


def _star_ends(pairs: DataFrame, slot_chars: int) -> DataFrame:
    """(slot, cid, label, id_type, time, num, minute), stored: what each star says of its ids.

    A star is an id and all it is paired with as ``id1`` in a slot; its label is the least hash in it.
    The pairs are shuffled once, by star, and repeated ones fall together there: ``id1`` gets one row,
    and so does each ``id2`` and type. The table has no hash of an id, as hashes do not compress:
    they would be most of it.
    """
    # Pairs without id1 are no star and are dealt by id2.
    slot, hub = slot_of(F.col("time"), slot_chars), F.coalesce("id1", "id2")
    # Both are made again behind the shuffle, so as not to be moved.
    dealt = clean_pairs(pairs).where(slot.isNotNull()).repartition(hub, slot).select("*", hub.alias("hub"), slot.alias("slot"))
    # The id comes first, as rows are sorted by these columns and few differ in their slot.
    quads = dealt.groupBy("hub", "slot", "id1", "id1_type", "id2", "id2_type").agg(F.max("time").alias("time")).select(
        "*", md5_signed64(F.col("id1")).alias("hash1"), md5_signed64(F.col("id2")).alias("hash2")
    )
    ordered = Window.partitionBy("hub", "slot", "id1").orderBy("id1_type", "id2", "id2_type")
    star = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = quads.select(
        "*", F.row_number().over(ordered).alias("place"), F.count("*").over(star).alias("n"),
        F.max(F.struct("time", "id1_type")).over(star).alias("last"), F.min("hash2").over(star).alias("least"),
    )
    label = F.when(F.col("id1").isNotNull(), F.least("hash1", "least")).alias("label")

    def end(cid: str, id_type: Column, time: Column, num: Column) -> Column:
        return F.struct(
            F.col(cid).alias("cid"), label, id_type.alias("id_type"), time.alias("time"), num.cast("long").alias("num"),
        )

    first = F.when(F.col("place") == 1, end("id1", F.col("last.id1_type"), F.col("last.time"), F.col("n")))
    second = end("id2", F.col("id2_type"), F.col("time"), F.lit(1))
    ends = known.select("slot", F.explode(F.array(first, second)).alias("e"))
    rows = ends.where(F.col("e.cid").isNotNull()).select("slot", "e.*")
    return cut_lineage(rows.select("*", epoch_minute(F.col("time")).alias("minute")))


def identity_map(pairs: DataFrame, slot_chars: int = SLOT_CHARS) -> DataFrame:
    """(slot, cid_hash, uid, cid, id_type, minute, num): one row per id and slot, a plan over stored tables.

    All slots are resolved together: the slot is part of every key, so a run
    over many hours takes as many rounds as its slowest hour, not their sum.

    An id of one star has its row, under the star's label, and is not shuffled again. Ids of
    several stars are found by their codes; a Bloom filter of those takes their rows out, which
    are grouped, and link the labels they stand under. A label that a lesser one is linked with
    is replaced, again only in the rows that a filter takes out. With too many such ids or
    labels for a filter, all rows are grouped or joined.
    """
    # The code stands for (slot, cid).
    ends = _star_ends(pairs, slot_chars).withColumn("code", F.xxhash64("slot", "cid"))
    repeated = cut_lineage(ends.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select("code"))
    several, single = split_members(ends, repeated, ["code"], repeated.count())
    grouped = cut_lineage(several.groupBy("slot", "cid").agg(
        F.max(F.struct("time", "id_type", "minute")).alias("r"), F.sum("num").alias("num"),
        F.min("label").alias("label"), F.max("label").alias("other"),
    ))
    mixed = grouped.where(F.col("label") != F.col("other")).select("slot", "cid", F.col("label").alias("src"))
    links = several.join(mixed, ["slot", "cid"]).where(F.col("label") != F.col("src"))
    solved = connected_components(links.select("slot", "src", F.col("label").alias("dst")), by=["slot"])
    moved = cut_lineage(solved.where(F.col("node") != F.col("component")).select(
        "slot", F.col("node").alias("uid"), F.col("component").alias("least")
    ))
    columns = ["slot", "label", "cid", "id_type", "minute", "num"]
    rows = single.select(*columns).unionByName(
        grouped.select("*", "r.id_type", "r.minute").select(*columns)
    ).where(F.col("minute") != 0)
    rows = rows.withColumn("cid_hash", md5_signed64(F.col("cid"))).withColumn("uid", F.coalesce("label", "cid_hash"))
    stale, right = split_members(rows, moved, ["slot", "uid"], moved.count())
    mended = stale.join(moved, ["slot", "uid"], "left").withColumn("uid", F.coalesce("least", "uid"))
    names = ["slot", "cid_hash", "uid", "cid", F.col("id_type").try_cast("int").alias("id_type"), "minute", "num"]
    # Stored, so that the rest is read once.
    return right.select(*names).unionByName(cut_lineage(mended.select(*names)))


def history_from_daily_base(base: DataFrame, *more: str) -> DataFrame:
    """Daily base rows (coded uid, no hash) as identity records, with further columns ``more``."""
    return base.select(
        md5_signed64(F.col("cid")).alias("cid_hash"), compact_id_decode(F.col("uid_code")).alias("uid"),
        "cid", "id_type", "minute", "num", *more,
    )


def merge_records(records: DataFrame, *flags: str) -> DataFrame:
    """One record per cid: newest time, summed counts, the uid that knew it first, the greatest of each of ``flags``."""
    merged = records.groupBy("cid_hash").agg(
        F.min(F.struct("minute", "uid")).alias("first"),
        F.max(F.struct("minute", "id_type", "cid")).alias("last"),
        # By itself, so that who asks for no more than the times does not move the rest.
        F.max("minute").alias("minute"), F.sum("num").alias("num"), *[F.max(f).alias(f) for f in flags],
    )
    return merged.select(
        "cid_hash", F.col("first.uid").alias("uid"), F.col("last.cid").alias("cid"),
        F.col("last.id_type").alias("id_type"), "minute", "num", *flags,
    )


def split_repeated(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of ids that may have several, records of ids that have one); all of an id are on one side.

    What is shuffled for it are the hashes of the ids alone. ``records`` is read for that and for each part.
    """
    repeated = cut_lineage(
        records.groupBy("cid_hash").agg(F.count("*").alias("n")).where("n > 1").select("cid_hash"))
    return split_members(records, repeated, ["cid_hash"], repeated.count())


def merge_dealt(records: DataFrame, *flags: str) -> DataFrame:
    """:func:`merge_records` of rows that seldom share an id in one task: the rows are moved as they
    are, since what a grouping makes of a row to move it is nearly twice as wide."""
    return merge_records(records.select(*IDENTITY_COLUMNS, *flags).repartition("cid_hash"), *flags)


def merge_slots(records: DataFrame) -> DataFrame:
    """:func:`merge_records`, a plan that moves nothing: records of ids that have several are merged and stored."""
    several, single = split_repeated(records.select(*IDENTITY_COLUMNS))
    merged = cut_lineage(merge_dealt(several))
    alone = single.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in merged.schema])
    return alone.unionByName(merged)


def uid_sightings(records: DataFrame) -> DataFrame:
    """(cid_hash, uid, minute): when each uid was first seen with each cid."""
    return records.groupBy("cid_hash", "uid").agg(F.min("minute").alias("minute"))


def recent_records(window: DataFrame, limit: int) -> DataFrame:
    """The newest ``limit`` records per (uid, id_type); only groups that have more are moved and ranked."""
    sizes = window.groupBy(F.col("uid").alias("of"), F.col("id_type").alias("kind")).agg(F.count("*").alias("n_rows"))
    large = cut_lineage(sizes.where(F.col("n_rows") > limit).select("of", "kind"))
    if large.isEmpty():
        return window
    same = F.col("uid").eqNullSafe(F.col("of")) & F.col("id_type").eqNullSafe(F.col("kind"))
    ranked = recent_per_group(window.join(large, same, "left_semi"), limit=limit)
    return window.join(large, same, "left_anti").unionByName(ranked)


def shared_sightings(records: DataFrame) -> DataFrame:
    """(root, uid, minute), stored: per id with several uids, when each was first seen with it.

    ``root`` is the least of the id's uids. The records are shuffled once, by the id, with nothing but uid and time.
    """
    first = uid_sightings(records.select("cid_hash", "uid", "minute").repartition("cid_hash"))
    of_id = Window.partitionBy("cid_hash")
    rooted = first.select("uid", "minute", F.min("uid").over(of_id).alias("root"), F.count("*").over(of_id).alias("n"))
    return cut_lineage(rooted.where("n > 1").select("root", "uid", "minute"))


@dataclass
class HistoryMerge:
    """Result of merging a window into the history.

    ``merged`` holds the ids of the window, ``untouched`` the history's records of
    all other ids (None without a history). Both lie in one table, which is stored when one of
    them is asked for; ``changes`` is a stored table.
    """

    several: DataFrame
    single: DataFrame
    has_history: bool
    changes: DataFrame

    @cached_property
    def table(self) -> DataFrame:
        """One record per id, stored; ``in_window`` marks the ids of the window."""
        merged = merge_dealt(self.several, "in_window")
        alone = self.single.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in merged.schema])
        return cut_lineage(alone.unionByName(merged))

    @property
    def merged(self) -> DataFrame:
        return self.table.where("in_window").select(*IDENTITY_COLUMNS)

    @property
    def untouched(self) -> DataFrame | None:
        return self.table.where("not in_window").select(*IDENTITY_COLUMNS) if self.has_history else None

    def everything(self) -> DataFrame:
        return self.table.select(*IDENTITY_COLUMNS)


def merge_history(window: DataFrame, history: DataFrame | None, recent: int = RECENT_PER_GROUP,
                  group_limit: int = GROUP_SIZE_LIMIT) -> HistoryMerge:
    """Merge a window's records into the history; the oldest uid of a group wins.

    ``history`` has one record per id, so only ids of the window can have two
    uids. An id with one record in all is neither merged nor moved. ``changes`` is
    (old_uid, new_uid, minute) for every uid that shares a cid with another one,
    unchanged uids included. Groups of ``group_limit`` uids or more are
    implausible as a person and change nothing. Both tables are read several
    times, so they should be plans over stored ones.
    """
    fresh = recent_records(window.select(*IDENTITY_COLUMNS), recent)
    records = fresh.withColumn("in_window", F.lit(True))
    if history is not None:
        records = records.unionByName(history.select(*IDENTITY_COLUMNS, F.lit(False).alias("in_window")))
    several, single = split_repeated(records)

    with own_stages(window.sparkSession) as stages:
        changes = cut_lineage(_changes(several, group_limit))
        stages.keep(changes)
    return HistoryMerge(several, single, history is not None, changes)


def _changes(records: DataFrame, group_limit: int) -> DataFrame:
    """(old_uid, new_uid, minute) of uids that share an id, a plan over stored tables."""
    # Star edges instead of all pairs: each uid of a shared cid to the least one.
    shared = shared_sightings(records)
    edges = shared.where(F.col("uid") != F.col("root")).select(F.col("root").alias("src"), F.col("uid").alias("dst"))
    first_seen = shared.groupBy("uid").agg(F.min("minute").alias("minute"))
    components = connected_components(edges)
    members = cut_lineage(components.select(F.col("node").alias("uid"), "component").join(first_seen, ["uid"], "inner"))
    oldest = cut_lineage(oldest_per_group(members, "component", "uid", "minute"))
    plausible = oldest.where(F.col("n_rows") < group_limit)
    changes = spread_join(members, plausible.select("component", "oldest"), ["component"], "inner", counts=oldest)
    return changes.select(F.col("uid").alias("old_uid"), F.col("oldest").alias("new_uid"), "minute")


def real_changes(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("old_uid") != F.col("new_uid"))


def remap_uids(records: DataFrame, changes: DataFrame) -> DataFrame:
    """Records under their new uid. The change table is joined, never collected.

    Only records that a filter takes for those of changed uids are joined, and these are stored; with too
    many changes for a filter, all are. ``records`` are read for each part.
    """
    table = cut_lineage(real_changes(changes).select(F.col("old_uid").alias("uid"), "new_uid"))
    stale, right = split_members(records, table, ["uid"], table.count())
    joined = stale.join(table, ["uid"], "left")
    mended = joined.withColumn("uid", F.coalesce("new_uid", "uid")).drop("new_uid").select(*records.columns)
    return right.unionByName(cut_lineage(mended))


def uids_to_delete(changes: DataFrame, window_start: int) -> DataFrame:
    """Changed uids that were known before the window, as codes."""
    old = real_changes(changes).where(F.col("minute") < window_start)
    return old.select(
        compact_id_encode(F.col("old_uid")).alias("old_code"), compact_id_encode(F.col("new_uid")).alias("new_code")
    )


def window_records(index: DataFrame, window_start: int, window_minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Index records whose newest time lies in the window."""
    return index.where((F.col("minute") >= window_start) & (F.col("minute") < window_start + window_minutes))


def add_rows(records: DataFrame, group_limit: int = GROUP_SIZE_LIMIT) -> DataFrame:
    """(uid_code, t1..t5, total): per id type the list ``cid|minute|num,...``, newest first.

    A (uid, type) group of ``group_limit`` ids or more is left out before any
    list is made, so every list is bounded.
    """
    usable = records.where(F.col("id_type").isin(*ADD_TYPES))
    kept = drop_oversized(usable, ["uid", "id_type"], group_limit)
    entry = F.struct(
        (-F.col("minute")).alias("m"), F.col("cid").alias("c"),
        F.concat_ws("|", "cid", F.col("minute").cast("string"), F.col("num").cast("string")).alias("text"),
    )
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"])
    per_type = kept.groupBy("uid", "id_type").agg(F.array_join(listed, ",").alias("ids"), F.count("*").alias("n"))
    # At most one row per type is left for each uid.
    columns = [
        F.coalesce(F.max(F.when(F.col("id_type") == t, F.col("ids"))), F.lit("")).alias(f"t{t}") for t in ADD_TYPES
    ]
    wide = per_type.groupBy("uid").agg(*columns, F.sum("n").alias("total"))
    return wide.select(compact_id_encode(F.col("uid")).alias("uid_code"), *[f"t{t}" for t in ADD_TYPES], "total")


def change_log(changes: DataFrame) -> DataFrame:
    return changes.select(
        compact_id_encode(F.col("old_uid")).alias("old_code"),
        compact_id_encode(F.col("new_uid")).alias("new_code"), "minute",
    )


def change_audit(changes: DataFrame, added: DataFrame) -> DataFrame:
    """Added records that still stand under a changed uid."""
    table = cut_lineage(real_changes(changes).select(
        F.col("old_uid").alias("uid"), "new_uid", F.col("minute").alias("change_minute")
    ))
    likely, _ = split_members(added, table, ["uid"], table.count())
    return likely.join(table, ["uid"], "inner")


def slot_rows(window: DataFrame, changes: DataFrame) -> DataFrame:
    """The window's records under their new uid, coded, for the hourly outputs."""
    remapped = remap_uids(window, changes)
    return remapped.select("slot", "cid", compact_id_encode(F.col("uid")).alias("uid"), "id_type", "minute")
