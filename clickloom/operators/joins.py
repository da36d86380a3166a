"""Join-shaped operators: stitching, fallback resolution, membership, diffs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import none_marker
from clickloom.operators.bloom import might_be_member
from clickloom.operators.dedupe import earliest
from clickloom.operators.rendering import text_parts
from clickloom.session import cut_lineage

TAG_SEPARATOR = "|~|"


def stitch_show_click_bid(shows: DataFrame, clicks: DataFrame, bids: DataFrame,
                          keys: Sequence[str] = ("ssp", "req")) -> DataFrame:
    """Shows with their click, if any, and their bid; shows without a bid are dropped.

    ``shows``: keys, time, ua, agsid. ``clicks``: keys, time. ``bids``: keys,
    line. Each side is first reduced to one record per request: the earliest
    show and click, the bid with the least hash of its line. Bids are most of
    the data and few are shown, so a Bloom filter of the shown requests drops
    the others before anything is shuffled. The winner is chosen on narrow rows
    and its line joined last; no line is sorted.
    """
    keys = list(keys)

    def present(df: DataFrame) -> DataFrame:
        return df.where(F.col(keys[-1]).isNotNull())

    show = cut_lineage(earliest(present(shows).select(*keys, "time", "ua", "agsid"), keys, "time"))
    click = present(clicks).groupBy(*keys).agg(F.min("time").alias("click_time")).withColumn("clicked", F.lit(1))
    # Stored with a number per row, which names the winner among equal lines too.
    shown = cut_lineage(
        might_be_member(present(bids).select(*keys, "line"), show, keys).select(
            *keys, "line", F.xxhash64("line").alias("__hash"), F.monotonically_increasing_id().alias("__row")
        )
    )
    winners = shown.groupBy(*keys).agg(F.min(F.struct("__hash", "__row")).alias("w")).select(
        *keys, F.col("w.__row").alias("__row")
    )
    stitched = show.join(winners, keys, "inner").join(click, keys, "left")
    lines = shown.select("__row", "line").join(stitched.hint("shuffle_hash"), ["__row"])
    return lines.select(
        *keys, "time", "ua", "agsid", "line", "click_time", F.coalesce("clicked", F.lit(0)).alias("clicked")
    ).withColumnRenamed("time", "show_time")


def stitched_line(sep: str = "||") -> Column:
    """Text form of a stitched row: the bid line plus four fields."""
    return F.concat_ws(
        sep,
        F.col("line"),
        F.concat(F.lit("ua="), none_marker(F.col("ua"))),
        F.concat(F.lit("click="), F.col("clicked").cast("string")),
        F.concat(F.lit("clicktime="), none_marker(F.col("click_time"))),
        F.concat(F.lit("agsid="), none_marker(F.col("agsid"))),
    )


def left_join_default(df: DataFrame, right: DataFrame, on: Sequence[str], value: str, default=0) -> DataFrame:
    """Left join to a per-key value, absent keys take the default."""
    return df.join(right, list(on), "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def attach_component(vertices: DataFrame, components: DataFrame, by: Sequence[str] = (),
                     vertex: str = "cid_hash", out: str = "uid") -> DataFrame:
    """Component of each vertex; one without any edge is its own component.

    Both sides are unique per vertex, so the join is balanced by its key.
    """
    found = components.select(*by, F.col("node").alias(vertex), F.col("component").alias(out))
    return vertices.join(found, [*by, vertex], "left").withColumn(out, F.coalesce(F.col(out), F.col(vertex)))


def canonical_ids(line: Column) -> Column:
    """Canonical form of a formatted id line without its key.

    Each tab field is a comma list of ``id|time|num``; only the ids are kept,
    sorted, so that order and counters do not count as differences.
    """
    def field(text: Column) -> Column:
        ids = F.transform(F.split(text, ","), lambda i: F.substring_index(i, "|", 1))
        return F.array_join(F.array_sort(ids), "|")

    return F.array_join(F.transform(F.split(line, "\t"), field), ";")


DIFF_BUCKETS = 4_096


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _bucket_sums(side: DataFrame, keys: Sequence[str], value: str, buckets: int) -> DataFrame:
    """Row count and sums of two row hashes per key bucket, whatever the order of the rows."""
    present = [F.col(c).isNull() for c in [*keys, value]]
    sums = []
    for seed in (0, 1):
        code = F.xxhash64(F.lit(seed), *keys, value, *present)
        # In halves, so that no sum leaves a long.
        sums += [F.sum(F.shiftright(code, 32)), F.sum(code.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return side.groupBy(_bucket_of(keys, buckets).alias("bucket")).agg(F.struct(F.count("*"), *sums).alias("sums"))


def unequal_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str,
                    buckets: int = DIFF_BUCKETS) -> list[int]:
    """Key buckets in which two tables differ; never more than ``buckets`` numbers.

    Equal tables give equal sums. Unlike buckets pass as equal with a chance of about 2^-128.
    """
    a = _bucket_sums(left, keys, value, buckets).withColumnRenamed("sums", "a")
    b = _bucket_sums(right, keys, value, buckets).withColumnRenamed("sums", "b")
    unlike = a.join(b, ["bucket"], "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return sorted(r.bucket for r in unlike.select("bucket").collect())


def dataset_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str,
                 buckets: int = DIFF_BUCKETS) -> DataFrame:
    """Keys whose values differ or that one side lacks.

    Keys are meant to be unique on each side. Hash sums per key bucket are compared
    first, and only rows of buckets that differ are shuffled; both sides are read for
    each step. Rows with a null key match nothing, so they always take part. Sides whose
    columns differ in type are joined whole, as their hashes do not compare.
    """
    keys = list(keys)
    if all(left.schema[c].dataType == right.schema[c].dataType for c in [*keys, value]):
        unlike = _bucket_of(keys, buckets).isin(unequal_buckets(left, right, keys, value, buckets))
        for key in keys:
            unlike = unlike | F.col(key).isNull()
        left, right = left.where(unlike), right.where(unlike)
    a = left.select(*keys, F.col(value).alias("left_value"), F.lit(True).alias("__l"))
    b = right.select(*keys, F.col(value).alias("right_value"), F.lit(True).alias("__r"))
    same = F.col("left_value").eqNullSafe(F.col("right_value")) & F.col("__l").isNotNull() & F.col("__r").isNotNull()
    return a.join(b, keys, "full").where(~same).drop("__l", "__r")


def resolve_users(rows: DataFrame, cookie_users: DataFrame, channel_users: DataFrame) -> DataFrame:
    """(uid, tag): by cookie id first, by (channel, channel id) otherwise.

    ``rows``: channel, channel_id, agsid, tag. ``cookie_users``: agsid, uid.
    ``channel_users``: channel, channel_id, uid. Rows that neither side knows
    are left out.
    """
    usable = rows.where(F.col("channel_id").isNotNull() | F.col("agsid").isNotNull())
    # Stored: both halves read the joined rows, and the second join starts from a plain scan.
    by_cookie = cut_lineage(usable.join(cookie_users.select("agsid", "uid"), ["agsid"], "left"))
    resolved = by_cookie.where(F.col("uid").isNotNull()).select("uid", "tag")
    pending = by_cookie.where(F.col("uid").isNull()).select("channel", "channel_id", "tag")
    by_channel = pending.join(channel_users.select("channel", "channel_id", "uid"), ["channel", "channel_id"])
    return resolved.unionByName(by_channel.select("uid", "tag"))


def user_tag_lines(resolved: DataFrame, sep: str = TAG_SEPARATOR, **options) -> DataFrame:
    """All tags of a user as one text (several parts for an extreme user)."""
    return text_parts(resolved, ["uid"], F.col("tag"), sep, out="tags", **options)


def both_members(pairs: DataFrame, first: str, second: str, members: DataFrame, member: str) -> DataFrame:
    """Pairs of which both ends are in the member list.

    Semi-joins ignore repeated list entries. The list comes in unshuffled, so
    Spark broadcasts a small one and splits skewed pair keys for a large one.
    """
    a = members.select(F.col(member).alias(first))
    b = members.select(F.col(member).alias(second))
    return pairs.join(a, [first], "left_semi").join(b, [second], "left_semi")


def only_members(df: DataFrame, key: str, members: DataFrame, member: str) -> DataFrame:
    return df.join(members.select(F.col(member).alias(key)), [key], "left_semi")


def dictionary_lookup(df: DataFrame, dictionary: DataFrame, key: str, dict_key: str, dict_value: str,
                      out: str, fallback: Column | None = None) -> DataFrame:
    """Look a key up; absent keys take the fallback, the key itself by default.

    The dictionary may be of any size and is never collected.
    """
    table = dictionary.select(F.col(dict_key).alias(key), F.col(dict_value).alias("__value"))
    default = F.col(key) if fallback is None else fallback
    return df.join(table, [key], "left").withColumn(out, F.coalesce("__value", default)).drop("__value")


def equi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "inner")
