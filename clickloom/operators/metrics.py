"""Users-and-hits reports and related counts.

A user set is never gathered: every distinct count is a count of grouped
(key, user) rows, which Spark partially aggregates before each shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.classify import matches_campaign
from clickloom.operators.joins import left_join_default
from clickloom.operators.rendering import text_parts
from clickloom.operators.skew import spread_join
from clickloom.session import cut_lineage, small_tasks

# Degree histogram, lower bound -> label.
DEGREE_BUCKETS = (
    (2000, "else"),
    (1000, "1000-1999"),
    (500, "500-999"),
    (200, "200-499"),
    (100, "100-199"),
    (50, "50-99"),
    (20, "20-49"),
    (10, "10-19"),
    (0, "0-9"),
)


def uv_pv(df: DataFrame, keys: Sequence[str], user: str, weight: Column | None = None) -> DataFrame:
    """Users and hits per key. Rows without a user do not count."""
    hits = F.count("*") if weight is None else F.sum(weight)
    per_user = df.where(F.col(user).isNotNull()).groupBy(*keys, user).agg(hits.alias("__hits"))
    return per_user.groupBy(*keys).agg(F.count("*").alias("users"), F.sum("__hits").alias("hits"))


def _long_uv_pv(per_user: DataFrame, flags: Mapping[str, str], label: str) -> DataFrame:
    """Per-user counters -> one row per counter: users with a positive count, total."""
    sums = []
    for name, col in flags.items():
        sums += [F.count_if(F.col(col) > 0).alias(f"u_{name}"), F.coalesce(F.sum(col), F.lit(0)).alias(f"h_{name}")]
    totals = per_user.agg(*sums)
    rows = F.array(*[
        F.struct(F.lit(name).alias(label), F.col(f"u_{name}").alias("users"), F.col(f"h_{name}").alias("hits"))
        for name in flags
    ])
    return totals.select(F.explode(rows).alias("r")).select(f"r.{label}", "r.users", "r.hits")


def flag_uv_pv(df: DataFrame, user: str, flags: Mapping[str, Column], label: str = "flag") -> DataFrame:
    """Users and hits for all rows and for each boolean flag."""
    named = {"all": F.lit(True), **flags}
    per_user = df.where(F.col(user).isNotNull()).groupBy(user).agg(
        *[F.count_if(c).alias(f"c_{n}") for n, c in named.items()]
    )
    return _long_uv_pv(per_user, {n: f"c_{n}" for n in named}, label)


def tag_flags(df: DataFrame, tags: str, user: str) -> DataFrame:
    """Rows with any tag and rows with a tag of the new kind (its text holds ``{X``)."""
    listed = F.when(F.length(tags) >= 2, F.translate(F.expr(f"substr({tags}, 2, length({tags}) - 2)"), '"', ""))
    text = F.coalesce(listed, F.lit(""))
    return flag_uv_pv(df, user, {"tag": F.length(text) > 0, "newtag": text.contains("{X")})


def exploded_uv_pv(df: DataFrame, values: Column, user: str, key: str = "value") -> DataFrame:
    """Users and hits per element of an array column."""
    return uv_pv(df.select(user, F.explode(values).alias(key)), [key], user)


def campaign_funnel(df: DataFrame, user: str, fields: Mapping[str, str], campaign: str,
                    strict: bool = False) -> DataFrame:
    """Users and hits per field whose text names the campaign."""
    hits = F.array_compact(F.array(*[
        F.when(matches_campaign(F.col(col), campaign, strict), F.lit(label)) for label, col in fields.items()
    ]))
    return exploded_uv_pv(df.where(F.col(user).isNotNull()), hits, user, "field")


def show_click_kpi(shows: DataFrame, clicks: DataFrame, request: str, user: str) -> DataFrame:
    """Users and hits of shows and of their clicks.

    ``shows``: request, user, one row per show. ``clicks``: request, one row
    per click. Shows are counted per (request, user) first, so repeated rows do
    not travel to the join.
    """
    per_show = shows.where(F.col(user).isNotNull()).groupBy(request, user).agg(F.count("*").alias("n_shows"))
    per_click = clicks.where(F.col(request).isNotNull()).groupBy(request).agg(F.count("*").alias("n_clicks"))
    joined = left_join_default(per_show, per_click, [request], "n_clicks")
    per_user = joined.groupBy(user).agg(
        F.sum("n_shows").alias("c_show"), F.sum(F.col("n_shows") * F.col("n_clicks")).alias("c_click")
    )
    return _long_uv_pv(per_user, {"show": "c_show", "click": "c_click"}, "kind").where(F.col("users") > 0)


def landing_bounce_kpi(df: DataFrame, user: str, is_landing: Column) -> DataFrame:
    """Page-view KPI: ad landings, all hits, and both for one-hit users (bounces)."""
    per_user = df.where(F.col(user).isNotNull()).groupBy(user).agg(
        F.count_if(is_landing).alias("c_ag"), F.count("*").alias("c_all")
    )
    single = F.col("c_all") == 1
    flagged = per_user.withColumn("c_all_bounce", F.when(single, 1).otherwise(0)).withColumn(
        "c_ag_bounce", F.when(single & (F.col("c_ag") > 0), 1).otherwise(0)
    )
    names = ("ag", "all", "all_bounce", "ag_bounce")
    return _long_uv_pv(flagged, {n: f"c_{n}" for n in names}, "kind").where(F.col("users") > 0)


def hits_per_user_ranking(df: DataFrame, slot: str, user: str, k: int = 100) -> DataFrame:
    """Slots with the most hits per user, as a whole-number ratio."""
    counts = uv_pv(df, [slot], user)
    ratio = F.call_function("div", F.col("hits"), F.col("users"))
    return counts.withColumn("ratio", ratio).orderBy(F.desc("ratio"), slot).limit(k)


def conflicting_ids(df: DataFrame, channel: str, guid: str, cookie: str, every: str = "allssp") -> DataFrame:
    """Distinct cookie ids per channel and overall: all, and those of users with several."""
    usable = df.where(F.col(channel).isNotNull() & F.col(cookie).isNotNull())
    # Stored: read three times, and much smaller than the log.
    triples = cut_lineage(usable.select(channel, guid, cookie).distinct())
    named = triples.where(F.col(guid).isNotNull())
    several = cut_lineage(
        named.groupBy(channel, guid).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
    )
    wrong = spread_join(named, several.select(channel, guid), [channel, guid], "left_semi", counts=several)
    marked = triples.select(channel, cookie, F.lit("All").alias("kind")).unionByName(
        wrong.select(channel, cookie, F.lit("wrong").alias("kind"))
    )
    both = F.explode(F.array(F.col(channel), F.lit(every)))
    return (
        marked.select(both.alias(channel), "kind", cookie)
        .distinct()
        .groupBy(channel, "kind")
        .agg(F.count("*").alias("cookies"))
    )


def domain_uv_pv(df: DataFrame, domain: str, user: str, is_ad: Column) -> DataFrame:
    """Per domain: ad hits, users with an ad, hits, users."""
    per_user = df.where(F.col(user).isNotNull()).groupBy(domain, user).agg(
        F.count_if(is_ad).alias("a"), F.count("*").alias("n")
    )
    return per_user.groupBy(domain).agg(
        F.sum("a").alias("ad_hits"), F.count_if(F.col("a") > 0).alias("ad_users"),
        F.sum("n").alias("hits"), F.count("*").alias("users"),
    )


def id_type_combinations(df: DataFrame, uid: str = "uid", id_type: str = "id_type") -> DataFrame:
    """Users per combination of id types, and in total.

    The gathered set is one entry per id type code, a handful of values.
    """
    per_uid = df.select(uid, id_type).distinct().groupBy(uid).agg(
        F.array_join(F.array_sort(F.collect_set(id_type)).cast("array<string>"), "|").alias("combination")
    )
    return per_uid.select(F.explode(F.array("combination", F.lit("all"))).alias("combination")).groupBy(
        "combination"
    ).agg(F.count("*").alias("users"))


def both_directions(pairs: DataFrame, a: str, b: str, *carry: str) -> DataFrame:
    """(node, neighbour, ...) for both ends of each pair, in one read."""
    ends = F.array(
        F.struct(F.col(a).alias("node"), F.col(b).alias("neighbour")),
        F.struct(F.col(b).alias("node"), F.col(a).alias("neighbour")),
    )
    return pairs.select(F.inline(ends), *carry)


def degree_histogram(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Nodes per bucket of the number of distinct neighbours."""
    degrees = both_directions(pairs, a, b).distinct().groupBy("node").agg(F.count("*").alias("degree"))
    bucket = None
    for low, label in DEGREE_BUCKETS:
        test = F.col("degree") >= low
        bucket = F.when(test, label) if bucket is None else bucket.when(test, label)
    return degrees.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("nodes"))


def adjacency_lines(pairs: DataFrame, a: str, b: str, count: str, **options) -> DataFrame:
    """``node,neighbour:count,...`` per node, hubs in several parts; a stored table."""
    summed = pairs.groupBy(a, b).agg(F.sum(count).alias("n"))
    value = F.concat_ws(":", F.col("neighbour").cast("string"), F.col("n").cast("string"))
    with small_tasks(pairs.sparkSession):
        lists = text_parts(both_directions(summed, a, b, "n"), ["node"], value, ",", out="list", **options)
        return cut_lineage(lists.select("node", "part", F.concat_ws(",", F.col("node").cast("string"), "list").alias("line")))


def category_histogram(df: DataFrame, user: str, category: str, **options) -> DataFrame:
    """``category:count`` text per user, sorted, over every category that occurs.

    Rows are counted per user and category first, so a list holds one entry for
    each distinct category of a user; a user of very many has several parts. Rows
    without a category do not count; a user with no others has an empty text.
    """
    counted = df.where(F.col(user).isNotNull()).groupBy(user, category).agg(F.count("*").alias("__n"))
    shown = F.when(F.col(category).isNotNull(), F.concat_ws(":", F.col(category), F.col("__n").cast("string")))
    with small_tasks(df.sparkSession):
        return cut_lineage(text_parts(counted, [user], shown, " ", out="histogram", **options))


def day_overlap(df: DataFrame, day: str, user: str, base_day: str) -> DataFrame:
    """Distinct users per day, and how many of them were seen on the base day too."""
    seen = df.where(F.col(user).isNotNull()).select(day, user).distinct()
    base = seen.where(F.col(day) == base_day).select(user, F.lit(1).alias("__base"))
    # ``seen`` holds one row per day and user, so no user is hot here.
    return seen.join(base, [user], "left").groupBy(day).agg(
        F.count("*").alias("users"), F.count("__base").alias("overlap")
    )


def union_distinct_counts(first: DataFrame, second: DataFrame, user: str) -> DataFrame:
    """Distinct users of two sets and of their union, in one pass."""
    tagged = first.select(user, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        second.select(user, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    per_user = tagged.where(F.col(user).isNotNull()).groupBy(user).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return per_user.agg(
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("first_users"),
        F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("second_users"),
        F.count("*").alias("union_users"),
    )


def distinct_users(df: DataFrame, keys: Sequence[str], user: str, approximate: bool = False) -> DataFrame:
    """Distinct users per key: exact, or a sketch where an estimate will do."""
    usable = df.where(F.col(user).isNotNull())
    if approximate:
        return usable.groupBy(*keys).agg(F.approx_count_distinct(user).alias("users"))
    return usable.select(*keys, user).distinct().groupBy(*keys).agg(F.count("*").alias("users"))


def report_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report order: ascending by key."""
    return df.orderBy(*keys)


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top k, kept per task before one small merge (TakeOrdered)."""
    return df.orderBy(*order).limit(k)
