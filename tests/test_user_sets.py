"""User bitmaps against plain sets."""

import random

from pyspark.sql import functions as F

from clickloom.operators import user_sets
from clickloom.session import cut_lineage


def _seen(spark, seed, days, users, n):
    draw = random.Random(seed)
    rows = [(draw.choice(days), f"u{draw.randrange(users)}") for _ in range(n)] + [(days[0], None)]
    return rows, spark.createDataFrame(rows, "day string, user string")


def test_numbers_are_dense_and_stay(spark):
    rows, seen = _seen(spark, 1, ["a", "b"], 300, 900)
    first = cut_lineage(user_sets.user_numbers(seen, "user"))
    users = {u for _, u in rows if u}
    got = {r.user: r.number for r in first.collect()}
    assert set(got) == users and sorted(got.values()) == list(range(1, len(users) + 1))
    more, later = _seen(spark, 2, ["c"], 500, 900)
    second = {r.user: r.number for r in user_sets.user_numbers(later, "user", first).collect()}
    assert {u: second[u] for u in got} == got
    assert sorted(second.values()) == list(range(1, len(users | {u for _, u in more if u}) + 1))
    # No new users, no users at all.
    assert user_sets.user_numbers(seen, "user", first).count() == len(users)
    assert user_sets.user_numbers(seen.limit(0), "user").count() == 0


def test_counts_equal_those_of_sets_and_leave_the_log_alone(spark):
    # More than one bitmap row per day: users of two buckets.
    days = ["d1", "d2", "d3", "d4"]
    rows, seen = _seen(spark, 3, days, 400, 800)
    shifted = cut_lineage(user_sets.user_numbers(seen, "user").withColumn("number", F.col("number") + 32_568))
    bitmaps = cut_lineage(user_sets.user_bitmaps(seen, ["day"], "user", shifted))
    assert bitmaps.select("bucket").distinct().count() == 2
    sets = {d: {u for day, u in rows if day == d and u} for d in days}
    for chosen in (["d1"], ["d2", "d4"], days):
        united = user_sets.union_counts(bitmaps.where(F.col("day").isin(chosen)), [])
        assert united.first().users == len(set().union(*(sets[d] for d in chosen)))
        assert united.inputFiles() == bitmaps.inputFiles() or set(united.inputFiles()) <= set(bitmaps.inputFiles())
    overlap = {r.day: (r.users, r.overlap) for r in user_sets.overlap_counts(bitmaps, "day", "d2").collect()}
    assert overlap == {d: (len(sets[d]), len(sets[d] & sets["d2"])) for d in days}
    assert {r.overlap for r in user_sets.overlap_counts(bitmaps, "day", "none").collect()} == {0}
